"""Main text of web pages by site template removal.

A page is read into a tree of elements, in one pass. Elements are hashed with all they hold (tags,
classes, text), and the hashes are counted in Spark per host: a subtree that recurs on many pages of
its host is template, and is deleted there. Three kinds are counted:

* boxes, which hold no prose: on MIN_PAGES pages and a share of the host's that falls with its size;
* items and cells, where answers like "yes" recur, and prose (paragraphs, headings) in pages that have
  no article or main element: on MIN_PAGES pages and a fixed share;
* prose in an article or main: only at the same place (among the first or the last EDGE blocks) on
  INNER_PAGES pages and most of the host's, as lines under every article are.

What is counted for a box are the distinct contents it stands in: the texts of their pages before
templates go. For prose it is the longest other block of its page. So rows that repeat and copies of
an article, whatever the site puts around them, are one, and copied articles stay whole; prose that
outweighs what differs between its pages stays too, since near copies look like that.

What HTML itself or its class words mark as not being the article (navigation, headers, footers,
asides, forms, adverts, notices, comments) goes on every page, so hosts of few pages are covered too,
and so is what differs from page to page. Of a header inside an article the headings stay. A mark does
not remove an element that holds all articles of its page, unless the main element beside it holds
more; so an article marked as a comment goes where there is another article or main. Words of state
(has-sidebar, menu-open) are no marks; the words of LOOSE are marks only of what is mostly links or
has no sentence. An article or main element, where there is one, bounds the text. In pages without
one, lists of nothing but links are menus.

Counts are pre-aggregated, so a host with a third of all pages is no hot key. Rows bound distinct
contents from above, so these are counted only for hashes with enough rows. Each page is read once;
only pages that hold a template whose removal changes their text are read again, with the list of
their own templates.

Defined results: a null or empty html has the empty text. Rows that repeat, also with a null
page_id, each give a row. A null or odd url is the host "". Unclosed, misnested and cut-off markup is
read to its end; a quote that is never closed ends with its tag. A count equal to a threshold is
enough. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import materialize

#: A subtree is template on a host from so many contents, and so large a share of the host's contents;
#: above SHARE_TO contents of a host the share falls with their root.
MIN_PAGES, MIN_SHARE, SHARE_TO = 5, 0.05, 50
#: Prose of an article is template among so many of its first or last blocks, from so many contents
#: and so large a share.
EDGE, INNER_PAGES, INNER_SHARE = 3, 8, 0.67
BOX, PROSE_OUTSIDE, PROSE_INSIDE, ITEM = 0, 1, 2, 3

#: Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD = frozenset("base link meta title style script noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("b i em strong span a br q cite code sub sup small u mark font abbr time s del ins kbd var samp label".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt figcaption".split())
GONE = frozenset(
    "head script style noscript template svg math iframe object embed canvas audio video map nav header footer aside form "
    "button select option textarea input label fieldset menu dialog title xmp noembed noframes".split()
)
#: Elements of GONE that some sites put around a whole page.
WRAPS = frozenset("form fieldset label dialog".split())
#: An opening tag of the key closes open elements of the value, inside the nearest of its container.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "thead": (("thead", "tbody", "tr", "td", "th"), ("table",)), "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
}
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement adverts adbox banner promo promoted sponsor sponsored sidebar aside rail menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer header masthead cookie cookies consent gdpr notice notices popup modal overlay subscribe subscription "
    "newsletter signup login comment comments commentlist disqus replies respond complementary contentinfo".split()
)
#: Words that mark it only where the element reads like it.
LOOSE = frozenset("share sharing social related recommended widget toolbar tags reply copyright disclaimer search".split())
#: Words that make of a mark a state of the page: before it, and behind it.
STATES, ENDS = frozenset("has with no without is not hide show".split()), frozenset("open opened closed fixed visible hidden enabled disabled active on off".split())
#: First words of an article's classes that name its place in the site, not the element's use.
FILED = frozenset("category tag post type status format topic author section term".split())
WHOLE = frozenset(("html", "body", "article", "main"))
#: Blocks whose text is prose without being a sentence.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTS = frozenset("p blockquote pre dd dt figcaption li td th caption summary address".split())
ITEMS = frozenset("li td th tr dd dt".split())
LISTS = frozenset("ul ol dl table div".split())

# A quoted value ends where an attribute can end; a quote that does not open one is a character.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"(?=[\s/>]|\Z)|'[^']*+'(?=[\s/>]|\Z)|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w\-])(class|id|role|hidden|aria-hidden)(?![\w\-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?…](?:[\"'»“”’)]*)(?:\s|\Z)|[。！？।]")


class Node:
    __slots__ = ("tag", "gone", "children", "mark", "loose")

    def __init__(self, tag: str, gone: bool, mark: str, loose: bool = False):
        self.tag, self.gone, self.mark, self.loose, self.children = tag, gone, mark, loose, []


def _is_mark(name: str, words: frozenset[str]) -> bool:
    parts = [w for w in re.split(r"[_\-]+", name) if w]
    return not (words.isdisjoint(parts) or not STATES.isdisjoint(parts[:-1]) or parts[-1] in ENDS)


def _marked(tag: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether the element is marked as not the article, whether loosely so, and its class and id."""
    if not attributes or (tag in WHOLE and tag != "article"):
        return tag in GONE, False, ""
    gone, loose, said = tag in GONE, False, []
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        said.append(value)
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value == "true"):
            gone = gone or tag in BLOCKS
        elif name.lower() in ("class", "id", "role"):
            names = [n for n in value.split() if tag != "article" or re.split(r"[_\-]+", n)[0] not in FILED]
            gone = gone or any(_is_mark(n, MARKS) for n in names)
            loose = loose or any(_is_mark(n, LOOSE) for n in names)
    return gone, loose and not gone, " ".join(said)


class _Stack:
    """Open elements, with the depths of each tag and of blocks, so that no step searches them."""

    def __init__(self, root: Node):
        self.nodes, self.depths, self.blocks = [root], {}, []

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.depths.setdefault(node.tag, []).append(at)
        if node.tag in BLOCKS:
            self.blocks.append(at)

    def cut(self, depth: int) -> None:
        """Closes all from this depth on."""
        while len(self.nodes) > depth:
            node = self.nodes.pop()
            self.depths[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def depth(self, tag: str) -> int:
        """Depth of the innermost open element of a tag, 0 if there is none."""
        found = self.depths.get(tag)
        return found[-1] if found else 0

    def first_inside(self, tag: str, limit: int) -> int | None:
        found = self.depths.get(tag, [])
        at = bisect_right(found, limit)
        return found[at] if at < len(found) else None


def parse(text: str) -> Node:
    """The tree of a page; text nodes are strings with their references decoded."""
    root = Node("html", False, "")
    stack, at, n = _Stack(root), 0, len(text)
    while at < n:
        found = _TOKEN.search(text, at)
        begin = found.start() if found else n
        if begin > at:
            said = text[at:begin]
            if stack.depth("head") and said.strip():
                stack.cut(stack.depth("head"))
            stack.nodes[-1].children.append(html.unescape(said))
        if not found:
            break
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        innermost = stack.blocks[-1] if stack.blocks else 0
        if found[1]:
            # a closing inline tag does not end a block
            if (depth := stack.depth(tag)) and (tag in BLOCKS or tag == "head" or depth > innermost):
                stack.cut(depth)
            continue
        if stack.depth("head") and tag not in HEAD:
            stack.cut(stack.depth("head"))
        if tag in ("html", "body") or (tag == "head" and len(stack.nodes) > 1):
            continue
        if tag in BLOCKS and stack.blocks and stack.nodes[innermost].tag == "p":
            stack.cut(innermost)  # a block ends an open paragraph and what is open inside it
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            limit = max(map(stack.depth, limits))
            if inside := [d for e in ends if (d := stack.first_inside(e, limit))]:
                stack.cut(min(inside))
        gone, loose, mark = _marked(tag, found[3])
        node = Node(tag, gone, mark, loose)
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(text, at)
            inner = text[at : end.start() if end else n]
            node.children.append(html.unescape(inner) if tag in ("title", "textarea") else inner)
            at = end.end() if end else n
        elif tag not in VOID and (tag in BLOCKS or not found[3].endswith("/")):
            stack.push(node)
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Decides on marks that depend on what an element holds."""
    order = list(_walk(root))
    at = {id(x): i for i, x in enumerate(order)}
    # by element, with all it holds: articles, mains, text, linked text, sentences (one for a text node), links
    sums = [[x.tag == "article", x.tag == "main", 0, 0, 0, 0] for x in order]
    for i in range(len(order) - 1, -1, -1):
        node, mine = order[i], sums[i]
        for c in node.children:
            if isinstance(c, Node):
                theirs = sums[at[id(c)]]
                if c.gone and not theirs[0] and not theirs[1]:
                    continue
                mine[:4] = [a + b for a, b in zip(mine, theirs[:4])]
                mine[4] += theirs[4]
                mine[5] += theirs[5] + (c.tag == "a")
            elif words := c.strip():
                mine[2] += len(words)
                mine[4] += node.tag != "a" and bool(_SENTENCE.search(words))
        if node.tag == "a":
            mine[3] = mine[2]
    articles, mains = sums[0][:2]
    most = max((mine for node, mine in zip(order, sums) if node.tag == "main" and not node.gone), key=lambda x: x[2], default=None)
    for node, (a, m, size, linked, sentence, links) in zip(order, sums):
        whole = bool((a and a == articles) or (m and m == mains))
        if whole and node.tag == "article" and not m and most and most[4] > sentence and most[2] > 2 * size:
            whole = False  # the main element beside a marked article holds more, in sentences
        if node.gone and whole and (node.tag not in GONE or node.tag in WRAPS):
            node.gone = False
        elif node.loose and not whole:
            node.gone = 2 * linked >= size or not sentence
        elif not articles and not mains and node.tag in LISTS and links >= 3 and linked == size:
            node.gone = True


def subtree_hashes(root: Node) -> dict[int, int]:
    """64-bit hash of every element but inline ones, by id() of its node."""
    out: dict[int, int] = {}
    made: dict[int, bytes] = {}
    for node in reversed(list(_walk(root))):
        state = hashlib.blake2b(f"{node.tag}|{node.mark}".encode("utf-8", "replace"), digest_size=8)
        for c in node.children:
            state.update(made.pop(id(c)) if isinstance(c, Node) else b"\x00" + _SPACE.sub(" ", c).strip().encode("utf-8", "replace"))
        made[id(node)] = digest = state.digest()
        if node.tag not in INLINE and node.tag not in WHOLE:
            out[id(node)] = int.from_bytes(digest, "big", signed=True)
    return out


def content_root(root: Node) -> list[Node]:
    """The outermost articles, or else main, that are not themselves removed; or the whole page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == wanted and not node.gone:
                found.append(node)
            elif not node.gone:
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return [root]


def _walk(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def main_text(page: str | None, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the article, joined by an empty line."""
    if not page:
        return ""
    root = parse(page)
    if not templates:
        return "\n\n".join(_blocks(root))
    return "\n\n".join(_blocks(root, {id(node) for node, _, keys in candidates(root) if not templates.isdisjoint(keys)}))


def _blocks(root: Node, removed: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """The blocks of text of a tree without the elements removed (by id() of the node)."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if words := _SPACE.sub(" ", "".join(line)).strip():
            blocks.append(words)
        line.clear()

    for start in content_root(root):
        todo: list = [start]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                line.append(item)
            elif item is None:
                flush()
            elif item.gone or id(item) in removed:
                if item.tag in BLOCKS:
                    flush()
                if start.tag == "article" and id(item) not in removed:
                    todo += reversed(_titles(item))
            elif item.tag == "br":
                line.append(" ")
            else:
                if item.tag in BLOCKS:
                    flush()
                    todo.append(None)
                todo += reversed(item.children)
        flush()
    return blocks


def _titles(node: Node) -> list[Node]:
    """The headings of an article's own header; of any other element that goes, none."""
    if node.tag != "header" or any(_is_mark(n, MARKS - {"header", "masthead"}) for n in node.mark.split()):
        return []
    found, todo = [], [node]
    while todo:
        item = todo.pop()
        if item.tag in HEADINGS:
            found.append(item)
        else:
            todo += [c for c in reversed(item.children) if isinstance(c, Node) and not c.gone]
    return [x for x in found if not x.gone]


def host(url: Column) -> Column:
    """Host of a url in small letters, without its port; "" if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def prose_holders(start: Node) -> set[int]:
    """id() of the elements of a content that are prose or wrap it."""
    order: list[tuple[Node, int]] = []
    flags: list[list[bool]] = []  # of each element: prose, heading, link
    todo = [(start, -1, False, start.tag)]
    while todo:
        node, above, linked, block = todo.pop()
        linked, block = linked or node.tag == "a", node.tag if node.tag in BLOCKS else block
        at, said = len(order), [False, False, False]
        order.append((node, above))
        flags.append(said)
        for c in node.children:
            if isinstance(c, Node):
                if not c.gone:
                    todo.append((c, at, linked, block))
            elif c.strip():
                if linked:
                    said[2] = True
                elif block in HEADINGS:
                    said[1] = True
                elif block in TEXTS or _SENTENCE.search(c):
                    said[0] = True
    out = set()
    for (node, above), said in zip(reversed(order), reversed(flags)):
        if said[0] or (said[1] and not said[2]):
            out.add(id(node))
        if above >= 0:
            flags[above][:] = [a or b for a, b in zip(flags[above], said)]
    return out


def _key(digest: int, side: str, place: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{digest}|{side}|{place}".encode(), digest_size=8).digest(), "big", signed=True)


def candidates(root: Node) -> Iterator[tuple[Node, int, list[int]]]:
    """Elements that may be template and change the text (inside the content, not already removed),
    their kind, and the hashes under which they are counted."""
    hashes = subtree_hashes(root)
    for start in content_root(root):
        inside = start is not root
        prose = prose_holders(start) if inside else ()
        order, todo, leaves = [], list(reversed(start.children)), []
        while todo:
            node = todo.pop()
            if isinstance(node, Node) and not node.gone:
                order.append(node)
                todo += reversed(node.children)
        for node in order:
            if id(node) not in hashes:
                continue
            if id(node) not in prose:
                kind = ITEM if node.tag in ITEMS else PROSE_OUTSIDE if not inside and node.tag in PROSE else BOX
                yield node, kind, [hashes[id(node)]]
            elif not any(isinstance(c, Node) and c.tag in BLOCKS for c in node.children):
                leaves.append(node)
        n = len(leaves)
        for i in {*range(min(EDGE, n)), *range(max(0, n - EDGE), n)} if n > 1 else ():
            digest = hashes[id(leaves[i])]
            yield leaves[i], PROSE_INSIDE, [*([_key(digest, "first", i)] if i < EDGE else []), *([_key(digest, "last", n - i)] if n - i <= EDGE else [])]


def _text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _words(node: Node) -> str:
    return _SPACE.sub(" ", "".join(c for x in _walk(node) if not x.gone for c in x.children if isinstance(c, str))).strip()


def read_page(page: str) -> tuple[str, int, list[tuple[int, int, int]]]:
    """The text without regard to templates, the hash of that, and (hash, content, kind) of each
    subtree that may be template."""
    root = parse(page)
    blocks = _blocks(root)
    text = "\n\n".join(blocks)
    content, out = _text_hash(text), set()
    longest = [_text_hash(b) for b in sorted(set(blocks), key=lambda b: (-len(b), b))[:2]] + [0, 0]
    for node, kind, keys in candidates(root):
        around = content if kind in (BOX, ITEM) else longest[1] if _text_hash(_words(node)) == longest[0] else longest[0]
        out.update((k, around, kind) for k in keys)
    return text, content, sorted(out)


_TREE = "struct<hash:long,content:long,kind:int>"
_SUBTREE = pa.list_(pa.struct([("hash", pa.int64()), ("content", pa.int64()), ("kind", pa.int32())]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = [read_page(p) if p else ("", _text_hash(""), []) for p in part.column("html").to_pylist()]
            trees = [[{"hash": h, "content": c, "kind": k} for h, c, k in r[2]] for r in rows]
            columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array(trees, _SUBTREE)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "key", "host")), *columns], names=["page_id", "url", "key", "host", "text", "content", "trees"])


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, key, host, text without regard to templates, content, and the subtrees of each page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return materialize(_keyed(pages).mapInArrow(_read, f"page_id {kind}, url string, key long, host long, text string, content long, trees array<{_TREE}>"), "subtrees")


def site_templates(seen: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, hash, pages of what is template: so many distinct contents. seen: from read_pages."""
    size = seen.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("on_host"))
    trees = seen.select("host", F.explode("trees").alias("x")).select("host", "x.hash", "x.content", "x.kind")
    often = trees.groupBy("host", "hash", "kind").agg(F.count("*").alias("rows")).where(F.col("rows") >= F.when(F.col("kind") == PROSE_INSIDE, INNER_PAGES).otherwise(min_pages))
    often = materialize(often.select("host", "hash", "kind"), "often")
    trees = trees.join(often, ["host", "hash", "kind"])
    counts = trees.distinct().groupBy("host", "hash", "kind").agg(F.count("*").alias("pages"))
    n = F.col("on_host")
    outer = F.greatest(F.lit(min_pages), F.least(n * min_share, F.sqrt(n * F.lit(float(SHARE_TO))) * min_share))
    need = F.when(F.col("kind") == PROSE_INSIDE, F.greatest(F.lit(INNER_PAGES), n * INNER_SHARE))
    need = need.when(F.col("kind") == BOX, outer).otherwise(F.greatest(F.lit(min_pages), n * min_share))
    return counts.join(size, "host").where(F.col("pages") >= need).select("host", "hash", "pages")


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"), F.xxhash64(host(F.col("url"))).alias("host"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, frozenset(t)) for page, t in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text and n_chars of each row of pages (page_id, url, html)."""
    seen = read_pages(pages)
    templates = site_templates(seen, min_pages, min_share).select("host", "hash")
    own = seen.select("key", "host", F.explode("trees.hash").alias("hash")).join(templates, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("templates"))
    own = materialize(own, "templates")  # its size is known before the joins are planned
    kind = pages.schema["page_id"].dataType.simpleString()
    again = _keyed(pages).join(own, "key").select("page_id", "url", "html", "templates").mapInArrow(_texts, f"page_id {kind}, url string, text string")
    every = seen.join(own, "key", "left_anti").select("page_id", "url", "text").unionByName(again)
    return every.withColumn("n_chars", F.length("text").cast("long"))
