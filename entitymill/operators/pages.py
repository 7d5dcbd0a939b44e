"""Fields and listings of HTML pages, without a parser library.

A page becomes a tree of elements by the standard library's tokeniser, with the implied ends of list
items, paragraphs, terms and cells. Extractors are plain functions of a tree, and run in Arrow
batches (`extract`); the page's other columns don't pass through Python.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_ENDS = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_FENCE = {"ul", "ol", "dl", "table", "tbody", "thead", "div", "section", "article", "body", "main"}


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent: "Element | None"):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def nodes(self) -> Iterator["Element | str"]:
        """Everything inside, in page order, without recursion: pages may nest without end."""
        todo = list(reversed(self.children))
        while todo:
            yield (node := todo.pop())
            if isinstance(node, Element):
                todo += reversed(node.children)

    def walk(self) -> Iterator["Element"]:
        return (n for n in self.nodes() if isinstance(n, Element))

    def strings(self) -> Iterator[str]:
        return (n for n in self.nodes() if isinstance(n, str))

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def all(self, *tags: str, cls: str | None = None, part: str | None = None) -> list["Element"]:
        """Descendants by tag, by a class, or by a part of the class attribute."""
        return [e for e in self.walk() if (not tags or e.tag in tags) and (cls is None or cls in e.classes()) and (part is None or part in (e.attrs.get("class") or ""))]

    def one(self, *tags: str, **how) -> "Element | None":
        return next(iter(self.all(*tags, **how)), None)

    def up(self, tag: str) -> "Element | None":
        e = self.parent
        while e is not None and e.tag != tag:
            e = e.parent
        return e

    def text(self, sep: str = "") -> str:
        return sep.join(t for s in self.strings() if (t := s.strip()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)
        self.open: Counter[str] = Counter()

    def _leave(self, to: Element) -> None:
        while self.at is not to:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        ends = _ENDS.get(tag, ())
        if any(self.open[t] for t in ends):
            e = self.at
            while e.parent is not None and e.tag not in _FENCE:
                if e.tag in ends:
                    self._leave(e.parent)
                    if tag != "tr":
                        break
                e = e.parent
        e = Element(tag, dict(attrs), self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        if self.open[tag]:
            e = self.at
            while e.tag != tag:
                e = e.parent
            self._leave(e.parent)

    def handle_data(self, data):
        self.at.children.append(data)


def tree(page: str, without: tuple[str, ...] = ()) -> Element:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    if without:
        todo = [builder.root]
        while todo:
            e = todo.pop()
            e.children = [c for c in e.children if not (isinstance(c, Element) and c.tag in without)]
            todo += [c for c in e.children if isinstance(c, Element)]
    return builder.root


#: Elements that hold no fields; places of the main content in the order of trial.
CHROME = ("script", "style", "noscript", "header", "footer", "nav", "form", "aside")


def content_root(root: Element) -> Element:
    """The first of the usual main elements that holds fields, else the body."""
    by_id = lambda name: next((e for e in root.walk() if e.attrs.get("id") == name), None)
    for e in (root.one("main"), root.one("article"), by_id("main"), by_id("content"), by_id("wrapper"), root.one(cls="main"), root.one(cls="content")):
        if e is not None and (e.one("dl") or e.one("th")):
            return e
    return root.one("body") or root


def _pairs(at: Element) -> Iterator[tuple[str, str]]:
    for dl in at.all("dl"):
        for dt, dd in zip(dl.all("dt"), dl.all("dd")):
            yield dt.text(), dd.text(" ")
    for row in (r for t in at.all("table") for r in t.all("tr")):
        th, td = row.one("th"), row.one("td")
        if th and td:
            yield th.text(), td.text(" ")


def structured_fields(page: str) -> dict[str, str]:
    """Label and value of terms and table rows; later ones replace earlier ones."""
    return {k: v for k, v in _pairs(content_root(tree(page, CHROME))) if k and v}


#: Chrome of a press site; releases that are kept.
PRESS_CHROME, RELEASES = ("script", "style", "noscript", "header", "footer", "nav"), 3


def _releases(root: Element) -> list[tuple[str, str]]:
    """(title, date) of the first releases: articles with a heading."""
    out = []
    for article in root.all("article"):
        title = article.one("h2", "h3", "h4")
        when = article.one("time") or next((e for e in article.walk() if "date" in (e.attrs.get("class") or "").lower()), None)
        if title is not None and len(out) < RELEASES:
            out.append((title.text(), when.text() if when is not None else ""))
    return out


def release_fields(page: str) -> dict[str, str]:
    """Fields of a press site, with its first releases as JSON."""
    root = tree(page, PRESS_CHROME)
    out = {k: v for k, v in _pairs(root) if k and v}
    releases = [{"title": t, "date": d} for t, d in _releases(root)]
    return out | ({"__press_releases__": json.dumps(releases, ensure_ascii=False)} if releases else {})


def release_text(page: str, limit: int = 6000) -> str:
    """Fields and first releases of a press site as lines for reading, cut to a limit."""
    root = tree(page, PRESS_CHROME)
    lines = [f"[FIELD: {k}] {v}" for k, v in _pairs(root) if k]
    return "\n".join([*lines, *(f"[PR: {t} | {d}]" for t, d in _releases(root))])[:limit]


def field_text(page: str, limit: int = 6000) -> str:
    """Fields as lines for reading, cut to a limit."""
    root = tree(page, CHROME)
    named = [root.one("main"), root.one("article")] + [next((e for e in root.walk() if e.attrs.get("id") == n), None) for n in ("main", "content")]
    at = next((e for e in named if e is not None), root.one("body") or root)
    return "\n".join(f"[FIELD: {k}] {v}" for k, v in _pairs(at) if k)[:limit]


def releases_in_text(text: str) -> list[tuple[str, str]]:
    """(title, date) of lines that name a release."""
    return [(a.strip(), b.strip()) for a, b in re.findall(r"\[PR: (.*?) \| (.*?)\]", text)]


#: Wordings of a number of openings, first choice first; forms of links to an opening
#: (a part of the path, its end); rows of an opening's table.
COUNT_WORDINGS = (r"募集している求人(\d+)件", r"公開求人数[^\d]*(\d+)\s*件", r"公開中の求人[^\d]*(\d+)\s*件", r"求人数[^\d]*(\d+)\s*件")
OPENING_LINKS = (("/kensaku/kyujin/", ".html"), ("/viewjob/", ""))
SALARY_ROW, FEATURES_ROW, SALARY_FIELD = "給与", "仕事の特徴", "想定年収"
SALARY = r"想定年収\s*([\d,]+万円[～〜\-－][\d,]+万円)"
SIMILAR_HEAD, SIMILAR_LEVELS, LEVELS = "この求人に似た求人を探す", "業界", 5
SIMILAR_FIELDS = {"職種": "職種_求人", "勤務地": "勤務地_求人", "スキル": "スキル", "こだわり": "こだわり"}


def opening_count(page: str) -> str | None:
    """The number of openings that the page states, by the first wording that is there."""
    text = "".join(tree(page).strings())
    hits = (re.search(wording, text) for wording in COUNT_WORDINGS)
    return next((f"{hit[1]}件" for hit in hits if hit), None)


def opening_urls(page: str, base: str, forms: tuple = OPENING_LINKS) -> list[str]:
    """Absolute links to openings; of those that differ in query or last slash only, the first."""
    links = [a.attrs.get("href") or "" for a in tree(page).all("a")]
    links = [base + u if u.startswith("/") else u for u in links if any(part in u and u.endswith(end) for part, end in forms)]
    by_key = {u.split("?")[0].rstrip("/"): u for u in reversed(links) if u.startswith("http")}
    order = dict.fromkeys(u.split("?")[0].rstrip("/") for u in links if u.startswith("http"))
    return [by_key[k] for k in order]


def opening_fields(page: str) -> dict[str, str]:
    """Salary range and features of an opening, from rows with a heading: their second cell, or the
    only one."""
    cells = {}
    for row in tree(page).all("tr"):
        head, data = row.one("h3"), row.all("td")
        if head is not None and data:
            cells.setdefault(head.text(), []).append(data[:2][-1])
    salaries = [m[1] for c in cells.get(SALARY_ROW, ()) if (m := re.search(SALARY, "".join(c.strings())))]
    features = [", ".join(tags) for c in cells.get(FEATURES_ROW, ()) if (tags := [t for x in c.all("span") if (t := x.text())])]
    return ({SALARY_FIELD: salaries[-1]} if salaries else {}) | ({FEATURES_ROW: features[-1]} if features else {})


def similar_fields(page: str) -> dict[str, str]:
    """Fields of the table behind the heading on similar openings, the trade by levels; none without
    that table."""
    head = next((e for e in tree(page).all("h2") if SIMILAR_HEAD in "".join(e.strings())), None)
    behind = head.parent.children[head.parent.children.index(head) + 1 :] if head is not None else []
    tables = (e if e.tag == "table" else e.one("table") for e in behind if isinstance(e, Element))
    if (table := next((t for t in tables if t is not None), None)) is None:
        return {}
    rows = {th.text(): td for r in table.all("tr") if (th := r.one("th")) is not None and (td := r.one("td")) is not None}
    trade = [a.text() for a in rows[SIMILAR_LEVELS].all("a")] if SIMILAR_LEVELS in rows else []
    out = {f"{SIMILAR_LEVELS}_階層{i + 1}": t for i, t in enumerate((trade + [""] * LEVELS)[:LEVELS])}
    return out | {field: rows[label].text() if label in rows else "" for label, field in SIMILAR_FIELDS.items()}


#: Metrics of the tables of a financial page, by place; the metric whose growth is told.
METRICS = (("売上高", "営業利益"), ("自己資本率",), ("ROE",), ("営業CF", "フリーCF"))
SALES, SALES_GROWTH, PERIODS = "売上高", "売上成長率", 3


def metric_rows(page: str) -> list[tuple[str, str, str]]:
    """(metric, period, value) of the tables of a financial page, newest first; none if one is missing.
    A metric is the column whose heading names it; a heading that names several counts for the first."""
    tables, out = tree(page).all("table"), []
    for table, metrics in zip(tables, METRICS) if len(tables) >= len(METRICS) else ():
        head, *rows = table.all("tr") or [Element("tr", {}, None)]
        names = [next((m for m in metrics if m in h.text()), None) for h in head.all("th")]
        body = [(th, r.all("td")) for r in rows if (th := r.one("th")) is not None]
        for metric in dict.fromkeys(n for n in names if n):
            column = len(names) - 2 - names[::-1].index(metric)  # the last such heading; the first is the period's
            values = [(re.sub(r"\(.*?\)", "", th.text()).strip(), cells[column].text()) for th, cells in body if 0 <= column < len(cells)]
            out += [(metric, period, value) for period, value in values[:PERIODS]]
    return out


def _number(value: str) -> float | None:
    try:
        return float(value.replace(",", "").replace("―", "0"))
    except ValueError:
        return None


def financial_fields(page: str) -> dict[str, str]:
    """Metrics by period, with the growth of sales on the period before."""
    rows = metric_rows(page)
    sales = [(period, _number(value)) for metric, period, value in rows if metric == SALES]
    growth = {f"{SALES_GROWTH}_{p}": f"{(a - b) / abs(b) * 100:.1f}%" for (p, a), (_, b) in zip(sales, sales[1:]) if a is not None and b}
    return {f"{metric}_{period}": value for metric, period, value in rows} | growth


@dataclass(frozen=True)
class Site:
    """How a listing is read: a row for each `card`, with the first of `name` that has a text, `title`
    and `date`. A place is a path of steps `tag`, `tag.class` or `tag[part of class]`, each the first
    inside the one before; "." is the card, "^tag" its nearest such ancestor, and "*" at the end takes
    the first match that `words` and `parts` don't rule out. Without a card, `heads` is a pattern for
    the page's titles, or `text` one for its text."""

    card: tuple[str, ...] = ()
    name: tuple[str, ...] = (".",)
    title: str = ""
    date: str = ""
    dates: str = ""
    century: str = ""
    last_date: bool = False
    heads: str = ""
    text: str = ""
    words: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    least: int = 2
    once: bool = False


#: Places, patterns and words of the sites.
SITES: dict[str, Site] = {
    "labbase": Site(("section",), ("h3",), words=("検索条件", "新着企業", "おすすめ", "人気企業"), once=True),
    "talentbook": Site(heads=r"^(.*?)(?: \| |$)"),
    "type_shinsotsu": Site((".card-company", ".card"), (".card-head-title", "h3"), least=1),
    "onecareer": Site(heads=r"^(.+?)の新卒採用", least=0),
    "levtech_rookie": Site(("div.companyCard",), ("p.name",)),
    "bizreach_campus": Site(("[company]",), parts=("ビズリーチ",)),
    "offerbox": Site(("p.link-list__tit",)),
    "en_tenshoku": Site(("div.companyName",), ("span.company", "."), title="^div div.jobName"),
    "kimisuka": Site(text=r"(?:株式会社[\w・ー]+|[\w・ー]+株式会社)", least=4, once=True),
    "caritasu": Site(("div.c_panelCompanyInfoMain__ttlBox",), once=True),
    "career_ticket": Site(("li.p-companyCard",), ("p.p-companyCard__ttl",)),
    "bizreach": Site(("li[JobListItem]",), ("[grow-1] p[bold]", "p[bold] *"), title="h3[JobTitle]", words=("気になる",), parts=("万円",), least=1),
    "en_ambi": Site(("div.jobUnit",), ("span.companyName",), title="a.catch", date="div.term span.data", dates=r"(\d{2})/(\d{2})/(\d{2})", century="20", last_date=True, least=1),
    "type_chuto": Site(("p.company",), title="^article h3.mod-job-info-text", date="^article p.end-date", dates=r"(\d{4})\.(\d{2})\.(\d{2})"),
}


def _matches(scope: Element, step: str) -> list[Element]:
    tag, cls, part = re.fullmatch(r"(\w*)(?:\.([\w\-]+))?(?:\[([\w\-]+)\])?", step).groups()
    return scope.all(*([tag] if tag else []), cls=cls, part=part)


def _ruled_out(site: Site, name: str) -> bool:
    return name in site.words or any(p in name for p in site.parts)


def _text_at(site: Site, card: Element, path: str) -> str | None:
    """The text at a path from a card; None if there is no such place."""
    at: Element | None = card
    steps = path.split()
    for i, step in enumerate(steps):
        if at is None or step == ".":
            break
        if i + 1 < len(steps) and steps[i + 1] == "*":
            return next((t for e in _matches(at, step) if (t := e.text()) and not _ruled_out(site, t)), None)
        at = at.up(step[1:]) if step[0] == "^" else next(iter(_matches(at, step)), None)
    return at.text() if at is not None else None


def _date(site: Site, text: str) -> str:
    found = re.findall(site.dates, text)
    return site.century + "-".join(found[-1 if site.last_date else 0]) if found else ""


def _names(site: Site, root: Element) -> Iterator[tuple[str, str, str]]:
    if site.heads:
        heads = [e.attrs.get("content") or "" for e in root.all("meta") if e.attrs.get("property") == "og:title"][:1]
        heads += [e.text() for e in root.all("title")[:1]]
        names = (m[1].strip() for h in heads if h and (m := re.match(site.heads, h)))
        yield from ((n, "", "") for n in [n for n in names if len(n) >= site.least][:1])
    elif site.text:
        yield from ((n, "", "") for n in re.findall(site.text, "".join(root.strings())))
    else:
        starred = any("*" in path for path in site.name)
        cards = next((c for step in site.card if (c := _matches(root, step))), [])
        for card in cards:
            found = (_text_at(site, card, path) for path in site.name)
            # a place that is there counts for the text; one that may be empty gives way to the next
            name = next((t for t in found if t or (t is not None and not starred)), None if not starred else "")
            if name is not None and (starred or not _ruled_out(site, name)):
                yield name, _text_at(site, card, site.title) or "" if site.title else "", _date(site, _text_at(site, card, site.date) or "") if site.date else ""


def listing(site: Site, page: str) -> list[tuple[str, str, str]]:
    """(name, title, date) rows of a listing, without names that are too short, or that were there before."""
    rows = [r for r in _names(site, tree(page)) if len(r[0]) >= site.least]
    first: dict[str, tuple[str, str, str]] = {}
    for r in rows:
        first.setdefault(r[0], r)
    return list(first.values()) if site.once else rows


#: Listing readers by site: page to (name, title, date) rows.
LISTINGS: dict[str, Callable[[str], list[tuple[str, str, str]]]] = {name: partial(listing, site) for name, site in SITES.items()}


def fields_of(page: str) -> list[tuple[str, str]]:
    return list(structured_fields(page).items())


def extract(pages: DataFrame, key: str, html: str, function: Callable[[str], list[tuple]], names: list[str]) -> DataFrame:
    """key, pos (from 0) and the text columns `names` of each row that function finds in a page.
    A null page has none."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, who, pos = [], [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                found = function(page) if page else []
                rows += found
                who += [i] * len(found)
                pos += range(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who, pa.int32())), pa.array(pos, pa.int32()), *(pa.array([r[j] for r in rows], pa.string()) for j in range(len(names)))], names=[key, "pos", *names])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, pos int, " + ", ".join(f"`{n}` string" for n in names))


def titles(pages: DataFrame) -> DataFrame:
    """The title of a page by pattern alone, in the JVM."""
    return pages.select("page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"))


def links(pages: DataFrame) -> DataFrame:
    """Every link target of a page with its place, in the JVM."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
