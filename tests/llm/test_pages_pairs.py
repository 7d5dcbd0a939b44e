"""HTML, near duplicates, neighbours, preferences, mixing, pipeline: brute force and edge cases."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitymill.llm import html, minhash, mixing, preference, vptree
from entitymill.llm.common import materialize

# ---------------------------------------------------------------- html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/>home</a></ul></nav><!-- ad --><div class="ad">buy</div><div id=cookie-notice>cookies</div>
<article><h1>Head &amp; more</h1><p><b>One <i>two</i><br>three<p>caf&#233;&nbsp;x</p><aside>side</aside><form><input value=x>f</form>
<div class="user-comments"><p>first!</p></div><ul><li>a<li>b</ul></article><footer>&copy; x</footer>"""


def test_main_text():
    assert html.main_text(PAGE) == "Head & more\n\nOne two three\n\ncafé x\n\na\n\nb"
    assert html.main_text(None) == html.main_text("") == ""
    assert html.main_text("plain & <b>bold") == "plain & bold"
    assert html.main_text("<p>a<!-- <p>no") == "a"
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


def test_templates(spark):
    rows = [(i, f"http://H.com:80/{i}", f"<body><div><span>menu</span><div>Same box</div></div><p>Copied prose</p><p>own {i}</p></body>") for i in range(8)]
    rows += [(100, "http://other.com/", "<body><div>Same box</div><p>x</p></body>"), (101, None, None), (102, "odd", ""), (100, "http://other.com/", "<body><div>Same box</div><p>x</p></body>"), (None, "u", "<p>n</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("key", F.lit(1))
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html.extract_pages(df).collect()), key=str)
    want = [(i, f"Copied prose\n\nown {i}", len(f"Copied prose\n\nown {i}")) for i in range(8)]
    want += [(100, "Same box\n\nx", 11)] * 2 + [(101, "", 0), (102, "", 0), (None, "n", 1)]
    assert got == sorted(want, key=str)
    assert html.extract_pages(df.limit(0)).count() == 0


def test_copies_are_no_templates(spark):
    """Copies of an article, repeated rows, and prose in lists and cells stay; a box of links goes."""
    copy = "<nav>n{}</nav><article><div><p>text</p></div><div>label</div><ul><li>one</li></ul></article>"
    rows = [(i, "http://copies.com/", copy.format(i)) for i in range(6)]
    rows += [(10, "http://rows.com/", "<div>Same box</div><p>x</p>")] * 6
    cells = "<article><p>own {}</p><table><tr><td>0</td></tr></table><ul><li>Yes</li></ul><div>A sentence.</div><div><h2>Start</h2></div><div><h3>More</h3><ul><li><a href=\"/\">home</a></ul></div></article>"
    rows += [(20 + i, "http://cells.com/", cells.format(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in html.extract_pages(df).collect())
    want = [(i, "text\n\nlabel\n\none") for i in range(6)] + [(10, "Same box\n\nx")] * 6
    assert got == want + [(20 + i, f"own {i}\n\n0\n\nYes\n\nA sentence.\n\nStart") for i in range(6)]


def test_markup_never_leaks_and_articles_stay():
    cases = {
        '<a href="x>text</a><p class="y">more</p>': "text\n\nmore",
        '<p title="a > b">ok<p title=it\'s>fine</p>': "ok\n\nfine",
        '<div class="content has-sidebar"><article><p>keep</p></article></div>': "keep",
        '<div id="page-header-fixed"><main><p>keep</p></main></div>': "keep",
        '<div class="sidebar"><article>teaser</article></div><article>real</article>': "real",
        '<article><p>x.</p><div class="related-work"><p>They did it.</p></div><div class="related"><a href=1>a</a> <a href=2>b</a></div></article>': "x.\n\nThey did it.",
        '<main><article>A</article><article class="comment">C</article></main>': "A",
        '<main><article id="comment-3">C</article><article class="post-1 category-notices comments-open">A</article></main>': "A",
        '<main><p>Body of the page. It is long enough.</p><article class="comment"><p>First!</p></article></main>': "Body of the page. It is long enough.",
        '<main><article class="notice"><p>The only one.</p></article><p>Tail</p></main>': "The only one.",
        '<main><article class="sidebar"><p>All.</p></article></main>': "All.",
        "<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by me</p></header><p>x</p></article>": "Title\n\nx",
        '<article><header class="entry-header"><nav><h3>n</h3></nav><hgroup><h1>T <i>u</i></h1><h2>v</h2></hgroup>12 May</header><p>x</p><footer><h4>f</h4></footer></article>': "T u\n\nv\n\nx",
        '<article><header class="ad-banner"><h1>Buy</h1></header><p>x</p></article>': "x",
        "<main><header><h1>Site</h1></header><p>x</p></main>": "x",
        "<form id=f><div class=menu><a>m</a></div><article>in form</article></form>": "in form",
        "<head><title>t</title><p>no body tag</p>": "no body tag",
        "<ul><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>text with <a>a link</a></p>": "text with a link",
        "<!--> a <!-- b --!> c": "a c",
        "<table><tr><td>1<td>2<tr><td>3</table>": "1\n\n2\n\n3",
    }
    assert {page: html.main_text(page) for page in cases} == cases


def test_parse_is_linear():
    def seconds(n):
        page = "<em><div>" + "<div>" * n + "x" + "</span></b></section>" * n + "<b>" * n + "</em></em>" * n
        start = time.perf_counter()
        assert html.main_text(page) == "x"
        return time.perf_counter() - start

    assert seconds(16000) < 20 * max(seconds(2000), 0.01)


def brute_pages(rows):
    """Texts by counts in dictionaries, over the whole table."""
    seen, counts, sizes = [], defaultdict(set), defaultdict(set)
    for page_id, url, page in rows:
        found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "", re.I)
        site = found[1].lower() if found else ""
        text, content, trees = html.read_page(page) if page else ("", html._text_hash(""), [])
        sizes[site].add(content)
        seen.append((site, {h for h, _, _ in trees}))
        for h, around, kind in trees:
            counts[site, h, kind].add(around)
    templates = set()
    for (site, h, kind), contents in counts.items():
        n = len(sizes[site])
        need = max(8, 0.67 * n) if kind == html.PROSE_INSIDE else max(5, min(0.05 * n, 0.05 * (50 * n) ** 0.5) if kind == html.BOX else 0.05 * n)
        if len(contents) >= need:
            templates.add((site, h))
    return sorted(((p, u, html.main_text(page, {h for h in own if (site, h) in templates})) for (p, u, page), (site, own) in zip(rows, seen)), key=str)


def test_counts_decide_without_an_article(spark):
    """Pages without article, main or class words: only what recurs tells the site from the text."""
    boxes = "<div><p>The best site of all. Read on.</p></div><div><span>Shop</span></div>"
    rows = [(i, "http://plain.com/", f"<div>{boxes}<div><p>Text {i} of its own.</p><p>And a longer part of it, {'more ' * i}as pages have.</p></div><div><p>Call us today.</p></div></div>") for i in range(9)]
    rows += [(20 + i, "http://few.com/", f"<div>{boxes}<p>Text {i}.</p></div>") for i in range(4)]
    share = "<article><p>Own start {0}, longer than that line.</p><p>Own {1}end.</p><p>Tell your friends.</p></article>"
    rows += [(40 + i, "http://lines.com/", share.format(i, "so " * i)) for i in range(10)]
    # near copies of one article, without an article element: one long paragraph is in all
    rows += [(60 + i, "http://copies.com/", f"<p>{'Long and the same. ' * 9}</p><p>Same again.</p><p>Edit {i}.</p>") for i in range(8)]
    got = sorted(((r.page_id, r.url, r.text) for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    assert got == brute_pages(rows)
    text = {i: t for i, _, t in got}
    assert text[3] == "Text 3 of its own.\n\nAnd a longer part of it, more more more as pages have."
    assert text[22] == "The best site of all. Read on.\n\nShop\n\nText 2."
    assert text[42] == "Own start 2, longer than that line.\n\nOwn so so end."
    assert text[63].startswith("Long and the same.") and text[63].endswith("Edit 3.")


def test_pages_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = sorted(((r.page_id, r.url, r.text) for r in html.extract_pages(pages).collect()), key=str)
    assert got == brute_pages(rows)


# ---------------------------------------------------------------- near duplicates


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, base = [], [word() for _ in range(80)]
    for i in range(60):  # a large group of near copies, some over, some under the threshold
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(80)] = word()
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(word() for _ in range(r.randrange(1, 60)))) for i in range(60, 100)]
    rows += [(100, rows[70][1]), (101, rows[70][1].upper()), (102, None), (103, ""), (104, " \t"), (105, "a b"), (106, "A  b"), (107, "a b c")]
    return rows


def test_near_duplicates(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("n", F.lit(1))
    want = brute_components(rows, 4, 80)
    got = {r.doc_id: r for r in minhash.near_duplicates(df, k=4).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = minhash.keep_one(df, k=4)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_near_duplicate_edges(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df, k=4).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, 1, False), (2, 2, True)], key=str)
    assert minhash.keep_one(df, k=4).count() == 2
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_keep_one_of_each_component(spark):
    """Texts that are linked with nothing stay, also with a null doc_id or one that others have."""
    texts = ["a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x", "y z a c e g"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4])]
    rows += [(None, None), (None, None), (None, ""), (8, " \t"), (8, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_root", F.lit(0)).withColumn("root", F.lit(0))
    kept = minhash.keep_one(df, k=4)
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[4]), *rows[-5:]]
    assert kept.columns == df.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_superminhash_estimates():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    errors = []
    for share in (0.2, 0.5, 0.8):
        n = 600
        both = int(2 * n * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(pool[n - both : 2 * n - both])
        sig = minhash.signatures([a, b, a[:1]], 160)
        errors.append(abs((sig[0] == sig[1]).mean() - share))
        assert len(np.unique(sig[2] >> np.uint64(48))) == 160  # one element takes every rank once
    assert max(errors) < 0.12


def test_components_over_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "UNITE", 20)
    edges = [(bytes([0, i]), bytes([0, i + 1])) for i in range(0, 100)] + [(bytes([1, i]), bytes([1, 200])) for i in range(50)]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "u binary, v binary")
    got = {bytes(r.node): bytes(r.root) for r in minhash.components(df).collect()}
    assert {v for n, v in got.items() if n[0] == 0} == {bytes([0, 0])} and {v for n, v in got.items() if n[0] == 1} == {bytes([1, 0])}
    assert len([n for n in got if n[0] == 0]) >= 100


# ---------------------------------------------------------------- neighbours


def brute_neighbours(rows, k):
    ok = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q in ok:
        if q % 5 == 0:
            scores = [(-(ok[q] @ v) / np.sqrt((ok[q] @ ok[q]) * (v @ v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
            out += [(q, rank + 1, i, round(-s, 9)) for rank, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard", [8192, 60])
def test_neighbours(spark, shard):
    r = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=8)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 460)]  # one vector very often
    rows += [(500, None), (505, []), (510, [0.0] * 8), (515, [1.0, None] * 4), (520, [float("nan")] * 8), (525, [float("inf")] * 8), (None, [1.0] * 8), (530, [1.0, 2.0]), (531, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash")).withColumn("dim", F.lit(0))
    asked = F.col("vec_id") % 5 == 0
    got = sorted((x.query_id, x.rank, x.vec_id, round(x.score, 9)) for x in vptree.nearest(df, asked, 5, shard=shard).collect())
    want = brute_neighbours(rows, 5)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-7)
    near = {(x.query_id, x.vec_id) for x in vptree.nearest(df, asked, 5, factor=0.8, shard=shard).collect()}
    assert len(near & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    assert vptree.nearest(df.limit(0), asked, 5).count() == 0
    few = vptree.nearest(df.where("vec_id in (5, 6, 7, 400, 530)"), asked, 5, shard=shard).collect()
    assert {(x.query_id, x.vec_id) for x in few} == {(5, 6), (5, 7), (5, 400), (400, 5), (400, 6), (400, 7)}


def test_regions_are_pruned(spark):
    """Clustered vectors: at factor one the search is exact and leaves out most regions."""
    r = np.random.default_rng(4)
    centres = r.normal(size=(16, 12))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 16] + r.normal(size=12) * 0.02]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = F.col("vec_id") % 5 == 0
    want = brute_neighbours(rows, 5)
    got = sorted((x.query_id, x.rank, x.vec_id) for x in vptree.nearest(df, asked, 5, shard=60).collect())
    assert got == [w[:3] for w in want]
    index = vptree.Index(vptree.valid_vectors(df), 6, shard=60)
    n_regions, n_queries = index.regions.count(), 320
    asked_rows = index.place(vptree.valid_vectors(df).where(asked).select(F.col("vec_id").alias("q"), "embedding", "dim"))
    far = max(np.sqrt(2 - 2 * w[3]) for w in want)
    others = index.others(asked_rows.withColumn("bound", F.lit(float(far))), 1.0).count()
    assert n_regions >= 16 and others < 0.35 * n_regions * n_queries
    assert index.trees.select("dim", "region", "part").distinct().count() == index.trees.count()


# ---------------------------------------------------------------- preferences


def test_preferences(spark):
    kind = "array<struct<role:string,text:string>>"
    turns = [("system", "s"), ("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "x")]
    other = [*turns[:2], ("assistant", "bad")]
    df = spark.createDataFrame([(1, turns, other), (2, turns, turns), (3, turns, turns[:2]), (4, None, turns), (5, [], [])], f"pair_id long, chosen {kind}, rejected {kind}")
    got = {r.pair_id: r for r in preference.format_pairs(df).collect()}
    text = lambda ts: "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in ts)
    one = got[1]
    assert one.n_prompt_turns == 2 and one.prompt + one.chosen == text(turns) and one.prompt + one.rejected == text(other)
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["good<|end|>\n", "x<|end|>\n"] and [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["bad<|end|>\n"]
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected, got[2].chosen_spans) == (5, "", "", [])
    assert (got[3].n_prompt_turns, got[3].rejected) == (2, "") and (got[4].n_prompt_turns, got[4].prompt, got[4].chosen) == (0, "", "")
    assert got[5].prompt == ""


def test_swapped_replies(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (1, 0, "user", "r"), (1, 1, "assistant", "a1"), (2, 0, None, None), (None, 0, "user", "z"), (1, 1, "assistant", "a1")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))
    got = {r.pair_id: r for r in preference.format_pairs(preference.swapped_replies(df)).collect()}
    assert got[0].n_prompt_turns == 1 and "a1" in got[0].rejected and "a0" in got[0].chosen
    assert got[1].n_prompt_turns == 2 and len(got) == 4 and got[2].rejected == ""
    assert preference.format_pairs(preference.swapped_replies(df.limit(0))).count() == 0


def test_long_and_null_conversations(spark):
    """Spans behind many turns are where brute force finds them; rows without a conv_id stay apart."""
    r = random.Random(5)
    turns = [(1, i, r.choice(["user", "assistant"]), "é" * r.randrange(0, 40)) for i in range(700)] + [(None, 0, "user", "a" * 5000), (None, 0, "assistant", "b"), (None, 0, "assistant", "b")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = preference.format_pairs(preference.swapped_replies(df)).collect()
    own = [x for x in got if x.pair_id is None]
    assert sorted(x.chosen for x in own) == sorted([preference.OPEN + "user|>\n" + "a" * 5000 + "<|end|>\n"] + ["<|assistant|>\nb<|end|>\n"] * 2)
    assert all(x.rejected == "" and x.rejected_spans == [] for x in own)
    whole = preference.format_pairs(df.where("conv_id = 1").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t")).select(F.col("conv_id").alias("pair_id"), F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("chosen"), F.array().cast("array<struct<role:string,text:string>>").alias("rejected"))).first()
    spans, at = [], 0
    for _, _, role, text in turns[:700]:
        shown = f"<|{role}|>\n{text}<|end|>\n"
        if role == "assistant":
            spans.append((at + len("<|assistant|>\n"), at + len(shown)))
        at += len(shown)
    assert [tuple(x) for x in whole.chosen_spans] == spans and len(whole.chosen) == at


# ---------------------------------------------------------------- mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    out, left, live = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while live and left > 1e-9:
        level = left / sum(w[s] for s in live)
        over = {s for s in live if level * w[s] >= epochs * sizes[s]}
        if not over:
            for s in live:
                out[s] = level * w[s]
            break
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        live -= over
    return out


def test_mix(spark):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randrange(0, 200)), r.choice(["a", "a", "a", "b", "é", None])) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "x y", "b"), (5, "x y z", "b"), (5, "x y z", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("bucket", F.lit(0))
    got = mixing.mix_documents(df).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for (_, t, s) in rows:
        sizes[s] += len((t or "").split())
    ids = {(d, len((t or "").split())): s for d, t, s in rows}
    target = {}
    for g in got:
        s = ids[g.doc_id, g.size]
        taken[s] += g.taken
        target[s] = g.target
        assert 0 <= g.taken <= 2 * g.size and g.source_size == sizes[s]
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 5
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_documents(df).collect()))
    empty = mixing.mix_documents(df.where("size = 'no'"))
    assert empty.count() == 0
    none = mixing.mix_documents(df.withColumn("text", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows) and all(g.taken == 0 and g.target == 0 for g in none)


def test_schedule_is_even(spark):
    goal = spark.createDataFrame([("a", 60.0), ("b", 30.0), (None, 10.0)], "source string, target double")
    plan = sorted(mixing.schedule(goal, 1000).collect(), key=lambda r: r.slot)
    assert [r.slot for r in plan] == list(range(1000))
    for n in (50, 333, 1000):
        for s, share in (("a", 0.6), ("b", 0.3), (None, 0.1)):
            assert abs(sum(r.source == s for r in plan[:n]) - n * share) <= 3
    for s in ("a", "b", None):
        assert [r.rank for r in plan if r.source == s] == list(range(sum(r.source == s for r in plan)))


def test_mix_takes_rare_sources(spark):
    """Sources far smaller than a slot are taken to their targets, as is every other source."""
    sizes = {"big": 600, **{f"rare{i:02}": 1 for i in range(12)}, None: 1}
    rows = [(f"{s} {i}", " ".join(["w"] * 10 if s == "big" else ["w"] * 3), s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = mixing.mix_documents(df, slot_words=512, slots=1).collect()
    taken, target = defaultdict(int), {}
    for g in got:
        taken[g.doc_id.split()[0]] += g.taken
        target[g.doc_id.split()[0]] = g.target
    assert len(target) == 14 and min(target.values()) > 0
    assert all(0 <= taken[s] - target[s] < 1 + 1e-6 for s in target)
    _, plan, segments = mixing.mix(df, slot_words=512, slots=1)
    plan = sorted(plan.collect(), key=lambda r: r.slot)
    assert [r.slot for r in plan] == list(range(len(plan))) and len({r.source for r in plan}) == 14
    for s in sizes:
        assert [r.rank for r in plan if r.source == s] == list(range(sum(r.source == s for r in plan)))
    assert segments.groupBy("source", "rank").agg(F.sum("words").alias("w")).agg(F.max("w")).first()[0] <= 512


def test_schedule_is_golden_at_many_slots():
    """Gaps between the points stay below twice a slot's width, also for millions of slots."""
    n = 3_000_000
    points = np.sort(np.arange(n, dtype=np.int64) * mixing.STEP % mixing.MODULUS) / mixing.MODULUS
    assert np.diff(points, append=points[0] + 1).max() * n < 2


# ---------------------------------------------------------------- pipeline


def brute_good(docs, labels):
    """doc_ids that the classifier keeps, by a loop over texts: random indexing, pooling, then the network."""
    import zlib

    from entitymill.llm import quality as q

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(10)).alias("part")).collect()
    known = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    sample = sorted((r for r in rows if r.doc_id in known), key=lambda r: r.doc_id)
    words = np.zeros((q.BUCKETS, q.DIM))
    for r in sample:
        if r.part < 5:
            for found in q.tokens(r.text):
                for b, n in zip(*np.unique(found, return_counts=True)):
                    words[b] += round(float(np.log1p(n)) * 65536) * q.index_vector(r.h)
    words = (words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def pooled(text):
        return np.concatenate([words[found].astype(np.float64).sum(axis=0) / max(1, len(found)) for found in q.tokens(text)])

    taught = [r for r in sample if r.part >= 5]
    model = q.fit(words, np.stack([pooled(r.text) for r in taught]), np.array([known[r.doc_id] for r in taught], float), np.array([r.part == 9 for r in taught]))
    return {r.doc_id for r in rows if model.scores(pooled(r.text)[None, :])[0] >= 0.3}


def test_pipeline(spark):
    """Each stage against brute force on what the one before kept."""
    import math
    from collections import Counter

    import corpus_pipeline as c
    import public_tokenizers as P
    from test_texts import RANKS, brute_lines

    from entitymill.llm import bpe, quality
    from entitymill.llm.common import materialize

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    out, before = {}, docs
    for name, stage in c.STAGES:
        out[name] = before = materialize(stage(spark, before, sf), name)
    good = text(out["quality"])
    assert set(good) == brute_good(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    deduped = text(out["line_dedup"])
    assert deduped == {i: t for i, _, _, t in brute_lines(list(good.items()))}
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"].collect())
    groups = brute_components(list(deduped.items()), 5, 80)
    single = text(out["near_dedup"])
    assert single == {i: deduped[i] for i, (_, g) in groups.items() if g == i}
    taken = {r.doc_id: r for r in mixing.mix_documents(out["near_dedup"]).collect()}
    sizes, by = defaultdict(int), defaultdict(int)
    for r in out["near_dedup"].collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        by[r.source] += taken[r.doc_id].taken
    goal = brute_targets(sizes)
    assert all(abs(by[s] - goal[s]) <= 1 and r.taken <= 2 * r.size for s in sizes for r in taken.values())
    times = Counter(r.doc_id for r in out["mixing"].collect())
    assert times == Counter({i: math.ceil(r.taken / r.size) for i, r in taken.items() if r.taken})
    assert all(t == single[i] for i, t in text(out["mixing"]).items())
    rows = out["bpe"].collect()
    assert Counter(r.doc_id for r in rows) == times
    assert all(r.n_tokens == len(bpe.encoding(RANKS, P.PATTERN).encode_ordinary(single[r.doc_id])) for r in rows)
    assert Counter(map(tuple, c.run(spark, sf).collect())) == Counter(map(tuple, rows))


def test_mixing_copies_rows(spark):
    """Rows that share a doc_id, or have none, are copied as often as each of them is taken; so are rows alike."""
    from collections import Counter

    import math

    r = random.Random(9)
    texts = [" ".join(f"w{i}" for i in range(r.randrange(0, 60))) + f" t{n}" for n in range(200)]
    for ids in ([None] * 200, [7] * 200, [i // 3 for i in range(200)]):
        docs = spark.createDataFrame([(i, t, "en", r.choice(["a", "a", "b", None]), len(t)) for i, t in zip(ids, texts)], "doc_id long, text string, lang string, source string, n_chars long")
        docs = docs.unionByName(docs.limit(4)).unionByName(docs.limit(2)).cache()
        taken = Counter()
        for x in mixing.mix_documents(docs.withColumn("body", F.col("text")), carry=("body",)).collect():
            taken[x.doc_id, x.body] += math.ceil(x.taken / x.size) if x.taken else 0
        got = Counter((x.doc_id, x.text) for x in mixing.copy_documents(docs).collect())
        assert got == +taken and 206 < sum(got.values()) <= 412


CLASHES = ["_d", "_t", "_drop", "_times", "_n", "_s", "_b", "row", "dropped", "key1", "size", "taken", "copy", "pos", "t", "h1", "component_id", "score", "a.b", "key"]


def test_stages_keep_columns_with_any_names(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain, more = docs, docs.withColumns({x: F.concat(F.lit(x), F.col("doc_id").cast("string")) for x in CLASHES})
    for name, stage in c.STAGES[:-1]:
        plain, more = (materialize(stage(spark, d, sf), name) for d in (plain, more))
        assert more.columns == [*docs.columns, *CLASHES], name
        # the classifier does not read them, and neither does any other stage
        rows = more.collect()
        assert sorted(tuple(r[:5]) for r in rows) == sorted(map(tuple, plain.collect())), name
        assert all(r[x] == f"{x}{r.doc_id}" for r in rows for x in CLASHES)
    assert stage and c.STAGES[-1][1](spark, more, sf).count() == more.count()


def test_pipeline_stages_on_empty_documents(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in c.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.count() == 0, name
        if name != c.STAGES[-1][0]:
            assert out.columns == docs.columns
