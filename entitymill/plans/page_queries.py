"""Queries on page extractors: each page of the table gets markup made of its own page_id in front."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from entitymill.operators import pages
from entitymill.plans.registry import query, table


def _before(markup: str) -> Callable:
    """Pages with markup in front; {} in it is the page_id."""
    head, *rest = markup.split("{}")

    def rows(spark, sf):
        made = F.concat(F.lit(head), *(x for r in rest for x in (F.col("page_id").cast("string"), F.lit(r))), F.coalesce("html", F.lit("")))
        return table(spark, sf, "pages").select("page_id", made.alias("html"))

    return rows


def _rows_sql(rows: list[tuple], columns: list[str]) -> str:
    """What a page gives: rows of SQL expressions of page_id."""
    every = " UNION ALL ".join(f"SELECT page_id, CAST({i} AS INTEGER) AS pos, " + ", ".join(f'{e} AS "{c}"' for e, c in zip(r, columns)) + " FROM pages" for i, r in enumerate(rows))
    return every


def _page_query(name: str, function: Callable[[str], list[tuple]], columns: list[str], markup: str, rows: list[tuple]) -> None:
    made = _before(markup)
    query(_rows_sql(rows, columns), name)(lambda spark, sf: pages.extract(made(spark, sf), "page_id", "html", function, columns))


_ID = "CAST(page_id AS STRING)"
_named = lambda name, title="''", date="''": (f"concat('{name}', page_id)", title, date)
_TITLE = "concat('職', page_id)"
_LISTING: dict[str, tuple[str, list[tuple]]] = {
    "labbase": ("<section><h3>甲{}</h3></section><section><h3>検索条件</h3></section><section><h3>乙{}</h3></section><section><h3>甲{}</h3></section>", [_named("甲"), _named("乙")]),
    "talentbook": ('<meta property="og:title" content="甲社{} | x"><title>乙社 | y</title>', [_named("甲社")]),
    "type_shinsotsu": ('<div class="card-company"><h3 class="card-head-title">甲{}</h3></div><div class="card"><h3>乙{}</h3></div>', [_named("甲")]),
    "onecareer": ("<title>甲{}の新卒採用・x</title>", [_named("甲")]),
    "levtech_rookie": ('<div class="companyCard"><p class="head">x</p><p class="name">甲{}</p></div><div class="companyCard"><p class="name">乙{}</p></div>', [_named("甲"), _named("乙")]),
    "bizreach_campus": ('<p class="xcompanyx">甲{}</p><p class="company">ビズリーチ{}</p>', [_named("甲")]),
    "offerbox": ('<p class="link-list__tit">甲{}</p><p class="link-list__tit">乙{}</p>', [_named("甲"), _named("乙")]),
    "en_tenshoku": ('<div><div class="companyName"><span class="company">甲{}</span></div><div class="jobName">職{}</div></div>', [_named("甲", _TITLE)]),
    "kimisuka": ("<p>株式会社甲{} と 株式会社甲{} 。</p>", [_named("株式会社甲")]),
    "caritasu": ('<div class="c_panelCompanyInfoMain__ttlBox">甲{}</div><div class="c_panelCompanyInfoMain__ttlBox">甲{}</div>', [_named("甲")]),
    "career_ticket": ('<li class="p-companyCard"><p class="p-companyCard__ttl">甲{}</p></li>', [_named("甲")]),
    "bizreach": ('<li class="a-JobListItem"><h3 class="JobTitle">職{}</h3><p class="bold">500万円</p><p class="bold">甲{}</p></li><li class="JobListItem"><div class="grow-1"><p class="bold">乙{}</p></div></li>', [_named("甲", _TITLE), _named("乙")]),
    "en_ambi": ('<div class="jobUnit"><span class="companyName">甲{}</span><a class="catch">職{}</a><div class="term"><span class="data">26/03/06～26/03/19</span></div></div>', [_named("甲", _TITLE, "'2026-03-19'")]),
    "type_chuto": ('<article><p class="company x">甲{}</p><h3 class="mod-job-info-text">職{}</h3><p class="end-date">予定日：2026.03.30</p></article>', [_named("甲", _TITLE, "'2026-03-30'")]),
}
for _site, (_markup, _wanted) in _LISTING.items():
    _page_query(f"listing_{_site}", pages.LISTINGS[_site], ["企業名", "タイトル", "掲載日"], _markup, _wanted)

_FIELDS = "<main><dl><dt>設立</dt><dd>{}年</dd><dt>資本金<dd>{}億<b>円</b></dl><table><tr><th>URL</th><td>http://a/{}</td></tr></table></main>"
_FIELD_ROWS = [("'設立'", f"concat({_ID}, '年')"), ("'資本金'", f"concat({_ID}, '億 円')"), ("'URL'", f"concat('http://a/', {_ID})")]
_page_query("structured_fields", pages.fields_of, ["label", "value"], _FIELDS, _FIELD_ROWS)
_LINES = f"concat('[FIELD: 設立] ', {_ID}, '年', chr(10), '[FIELD: 資本金] ', {_ID}, '億 円', chr(10), '[FIELD: URL] http://a/', {_ID})"
_page_query("field_text", lambda p: [(pages.field_text(p),)], ["text"], _FIELDS, [(_LINES,)])

# four releases, so that none is the page's own article
_PRESS = "<dl><dt>代表</dt><dd>甲{}</dd></dl>" + "".join(f'<article><h3>題{i}-{{}}</h3><span class="x-Date">日{i}</span></article>' for i in range(3))
_JSON = "concat('[', " + ", ', ', ".join(f"""'{{"title": "題{i}-', {_ID}, '", "date": "日{i}"}}'""" for i in range(3)) + ", ']')"
_page_query("release_fields", lambda p: list(pages.release_fields(p).items()), ["label", "value"], _PRESS, [("'代表'", f"concat('甲', {_ID})"), ("'__press_releases__'", _JSON)])
_TEXT = f"concat('[FIELD: 代表] 甲', {_ID}, " + ", ".join(f"chr(10), '[PR: 題{i}-', {_ID}, ' | 日{i}]'" for i in range(3)) + ")"
_page_query("release_text", lambda p: [(pages.release_text(p),)], ["text"], _PRESS, [(_TEXT,)])
_page_query("release_lines", lambda p: pages.releases_in_text(pages.release_text(p)), ["title", "date"], _PRESS, [(f"concat('題{i}-', {_ID})", f"'日{i}'") for i in range(3)])

_OPENING = '<p>募集している求人<b>{}</b>件</p><a href="/viewjob/{}?x=1">a</a><a href="/viewjob/{}/">b</a><a href="/kensaku/kyujin/{}.html">c</a><table><tr><td><h3>給与</h3></td><td>想定年収 {}万円～1,235万円</td></tr><tr><td><h3>仕事の特徴</h3></td><td><span>特{}</span><span>b</span></td></tr></table>'
_page_query("opening_counts", lambda p: [(n,)] if (n := pages.opening_count(p)) else [], ["n"], _OPENING, [(f"concat({_ID}, '件')",)])
_page_query("opening_urls", lambda p: [(u,) for u in pages.opening_urls(p, "https://h")], ["url"], _OPENING, [(f"concat('https://h/viewjob/', {_ID}, '?x=1')",), (f"concat('https://h/kensaku/kyujin/', {_ID}, '.html')",)])
_page_query("first_opening_url", lambda p: [(u,) for u in pages.opening_urls(p, "https://h")[:1]], ["url"], _OPENING, [(f"concat('https://h/viewjob/', {_ID}, '?x=1')",)])
_page_query("opening_fields", lambda p: list(pages.opening_fields(p).items()), ["label", "value"], _OPENING, [("'想定年収'", f"concat({_ID}, '万円～1,235万円')"), ("'仕事の特徴'", f"concat('特', {_ID}, ', b')")])
_SIMILAR = "<h2>この求人に似た求人を探す</h2><div><table><tr><th>職種</th><td>営業{}</td></tr><tr><th>業界</th><td><a>IT</a> &gt; <a>Web{}</a></td></tr></table></div>"
_SIMILAR_ROWS = [("'業界_階層1'", "'IT'"), ("'業界_階層2'", f"concat('Web', {_ID})"), *((f"'業界_階層{i}'", "''") for i in (3, 4, 5)), ("'職種_求人'", f"concat('営業', {_ID})"), ("'勤務地_求人'", "''"), ("'スキル'", "''"), ("'こだわり'", "''")]
_page_query("similar_fields", lambda p: list(pages.similar_fields(p).items()), ["label", "value"], _SIMILAR, _SIMILAR_ROWS)

_METRICS = "".join(f"<table><tr><th>期</th><th>{m}</th></tr><tr><th>2024年(x)</th><td>{'1{{}}00' if m == '売上高' else '5'}</td></tr><tr><th>2023年</th><td>{'1000' if m == '売上高' else '4'}</td></tr></table>" for m in ("売上高", "自己資本率", "ROE", "営業CF")).replace("{{}}", "{}")
_GROWTH = f"printf('%.1f%%', (CAST(concat('1', {_ID}, '00') AS DOUBLE) - 1000) / 1000 * 100)"
_METRIC_ROWS = [("'売上高_2024年'", f"concat('1', {_ID}, '00')"), ("'売上高_2023年'", "'1000'"), *((f"'{m}_{y}年'", f"'{v}'") for m in ("自己資本率", "ROE", "営業CF") for y, v in (("2024", 5), ("2023", 4))), ("'売上成長率_2024年'", _GROWTH)]
_page_query("financial_fields", lambda p: list(pages.financial_fields(p).items()), ["label", "value"], _METRICS, _METRIC_ROWS)
