"""Extractors against hand-written pages."""

from entitymill.operators import pages


def test_fields():
    page = "<header><dl><dt>no<dd>no</dl></header><main><dl><dt>設立</dt><dd>2012年</dd><dt>資本金<dd>1億<b>円</b></dl><table><tr><th>URL<td>http://a<tr><th>設立</th><td>2013</td></table></main>"
    assert pages.structured_fields(page) == {"設立": "2013", "資本金": "1億 円", "URL": "http://a"}
    assert pages.structured_fields("<body><main>x</main><dl><dt>a</dt><dd>b</dd></dl></body>") == {"a": "b"}
    assert "[FIELD: 設立] 2012年" in pages.field_text(page)


def test_releases():
    page = "".join(f"<article><h3>t{i}</h3><span class='x-Date'>d{i}</span></article>" for i in range(4))
    assert pages.release_fields(page)["__press_releases__"].count("title") == 3
    assert pages.releases_in_text("[PR: a | 2024]\n[PR: b | ]") == [("a", "2024"), ("b", "")]


def test_openings():
    assert pages.opening_count("<p>募集している求人<b>16</b>件</p>") == "16件"
    assert pages.opening_count("<p>none</p>") is None
    page = '<a href="/viewjob/1?x=1">a</a><a href="/viewjob/1/">b</a><a href="/kensaku/kyujin/2.html">c</a><a href="/other">d</a>'
    assert pages.opening_urls(page, "https://h") == ["https://h/viewjob/1?x=1", "https://h/kensaku/kyujin/2.html"]
    page = "<table><tr><td><h3>給与</h3></td><td>想定年収 690万円～1,235万円</td></tr><tr><td><h3>仕事の特徴</h3></td><td><span>a</span><span>b</span></td></tr></table>"
    assert pages.opening_fields(page) == {"想定年収": "690万円～1,235万円", "仕事の特徴": "a, b"}


def test_financial():
    def t(head, rows):
        return "<table><tr><th>期</th>" + "".join(f"<th>{h}</th>" for h in head) + "</tr>" + "".join(f"<tr><th>{p}(x)</th>" + "".join(f"<td>{v}</td>" for v in vs) + "</tr>" for p, vs in rows) + "</table>"

    page = t(["売上高", "営業利益"], [("2024年", ["1,100", "1"]), ("2023年", ["1,000", "2"])]) + t(["自己資本率"], [("2024年", ["50%"])]) + t(["ROE"], [("2024年", ["3%"])]) + t(["営業CF", "フリーCF"], [("2024年", ["5", "-6"])])
    got = pages.financial_fields(page)
    assert got["売上高_2024年"] == "1,100" and got["売上成長率_2024年"] == "10.0%" and got["フリーCF_2024年"] == "-6"
    assert pages.financial_fields("<table></table>") == {}


def test_listings():
    cases = {
        "labbase": ("<section><h3>甲社</h3></section><section><h3>検索条件</h3></section>", [("甲社", "", "")]),
        "talentbook": ('<meta property="og:title" content="甲社 | x"><title>乙社 | y</title>', [("甲社", "", "")]),
        "onecareer": ("<title>甲社の新卒採用・x</title>", [("甲社", "", "")]),
        "type_shinsotsu": ('<div class="card-company"><h3 class="card-head-title">甲社</h3></div>', [("甲社", "", "")]),
        "levtech_rookie": ('<div class="companyCard"><p class="head">x</p><p class="name">甲社</p></div>', [("甲社", "", "")]),
        "bizreach_campus": ('<p class="xcompanyx">甲社</p><p class="company">ビズリーチ</p>', [("甲社", "", "")]),
        "offerbox": ('<p class="link-list__tit">甲社</p>', [("甲社", "", "")]),
        "en_tenshoku": ('<div><div class="companyName"><span class="company">甲社</span></div><div class="jobName">職</div></div>', [("甲社", "職", "")]),
        "kimisuka": ("<p>株式会社甲乙 と 株式会社甲乙</p>", [("株式会社甲乙", "", "")]),
        "caritasu": ('<div class="c_panelCompanyInfoMain__ttlBox">甲社</div><div class="c_panelCompanyInfoMain__ttlBox">甲社</div>', [("甲社", "", "")]),
        "career_ticket": ('<li class="p-companyCard"><p class="p-companyCard__ttl">甲社</p></li>', [("甲社", "", "")]),
        "bizreach": ('<li class="a-JobListItem"><h3 class="JobTitle">職</h3><p class="bold">500万円</p><p class="bold">甲社</p></li>', [("甲社", "職", "")]),
        "en_ambi": ('<div class="jobUnit"><span class="companyName">甲社</span><a class="catch">職</a><div class="term"><span class="data">26/03/06～26/03/19</span></div></div>', [("甲社", "職", "2026-03-19")]),
        "type_chuto": ('<article><p class="company x">甲社</p><h3 class="mod-job-info-text">職</h3><p class="end-date">予定日：2026.03.30</p></article>', [("甲社", "職", "2026-03-30")]),
    }
    assert cases.keys() == pages.LISTINGS.keys()
    for site, (page, wanted) in cases.items():
        assert pages.LISTINGS[site](page) == wanted, site


def test_deep_and_broken_pages():
    deep = "<div>" * 5000 + "<dl><dt>a</dt><dd>b</dd></dl>" + "</span></div>" * 5000
    assert pages.structured_fields(deep) == {"a": "b"} and pages.field_text(deep) == "[FIELD: a] b"
    for page in ("", "<", "<dl><dt>a", "<table><tr><th>", "</div></p>", "<p class=>x", "<!-- open"):
        for read in (pages.structured_fields, pages.release_fields, pages.field_text, pages.release_text, pages.opening_count, pages.opening_fields, pages.similar_fields, pages.financial_fields, *pages.LISTINGS.values()):
            read(page)


def test_press_text_and_similar_openings():
    page = "<dl><dt>代表</dt><dd>甲</dd><dt>空</dt><dd></dd></dl>" + "".join(f"<article><h2>t{i}</h2><time>d{i}</time></article>" for i in range(4))
    assert pages.release_text(page) == "[FIELD: 代表] 甲\n[FIELD: 空] \n[PR: t0 | d0]\n[PR: t1 | d1]\n[PR: t2 | d2]"
    assert pages.releases_in_text(pages.release_text(page)) == [("t0", "d0"), ("t1", "d1"), ("t2", "d2")]
    page = "<table><tr><th>職種</th><td>no</td></tr></table><h2>この求人に似た求人を探す</h2><div><table><tr><th>職種</th><td>営業</td></tr><tr><th>業界</th><td><a>IT</a> &gt; <a>Web</a></td></tr></table></div>"
    assert pages.similar_fields(page) == {"業界_階層1": "IT", "業界_階層2": "Web", "業界_階層3": "", "業界_階層4": "", "業界_階層5": "", "職種_求人": "営業", "勤務地_求人": "", "スキル": "", "こだわり": ""}
    assert pages.similar_fields("<table></table>") == {}


def test_extract_nulls(spark):
    rows = spark.createDataFrame([(1, "<dl><dt>a</dt><dd>b</dd></dl>"), (2, None), (3, "")], "k long, html string")
    assert [tuple(r) for r in pages.extract(rows, "k", "html", pages.fields_of, ["label", "value"]).collect()] == [(1, 0, "a", "b")]
