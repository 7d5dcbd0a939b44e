"""Golden values of the cleaners, and independent twins under random text."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entitymill.functions import contact, names, text

GOLDEN = {
    "money": [("5億9,414万円", "594140000"), ("1,234百万円", "1234000000"), ("100,000,000円", "100000000"), ("103億", "10300000000"), ("25699百万円", "25699000000"), ("1億円（株主：A）", "100000000"), ("1兆387億", "1038700000000"),
              ("100億7千万円 93億6千万円", "10070000000"), ("3千5百万", "5000000"), ("100.5円", "100"), ("約100円", ""), ("約1億円", "100000000"), ("0.29億円", "28999999"), (None, ""), ("nan", "")],
    "money_million": [("1,672,377", "1672377000000"), ("-5", "-5000000"), ("▲5", "")],
    "salary": [("653万円", "6530000"), ("５００", "500"), ("x", "")],
    "people_count": [("1,042名（2025年3月現在）", "1042"), ("単独　2,568名　連結　112,551名", "2568"), ("単体：8,981人 連結：112,551名", "8981"), ("11～15名", "11"), ("約100名", "")],
    "numeric_value": [("10.0時間 （2023年度実績）", "10.0"), ("35.5歳", "35.5")],
    "ratio": [("3.5%", "3.5"), ("x％", "x")],
    "date": [("2012年7月", "2012-07"), ("2012年", "2012"), ("1937年（昭和12年）8月", "1937")],
    "address": [("〒100-6640 東京都", "東京都"), ("１ー２ー３タワー", "1-2-3タワー")],
    "phone": [("(03)1234-5678", "03-1234-5678"), ("09012345678", "090-1234-5678"), ("0120-123-456", "01-2012-3456")],
    "zipcode": [("〒1000001", "100-0001"), ("12", "12")],
    "url": [("http://a.example", "https://a.example/"), ("", "")],
    "json": [("{bad", "[]"), ("", "[]"), ('{"a":1}', '{"a": 1}')],
    "email": [("Ａ@Ｂ.ｃｏｍ", "a@b.com"), ("x@", "")],
    "short_text": [(" ＡＢｃ　１２ ", "ABc 12"), ("（株）", "（株）"), ("None", "")],
    "long_text": [("  a \n b　c ", "a b c")],
}


def apply(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]


@pytest.mark.parametrize("name", GOLDEN)
def test_golden(spark, name):
    asked, wanted = zip(*GOLDEN[name])
    assert apply(spark, text.CLEANERS[name], asked) == list(wanted)


def test_structs(spark):
    assert tuple(apply(spark, text.female_ratio, ["項目 女性 役員 40.0% 管理職 7.7% （2024年10月時点）"])[0]) == ("40.0", "7.7")
    leave = "項目 男性 女性 育休取得者数 0人 1人 取得対象者数 1人 1人 育休取得率 0.0% 100.0% （2023年度実績）"
    assert tuple(apply(spark, text.childcare_leave, [leave])[0]) == ("0", "1", "1", "1", "0.0", "100.0")
    got = apply(spark, text.retention, ["2022年度 28人 2人 92.8% 2023年度 37人 0人 100.0%", "2023年度 採用実績なし", "－"])
    assert [tuple(g) for g in got] == [("37", "0", "100.0"), ("0", "0", ""), ("", "", "")]


def test_names(spark):
    asked = ["株式会社テスト", "テスト㈱", "【東証】テスト (東京)", "ＡＢＣ　株式会社", None]
    assert apply(spark, names.master_name, asked) == ["テスト", "テスト", "テスト", "ABC", ""]
    assert apply(spark, names.review_name, ["株式会社ＡＢ"]) == ["ab"]
    assert apply(spark, names.label_key, [" 本 社（ＭＡＰ） "]) == ["本社(map)"]
    assert apply(spark, names.without_region_code, ["09:栃木県"]) == ["栃木県"]


def test_contacts(spark):
    found = apply(spark, contact.phones, ["採用担当 TEL：03-1234-5678 と (03)1234-5679 0120-123-456 代表 03-1234-5678", "none"])
    assert [(p.normalized, p.char_position) for p in found[0]] == [("03-1234-5678", 5), ("0120-123-456", 37), ("031234-5679", 23)]
    assert found[0][0].context_keywords == ["代表", "採用", "採用担当"] and found[1] == []
    mails = apply(spark, contact.emails, ["HR@x.co.jp hr@x.co.jp recruit1@y.com chris@z.io"])[0]
    assert [tuple(m) for m in mails] == [("hr@x.co.jp", "hr"), ("recruit1@y.com", "recruit"), ("chris@z.io", "hr")]
    assert apply(spark, contact.has_signals, ["採用", "x", "a@b.co", "03-1234-5678"]) == [True, False, True, True]
    assert apply(spark, contact.masked, ["ab-12345"]) == ["**-***45"]


ALPHABET = st.text(alphabet="0123456789０１.,億万百千円（）株式会社(東京) 　-ー〒年月%AｂＺ\n", max_size=25)


def twin_short(s):
    table = {0xFF10 + i: 0x30 + i for i in range(10)} | {0xFF21 + i: 0x41 + i for i in range(26)} | {0xFF41 + i: 0x61 + i for i in range(26)} | {0x3000: 0x20}
    return s.strip().translate(table).strip()


def twin_zip(s):
    s = s.strip().translate({0xFF10 + i: 0x30 + i for i in range(10)})
    d = "".join(c for c in s if c.isdigit())
    return f"{d[:3]}-{d[3:]}" if len(d) == 7 else s


def twin_label(s):
    return "".join(unicodedata.normalize("NFKC", s).split()).lower()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ALPHABET, min_size=20, max_size=40))
def test_twins(spark, values):
    assert apply(spark, text.short_text, values) == [twin_short(v) for v in values]
    assert apply(spark, text.zipcode, values) == [twin_zip(v) for v in values]
    assert apply(spark, names.label_key, values) == [twin_label(v) for v in values]
    assert apply(spark, text.long_text, values) == [re.sub(r"\s+", " ", v.strip()) for v in values]
