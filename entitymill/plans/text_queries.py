"""Queries on text operators. The tables hold no Japanese company data, so each row makes its input
from its own keys: the first expression of a case is the input, the second what must come of it, both
in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.functions import contact, names, text
from entitymill.operators import mapping
from entitymill.plans.registry import query, table

Case = tuple[str, str]
_BASE = {"part": ("p_partkey", "p_partkey", "p_size"), "customer": ("c_custkey", "c_custkey", "c_nationkey"), "events": ("event_id", "event_id", "user_id"), "documents": ("doc_id", "doc_id", "n_chars")}


def _choice(parts: list[str]) -> str:
    return f"CASE CAST(k % {len(parts)} AS INTEGER) " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(parts)) + " END"


def composed(spark, sf: str, source: str, cases: list[Case]) -> DataFrame:
    """The key of each row of a table, with the input `x` that its case makes of k and s."""
    key, k, s = _BASE[source]
    rows = table(spark, sf, source).select(key, F.col(k).alias("k"), F.col(s).alias("s"))
    return rows.withColumn("x", F.expr(_choice([c[0] for c in cases])))


def _expected(source: str, cases: list[Case], column: str, more: str = "") -> str:
    key, k, s = _BASE[source]
    return f"SELECT {key}, {_choice([c[1] for c in cases])} AS {column}{more} FROM (SELECT *, {k} AS k, {s} AS s FROM {source})"


def _cases(name: str, source: str, function: Callable[[Column], Column], column: str, cases: list[Case]) -> None:
    query(_expected(source, cases, column), name)(lambda spark, sf: composed(spark, sf, source, cases).select(_BASE[source][0], function(F.col("x")).alias(column)))


_S = "lpad(CAST(s AS STRING), 3, '0')"
_SEVEN, _EIGHT = "lpad(CAST(k % 10000000 AS STRING), 7, '0')", "lpad(CAST(k % 100000000 AS STRING), 8, '0')"
_HALVES = "left({0}, 4), '-', right({0}, 4)".format(_EIGHT)
CLEANER_CASES: dict[str, list[Case]] = {
    "long_text": [("concat(' a', k, ' \t　b ')", "concat('a', k, ' b')"), ("concat('x\n', s)", "concat('x ', s)"), ("NULL", "''"), ("'nan'", "''")],
    "short_text": [("concat('  ＡＢｃ　', k, '１ ')", "concat('ABc ', k, '1')"), ("concat('None', k)", "concat('None', k)"), ("'None'", "''"), ("concat('（', s, '）')", "concat('（', s, '）')")],
    "money": [
        ("concat(k, '億', s, '万円')", "CAST(k * 100000000 + s * 10000 AS STRING)"), ("concat(k, '百万円')", "CAST(k * 1000000 AS STRING)"), (f"concat(k, ',', {_S}, '円')", "CAST(k * 1000 + s AS STRING)"),
        ("concat(k, '兆', s, '億')", "CAST(k * 1000000000000 + CAST(s AS BIGINT) * 100000000 AS STRING)"), ("concat(k, '万円（連結）')", "CAST(k * 10000 AS STRING)"), ("concat('約', k, '円')", "''"), ("NULL", "''"),
    ],
    "money_million": [(f"concat(k, ',', {_S})", "CAST((k * 1000 + s) * 1000000 AS STRING)"), ("concat('-', k)", "CAST(-k * 1000000 AS STRING)"), ("concat('▲', k)", "''"), ("NULL", "''")],
    "salary": [("concat(k, ' 万円')", "CAST(k * 10000 AS STRING)"), ("concat(k, '万')", "CAST(k * 10000 AS STRING)"), ("CAST(k AS STRING)", "CAST(k AS STRING)"), ("concat('x', k)", "''"), ("NULL", "''")],
    "people_count": [(f"concat(k + 1, ',', {_S}, '名（2025年）')", "CAST((k + 1) * 1000 + s AS STRING)"), ("concat('連結 ', s, '名 単独：', k, '名')", "CAST(k AS STRING)"), ("concat(k, '～', k + s, '名')", "CAST(k AS STRING)"), ("concat('約', k)", "''"), ("NULL", "''")],
    "ratio": [("concat(s, '.', k, '%')", "concat(s, '.', k)"), ("concat(s, '％')", "CAST(s AS STRING)"), ("NULL", "''")],
    "numeric_value": [("concat(k, '.', s, '時間 （実績）')", "concat(k, '.', s)"), ("concat('x', k)", "''"), ("concat(k, '日')", "CAST(k AS STRING)")],
    "date": [
        ("concat(1900 + k % 100, '年', s % 12 + 1, '月')", "concat(1900 + k % 100, '-', lpad(CAST(s % 12 + 1 AS STRING), 2, '0'))"), ("concat(1900 + k % 100, '年')", "CAST(1900 + k % 100 AS STRING)"),
        ("concat(1900 + k % 100, '年（昭和', s, '年）8月')", "CAST(1900 + k % 100 AS STRING)"), ("concat(s, '月')", "concat(s, '月')"), ("NULL", "''"),
    ],
    "address": [(f"concat('〒', left({_SEVEN}, 3), '-', right({_SEVEN}, 4), ' 区', k)", "concat('区', k)"), ("concat('１ー', s, 'ータワー', k)", "concat('1-', s, 'ータワー', k)"), ("concat('町', k, '−', s)", "concat('町', k, '-', s)"), ("NULL", "''")],
    "phone": [(f"concat('(03)', {_HALVES})", f"concat('03-', {_HALVES})"), (f"concat('090', {_EIGHT})", f"concat('090-', {_HALVES})"), (f"concat('（06）', s)", "concat('06-', s)"), ("NULL", "''")],
    "email": [("concat('Ａ', k, '@Ｂ.ｃｏｍ')", "concat('a', k, '@b.com')"), ("concat('X', s, '@y.CO')", "concat('x', s, '@y.co')"), ("concat(k, '@')", "''"), ("NULL", "''")],
    "zipcode": [(f"concat('〒', {_SEVEN})", f"concat(left({_SEVEN}, 3), '-', right({_SEVEN}, 4))"), ("concat('x', s)", "concat('x', s)"), ("NULL", "''")],
    "url": [("concat('http://a.example/', k)", "concat('https://a.example/', k, '/')"), ("concat('https://b.example/', s, '/')", "concat('https://b.example/', s, '/')"), ("NULL", "''")],
    "json": [("concat('{\"a\":', k, '}')", "concat('{\"a\": ', k, '}')"), ("concat('{bad', k)", "'[]'"), ("concat('[', k, ',', s, ']')", "concat('[', k, ', ', s, ']')"), ("NULL", "'[]'")],
}

for _name, _list in CLEANER_CASES.items():
    _cases(f"clean_{_name}", "part", text.CLEANERS[_name], "cleaned", _list)

_PLAIN = "concat('会', k)"
_NAME_CASES: dict[str, list[Case]] = {
    "master": [("concat('株式会社会', k)", _PLAIN), ("concat('会', k, '㈱')", _PLAIN), ("concat('【東証】会', k, ' (東京)')", _PLAIN), ("concat('ＡＢ　会', k, '　(有)')", "concat('AB 会', k)"), ("NULL", "''")],
    "listing": [("concat('株式会社会', k)", _PLAIN), ("concat('会', k, '㈱')", _PLAIN), ("concat('「会', k, '」 (東京)')", "concat('会', k, '」')"), ("concat('ＡＢ　会', k, '　(有)')", "concat('AB 会', k)"), ("NULL", "''")],
    "review": [("concat('株式会社会', k)", _PLAIN), ("concat('会', k, '㈱')", _PLAIN), ("concat('ＡＢ会', k, '有限会社')", "concat('ab会', k)"), ("NULL", "''")],
}
for _profile, _list in _NAME_CASES.items():
    _cases(f"normalize_{_profile}_name", "customer", names.PROFILES[_profile], "name", _list)


def _parser(name: str, parse: Callable[[Column], Column], inputs: list[str], fields: dict[str, list[str]]) -> None:
    """fields: name to what it is in each case."""
    shown = ", ".join(f'{_choice(parts)} AS "{f}"' for f, parts in fields.items())
    sql = f"SELECT p_partkey, {shown} FROM (SELECT *, p_partkey AS k, p_size AS s FROM part)"
    query(sql, name)(lambda spark, sf: composed(spark, sf, "part", [(i, "") for i in inputs]).select("p_partkey", parse(F.col("x")).alias("p")).select("p_partkey", "p.*"))


_K, _SS, _NO = "CAST(k AS STRING)", "CAST(s AS STRING)", "''"
_parser("parse_female_ratio", text.female_ratio, ["concat('女性 役員 ', s, '.0% 管理職 ', k, '.5%')", "concat('－', k)", "NULL"], {"女性役員比率": ["concat(s, '.0')", _NO, _NO], "女性管理職比率": ["concat(k, '.5')", _NO, _NO]})
_parser(
    "parse_childcare_leave", text.childcare_leave,
    ["concat('育休取得者数 ', k, '人 ', s, '人 取得対象者数 ', k + 1, '人 ', s + 1, '人 育休取得率 ', s, '.0% ', k, '.5%')", "concat('育休取得率 － ', s, '.5%')", "NULL"],
    {"育休取得者数_男性": [_K, _NO, _NO], "育休取得者数_女性": [_SS, _NO, _NO], "育休対象者数_男性": ["CAST(k + 1 AS STRING)", _NO, _NO], "育休対象者数_女性": ["CAST(s + 1 AS STRING)", _NO, _NO], "育休取得率_男性": ["concat(s, '.0')", _NO, _NO], "育休取得率_女性": ["concat(k, '.5')", "concat(s, '.5')", _NO]},
)
_parser(
    "parse_retention", text.retention, ["concat('2022年度 1人 1人 1.0% 2023年度 ', k, '人 ', s, '人 ', s, '.5%')", "concat('2023年度 採用実績なし ', k)", "NULL"],
    {"直近採用者数": [_K, "'0'", _NO], "直近離職者数": [_SS, "'0'", _NO], "直近定着率": ["concat(s, '.5')", _NO, _NO]},
)

# ---------------------------------------------------------------- labels

_ALIASES = [("本社（MAP）", "本社所在地"), ("本社所在地", "本社所在地"), ("創業/設立", "設立"), ("設立年月日", "設立"), ("資本金", "資本金"), ("従業員数", "従業員数"), ("売上高推移", "売上高"), ("URL", "企業URL"), ("Employees", "従業員数")]
_LABEL_CASES: list[Case] = [
    ("concat('資本金（単体', k, '）')", "'資本金'"), ("concat('設立年月日※西暦', k)", "'設立'"), ("concat('連結従業員数', k)", "'従業員数'"), ("concat('EMPLOYEES', k)", "'従業員数'"),
    ("concat('売上高', k)", "NULL"), ("'売上'", "'売上高'"), ("'本社 (MAP)'", "'本社所在地'"), ("''", "NULL"), ("concat('本社所在地 【必須', k, '】')", "'本社所在地'"),
]


def _aliases(spark):
    return spark.createDataFrame([(a, c, i) for i, (a, c) in enumerate(_ALIASES)], "alias string, canonical string, pos int")


@query(f"SELECT DISTINCT {_choice([c[0] for c in _LABEL_CASES])} AS label, {_choice([c[1] for c in _LABEL_CASES])} AS canonical FROM (SELECT p_partkey AS k FROM part)")
def label_mapping(spark, sf):
    return mapping.map_labels(composed(spark, sf, "part", _LABEL_CASES).select(F.col("x").alias("label")), _aliases(spark))


@query(f"""SELECT entity, 'm' AS media, canonical, arg_min(CAST(k AS STRING), k) AS value FROM (SELECT user_id AS entity, event_id AS k, {_choice([c[1] for c in _LABEL_CASES]).replace('k %', 'event_id %')} AS canonical FROM events)
WHERE canonical IS NOT NULL GROUP BY entity, canonical""")
def field_mapping(spark, sf):
    rows = composed(spark, sf, "events", _LABEL_CASES).select(F.col("s").alias("entity"), F.lit("m").alias("media"), F.col("x").alias("label"), F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("pos"))
    return mapping.map_fields(rows, _aliases(spark))[0]


@query(f"""SELECT label, CAST(count(*) AS BIGINT) AS n, min(k) AS first_pos FROM (SELECT event_id AS k, {_choice([c[0].replace('k)', 'k % 7)') for c in _LABEL_CASES]).replace('CASE CAST(k %', 'CASE CAST(event_id %')} AS label,
{_choice([c[1] for c in _LABEL_CASES]).replace('CASE CAST(k %', 'CASE CAST(event_id %')} AS canonical FROM events) WHERE canonical IS NULL GROUP BY 1""")
def unmapped_freq(spark, sf):
    cases = [(x.replace("k)", "k % 7)"), c) for x, c in _LABEL_CASES]
    rows = composed(spark, sf, "events", cases).select(F.col("s").alias("entity"), F.lit("m").alias("media"), F.col("x").alias("label"), F.lit("v").alias("value"), F.col("event_id").alias("pos"))
    return mapping.unmapped_counts(mapping.map_fields(rows, _aliases(spark))[1], "label", "pos")


_SKIP_CASES: list[Case] = [("concat('セミナー／', k)", "true"), ("concat(2000 + k % 50, '年卒採用情報')", "true"), ("'OpenES'", "true"), ("concat('資本金', k)", "false"), ("concat(k, '年卒')", "false")]


@query(f"SELECT event_id FROM (SELECT event_id, event_id AS k FROM events) WHERE NOT ({_choice([c[1] for c in _SKIP_CASES])})")
def skipped_labels(spark, sf):
    return mapping.worth_asking(composed(spark, sf, "events", _SKIP_CASES), "x").select("event_id")


# ---------------------------------------------------------------- contacts

_WORDS = ", ".join(f"'{w}'" for w in contact.NEAR_PHONE)
_TAIL = "concat(' 採用 TEL: 03-', lpad(CAST(doc_id % 10000 AS STRING), 4, '0'), '-', lpad(CAST(doc_id * 7 % 10000 AS STRING), 4, '0'))"


@query(f"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, concat(translate(coalesce(text, ''), '0123456789', 'xxxxxxxxxx'), {_TAIL}) AS t FROM documents)
SELECT doc_id, concat('03-', lpad(CAST(doc_id % 10000 AS STRING), 4, '0'), '-', lpad(CAST(doc_id * 7 % 10000 AS STRING), 4, '0')) AS normalized, CAST(n + 4 AS INTEGER) AS char_position,
array_to_string(list_filter([{_WORDS}], lambda w: contains(substring(t, greatest(n + 4 - 100, 0) + 1, n + 104 - greatest(n + 4 - 100, 0)), w)), ',') AS keywords FROM d""")
def extract_phones(spark, sf):
    # digits of the document are masked, so that the number made of its key is the only one
    docs = table(spark, sf, "documents").withColumn("text", F.concat(F.translate(F.coalesce("text", F.lit("")), "0123456789", "x" * 10), F.expr(_TAIL)))
    return docs.select("doc_id", F.explode(contact.phones(F.col("text"))).alias("p")).select("doc_id", "p.normalized", F.array_join("p.context_keywords", ",").alias("keywords"), "p.char_position")


_PHONE_CASES: list[Case] = [(f"concat('電話：06-', {_HALVES}, '　本社')", f"concat('06-', {_HALVES})"), (f"concat('((03) ', {_HALVES}, ')')", f"concat('03', {_HALVES})"), ("concat('0120', lpad(CAST(k % 1000 AS STRING), 3, '0'), '333 人事')", "concat('0120', lpad(CAST(k % 1000 AS STRING), 3, '0'), '333')"), ("concat('no. ', k)", "NULL")]


@query(f"SELECT * FROM ({_expected('customer', _PHONE_CASES, 'normalized')}) WHERE normalized IS NOT NULL")
def phone_forms(spark, sf):
    rows = composed(spark, sf, "customer", _PHONE_CASES)
    return rows.select("c_custkey", F.explode(contact.phones(F.col("x"))).alias("p")).select("c_custkey", "p.normalized")


_SIGNALS = " OR ".join(f"contains(text, '{w}')" for w in contact.SIGNALS)
_SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


@query(rf"""SELECT doc_id, CASE WHEN text IS NOT NULL THEN ({_SIGNALS} OR regexp_matches(text, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}') OR regexp_matches(text, '0\p{{Nd}}{{1,4}}(?:[\-－‐‑–—・]|{_SPACE})\p{{Nd}}{{2,4}}(?:[\-－‐‑–—・]|{_SPACE})\p{{Nd}}{{3,4}}')
OR regexp_matches(text, '\(0\p{{Nd}}{{1,4}}\)(?:[\-－]|{_SPACE})?\p{{Nd}}{{2,4}}[\-－]\p{{Nd}}{{3,4}}')) END AS signals FROM documents""")
def contact_signals(spark, sf):
    return table(spark, sf, "documents").select("doc_id", contact.has_signals(F.col("text")).alias("signals"))
