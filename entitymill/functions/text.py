"""Cleaners: text as collected to text in one form. Missing in, "" out.

All are JVM expressions, so they stay inside a stage's generated code or beside it, and filters and
pruning go past them. White space and digits follow the Unicode rules of the source data.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space in Unicode's sense, with the four ASCII separators that Python strips as well.
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WS_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: Texts that stand for missing; full-width digits and letters and their narrow forms.
MISSING = ("None", "nan", "NaN", "NaT")
WIDE_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
WIDE = "".join(chr(c + 0xFEE0) for c in (*range(97, 123), *range(65, 91), *range(48, 58))) + "　"
NARROW = "".join(chr(c) for c in (*range(97, 123), *range(65, 91), *range(48, 58))) + " "

#: Units of large numbers, in the order in which they are looked for.
UNITS = (("兆", 10**12), ("億", 10**8), ("千万", 10**7), ("百万", 10**6), ("万", 10**4), ("千", 10**3))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def as_text(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull() | s.isin(*MISSING), F.lit("")).otherwise(s)


def _stripped(c: Column) -> Column:
    return strip(as_text(c))


def _narrow_digits(c: Column) -> Column:
    return F.translate(_stripped(c), WIDE_DIGITS, DIGITS)


def _plain_number(c: Column) -> Column:
    """Narrow digits, without thousands separators."""
    return F.translate(_narrow_digits(c), ",，", "")


def long_text(c: Column) -> Column:
    return F.regexp_replace(_stripped(c), f"{WS}+", " ")


def short_text(c: Column) -> Column:
    return strip(F.translate(_stripped(c), WIDE, NARROW))


def money(c: Column) -> Column:
    """Whole yen of the first amount; fractions are cut as the product in double precision gives them."""
    bare = strip(F.regexp_replace(_plain_number(c), r"[（(][^）)]*[）)]", ""))
    return let(bare, _amount)


def _amount(s: Column) -> Column:
    block = F.regexp_extract(s, rf"^([0-9.]+{WS}*(?:兆|億|百万|千万|万|千)(?:[0-9.兆億百万千]|{WS})*円?)", 1)
    plain = F.regexp_extract(s, rf"^([0-9]+{WS}*円?)", 1)
    first = F.when(block != "", block).when(plain != "", plain).otherwise(s)
    return let(strip(F.regexp_replace(first, "円+$", "")), _yen)


def _yen(s: Column) -> Column:
    millions = F.regexp_extract(s, rf"^([0-9]+(?:\.[0-9]+)?){WS}*百万$", 1)
    state = F.struct(F.lit(0).cast("long").alias("total"), s.alias("rest"), F.lit(False).alias("found"))
    for unit, times in UNITS:
        state = let(state, _unit(unit, times))
    digits = F.regexp_extract(s, "^([0-9]+)$", 1)

    def summed(x: Column) -> Column:
        odd = F.regexp_extract(strip(x["rest"]), "^([0-9]+)", 1)
        total = x["total"] + F.when(odd != "", odd.try_cast("long")).otherwise(F.lit(0))
        return F.when(x["found"], total.cast("string")).otherwise(digits)

    return F.when(millions != "", (millions.try_cast("double") * 1e6).cast("long").cast("string")).otherwise(let(state, summed))


def _unit(unit: str, times: int) -> Callable[[Column], Column]:
    """Adds the first number before the unit; what stands before it is no longer looked at."""
    pattern = rf"(?s)^.*?([0-9]+(?:\.[0-9]+)?){WS}*{unit}(.*)$"

    def step(x: Column) -> Column:
        number = F.regexp_extract(x["rest"], pattern, 1)
        hit = number != ""
        return F.struct(
            (x["total"] + F.when(hit, (number.try_cast("double") * float(times)).cast("long")).otherwise(F.lit(0))).alias("total"),
            F.when(hit, F.regexp_extract(x["rest"], pattern, 2)).otherwise(x["rest"]).alias("rest"),
            (x["found"] | hit).alias("found"),
        )

    return step


def _scaled(c: Column, pattern: str, times: int) -> Column:
    number = F.regexp_extract(c, pattern, 1)
    return F.when(number != "", (number.try_cast("decimal(30,0)") * times).cast("string"))


def money_million(c: Column) -> Column:
    return F.coalesce(_scaled(_plain_number(c), "^(-?[0-9]+)$", 1_000_000), F.lit(""))


def salary(c: Column) -> Column:
    s = _plain_number(c)
    return F.coalesce(_scaled(s, rf"^([0-9]+){WS}*万円?$", 10_000), F.regexp_extract(s, "^([0-9]+)$", 1))


def people_count(c: Column) -> Column:
    s = _plain_number(c)
    alone = F.regexp_extract(s, rf"(?:単独|単体)(?:[：:]|{WS})*([0-9]+)", 1)
    return F.when(alone != "", alone).otherwise(F.regexp_extract(s, "^([0-9]+)", 1))


def ratio(c: Column) -> Column:
    return strip(F.translate(_narrow_digits(c), "%％", ""))


def numeric_value(c: Column) -> Column:
    return F.regexp_extract(_narrow_digits(c), r"^([0-9]+(?:\.[0-9]+)?)", 1)


def date(c: Column) -> Column:
    s = _narrow_digits(c)
    month = F.regexp_extract(s, rf"^([0-9]{{4}}){WS}*年{WS}*([0-9]{{1,2}}){WS}*月", 2)
    year = F.regexp_extract(s, rf"^([0-9]{{4}}){WS}*年", 1)
    return F.when(month != "", F.concat_ws("-", year, F.lpad(month, 2, "0"))).when(year != "", year).otherwise(s)


def address(c: Column) -> Column:
    s = strip(F.regexp_replace(_narrow_digits(c), rf"^〒?{WS}*[0-9]{{3}}[-－‐ー][0-9]{{4}}{WS}*", ""))
    return F.regexp_replace(F.translate(s, "－‐−", "---"), r"([0-9])ー(?=[0-9])", "$1-")


def phone(c: Column) -> Column:
    s = F.regexp_replace(F.translate(_narrow_digits(c), "（）ー‐", "()--"), r"\(([0-9]+)\)", "$1-")
    d = F.regexp_replace(s, "[^0-9]", "")
    cut = lambda *at: F.concat_ws("-", *(F.substring(d, a + 1, b - a) for a, b in zip((0, *at), (*at, 20))))
    n = F.length(d)
    return F.when(n == 11, cut(3, 7)).when(n == 10, cut(2, 6)).when((n == 12) & d.startswith("0120"), cut(4, 6)).otherwise(s)


def _composed(c: Column) -> Column:
    """Compatibility composition by the Unicode library that Spark ships, in the JVM."""
    return F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))


@functools.cache
def _unassigned() -> str:
    """A class of the code points that this Python's Unicode does not know: what a later one says of
    them is not followed, so that results do not depend on the library's version."""
    spans: list[list[int]] = []
    for i in range(sys.maxunicode + 1):
        if unicodedata.category(chr(i)) == "Cn":
            if spans and spans[-1][1] == i - 1:
                spans[-1][1] = i
            else:
                spans.append([i, i])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)


def nfkc(c: Column) -> Column:
    """Compatibility composition as of this Python's Unicode. ASCII is its own. A code point that has no
    meaning there stands for itself, and what is on either side of it is composed apart."""
    known = _unassigned()
    parts = F.transform(F.regexp_extract_all(c, F.lit(f"[{known}]+|[^{known}]+"), F.lit(0)), lambda x: F.when(x.rlike(f"^[{known}]"), x).otherwise(_composed(x)))
    # the JVM's class of unassigned ones holds more than ours: a quick test
    return F.when(c.isNull() | (F.octet_length(c) == F.length(c)), c).when(c.rlike(r"\p{Cn}"), F.array_join(parts, "")).otherwise(_composed(c))


def email(c: Column) -> Column:
    s = strip(F.lower(nfkc(_stripped(c))))
    return F.when(s.rlike(r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"), s).otherwise(F.lit(""))


def zipcode(c: Column) -> Column:
    s = _narrow_digits(c)
    d = F.regexp_replace(s, "[^0-9]", "")
    return F.when(F.length(d) == 7, F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 4))).otherwise(s)


def url(c: Column) -> Column:
    s = F.regexp_replace(_stripped(c), "^http://", "https://")
    return F.when((s == "") | s.endswith("/"), s).otherwise(F.concat(s, F.lit("/")))


@F.pandas_udf(T.StringType())
def _json(s: pd.Series) -> pd.Series:
    import json

    def again(x):
        try:
            return json.dumps(json.loads(x), ensure_ascii=False)
        except (TypeError, ValueError):
            return "[]"

    return s.map(again)


def json_text(c: Column) -> Column:
    s = _stripped(c)
    return F.when(s == "", F.lit("[]")).otherwise(_json(s))


def _parts(s: Column, pattern: str, *names: str) -> list[Column]:
    return [F.regexp_extract(s, pattern, i + 1).alias(n) for i, n in enumerate(names)]


def female_ratio(c: Column) -> Column:
    """Struct of the shares of women among directors and among managers."""
    pattern = rf"(?s)役員{WS}*([0-9.]+){WS}*%.*管理職{WS}*([0-9.]+){WS}*%"
    return F.struct(*_parts(_narrow_digits(c), pattern, "女性役員比率", "女性管理職比率"))


def childcare_leave(c: Column) -> Column:
    """Struct of takers, those entitled and rates, men and women; a dash is ""."""
    s = _narrow_digits(c)
    people = rf"{WS}*([0-9]+){WS}*人{WS}*([0-9]+){WS}*人"
    rates = _parts(s, rf"育休取得率{WS}*([0-9.]+|－){WS}*%?{WS}*([0-9.]+|－){WS}*%?", "m", "f")
    rates = [F.when(x == "－", F.lit("")).otherwise(x).alias(n) for x, n in zip(rates, ("育休取得率_男性", "育休取得率_女性"))]
    return F.struct(*_parts(s, f"育休取得者数{people}", "育休取得者数_男性", "育休取得者数_女性"), *_parts(s, f"取得対象者数{people}", "育休対象者数_男性", "育休対象者数_女性"), *rates)


def retention(c: Column) -> Column:
    """Struct of hires, leavers and retention of the newest year."""
    s = _narrow_digits(c)
    pattern = rf"([0-9]{{4}}){WS}*年度{WS}*([0-9]+){WS}*人{WS}*([0-9]+){WS}*人{WS}*([0-9.]+){WS}*%"
    found = [F.regexp_extract_all(s, F.lit(pattern), F.lit(i)) for i in (1, 2, 3, 4)]
    years = F.transform(found[0], lambda y, i: F.struct(y.cast("int").alias("y"), (-i).alias("i"), F.get(found[1], i).alias("a"), F.get(found[2], i).alias("b"), F.get(found[3], i).alias("c")))
    none = s.rlike(rf"[0-9]{{4}}{WS}*年度{WS}*採用実績なし")

    def newest(x: Column) -> Column:
        zero = F.when(none, F.lit("0")).otherwise(F.lit(""))
        return F.struct(F.coalesce(x["a"], zero).alias("直近採用者数"), F.coalesce(x["b"], zero).alias("直近離職者数"), F.coalesce(x["c"], F.lit("")).alias("直近定着率"))

    return let(F.array_max(years), newest)


#: The registry by which a configuration names cleaners.
CLEANERS: dict[str, Callable[[Column], Column]] = {
    "text": as_text, "long_text": long_text, "short_text": short_text, "money": money, "money_million": money_million, "salary": salary,
    "people_count": people_count, "ratio": ratio, "numeric_value": numeric_value, "date": date, "address": address, "phone": phone,
    "email": email, "zipcode": zipcode, "url": url, "json": json_text,
}
