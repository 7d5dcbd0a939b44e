"""Phone numbers and mail addresses in free text, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymill.functions.text import DIGITS, WIDE_DIGITS, WS, WS_CHARACTERS, let

#: Patterns and word lists by which contacts are found and labelled.
D = r"\p{Nd}"
#: Numbers without what may stand before them: a label, and any separators behind it.
HYPHENATED_CORE = rf"0{D}{{1,4}}(?:[\-－‐‑–—・]|{WS}){D}{{2,4}}(?:[\-－‐‑–—・]|{WS}){D}{{3,4}}"
BRACKETED_CORE = rf"\(0{D}{{1,4}}\)(?:[\-－]|{WS})?{D}{{2,4}}[\-－]{D}{{3,4}}"
HYPHENATED_LABELS, BRACKETED_LABELS = ("TEL", "Tel", "tel", "電話", "℡", "☎"), ("TEL", "Tel", "電話")
SEPARATORS = ":：" + WS_CHARACTERS
FREE = rf"0120[\-－]?{D}{{2,3}}[\-－]?{D}{{3,4}}"
MAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
MAIL_ONCE = r"(?:(?<![a-zA-Z0-9._%+\-])|\G)[a-zA-Z0-9._%+\-]++@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
NEAR_PHONE = (
    "代表", "直通", "採用", "人事", "HR", "hr", "総務", "受付", "窓口", "問い合わせ", "お問い合わせ", "新卒", "中途", "本社", "支社", "支店", "営業所",
    "東京", "大阪", "名古屋", "福岡", "札幌", "仙台", "採用担当", "人事部",
)
MAIL_KINDS = (
    ("recruit", ("recruit", "saiyou", "採用", "新卒", "saiyo")),
    ("hr", ("hr", "jinji", "人事", "career", "キャリア")),
    ("info", ("info", "information", "contact", "お問い合わせ", "inquiry")),
)
SIGNALS = ("電話", "TEL", "メール", "e-mail", "採用", "人事", "担当")
PRIORITIES = {1: "採用/人事直通", 2: "採用部署代表", 3: "会社代表", 4: "その他"}


def normal_phone(c: Column) -> Column:
    s = F.translate(c, WIDE_DIGITS + "－‐‑–—・", DIGITS + "------")
    return F.translate(F.regexp_replace(s, WS, ""), "()", "")


def phone_digits(c: Column) -> Column:
    """The number's digits if there are 10 or 11, else null."""
    d = F.regexp_replace(F.translate(c, WIDE_DIGITS, DIGITS), "[^0-9]", "")
    return F.when(F.length(d).isin(10, 11), d)


def _matches(text: Column, core: str, sign: str, labels: tuple[str, ...] = ()) -> Column:
    """(raw, place) of each match of core in order; place counts from 0, at the label or the first
    separator before it, if there are such behind the match before. Texts without the sign, which
    every match opens with, are not searched."""
    none = F.array().cast("array<struct<raw:string,char_position:int>>")
    found = F.regexp_extract_all(text, F.lit(core), F.lit(0))

    def step(acc: Column, raw: Column) -> Column:
        at = F.call_function("locate", raw, text, acc["next"])
        before = F.substring(text, acc["next"], at - acc["next"]) if labels else None

        def begin(bare: Column) -> Column:
            size = F.lit(0)
            for word in labels:
                size = F.when(F.endswith(bare, F.lit(word)), len(word)).otherwise(size)
            return acc["next"] + F.length(bare) - size

        start = let(F.rtrim(before, F.lit(SEPARATORS)), begin) if labels else at
        return F.struct((at + F.length(raw)).alias("next"), F.concat(acc["out"], F.array(F.struct(raw.alias("raw"), (start - 1).alias("char_position")))).alias("out"))

    every = F.aggregate(found, F.struct(F.lit(1).alias("next"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.isNull() | F.contains(text, F.lit(sign)), every).otherwise(none)


def phones(text: Column, window: int = 100) -> Column:
    """Array of (raw, normalized, context_keywords, char_position), one for each normal form, in the
    order of the patterns and then of the text."""
    every = F.concat(_matches(text, HYPHENATED_CORE, "0", HYPHENATED_LABELS), _matches(text, BRACKETED_CORE, "(0", BRACKETED_LABELS), _matches(text, FREE, "0120"))
    full = F.transform(every, lambda x: F.struct(x["raw"].alias("raw"), normal_phone(x["raw"]).alias("normalized"), x["char_position"].alias("char_position")))
    valid = F.filter(full, lambda x: F.length(F.regexp_replace(x["normalized"], "[^0-9]", "")).between(10, 12))

    def labelled(hit: Column) -> Column:
        begin = F.greatest(hit["char_position"] - window, F.lit(0))
        around = F.substring(text, begin + 1, F.greatest(hit["char_position"] + window - begin, F.lit(0)))
        words = let(around, lambda a: F.filter(F.array(*map(F.lit, NEAR_PHONE)), lambda w: F.contains(a, w)))
        return F.struct(hit["raw"].alias("raw"), hit["normalized"].alias("normalized"), words.alias("context_keywords"), hit["char_position"].alias("char_position"))

    def distinct(found: Column) -> Column:
        names = F.transform(found, lambda x: x["normalized"])
        return F.filter(found, lambda x, i: F.array_position(names, x["normalized"]) == i + 1)

    return F.transform(let(valid, distinct), labelled)


def mail_kind(address: Column) -> Column:
    local = F.lower(F.substring_index(address, "@", 1))
    out = F.lit("other")
    for kind, words in reversed(MAIL_KINDS):
        out = F.when(F.array_contains(F.transform(F.array(*map(F.lit, words)), lambda w: F.contains(local, w)), True), F.lit(kind)).otherwise(out)
    return out


def emails(text: Column) -> Column:
    """Array of (address, keyword_hint), distinct, in the order of the text. Runs of characters are tried
    once, from their start or the end of the address before, and only in texts with an @."""
    all_of = F.when(text.isNull() | F.contains(text, F.lit("@")), F.regexp_extract_all(text, F.lit(MAIL_ONCE), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = F.array_distinct(F.transform(all_of, F.lower))
    return F.transform(found, lambda a: F.struct(a.alias("address"), mail_kind(a).alias("keyword_hint")))


def has_signals(text: Column) -> Column:
    """Whether text may hold a contact: cheap words first, then the patterns, without what they do not
    need to match and where a sign of theirs is there."""
    words = F.lit(False)
    for w in SIGNALS:
        words = words | F.contains(text, F.lit(w))
    has = lambda sign: F.contains(text, F.lit(sign))
    return words | (has("@") & text.rlike(MAIL)) | (has("0") & text.rlike(HYPHENATED_CORE)) | (has("(0") & text.rlike(BRACKETED_CORE))


def priority_label(c: Column) -> Column:
    out = F.lit(PRIORITIES[4])
    for k, v in PRIORITIES.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def masked(c: Column) -> Column:
    """For reports: letters and digits of a contact value hidden but for the last two characters."""
    hidden = F.regexp_replace(F.substring(c, F.lit(1), F.greatest(F.length(c) - 2, F.lit(0))), r"[\p{L}\p{Nd}]", "*")
    return F.concat(hidden, F.right(c, F.lit(2)))
