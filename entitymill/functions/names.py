"""Names of companies and labels in the form in which they are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymill.functions.text import WS, let, nfkc, strip

#: Legal forms that are left out of a name, common to all profiles and by profile.
LEGAL = ("株式会社", r"\(株\)", "（株）", "有限会社", "合同会社", "合資会社", "一般社団法人", "一般財団法人", "公益社団法人", "公益財団法人")
LEGAL_MORE = (r"\(有\)", "（有）", r"\(同\)", "（同）", "合名会社", "医療法人", "社会福祉法人", "学校法人", "宗教法人", "NPO法人", "特定非営利活動法人", "独立行政法人")
LEGAL_MASTER = ("㈱", "社団法人", "財団法人")
NOTE = r"[（(\[【][^）)\]】]*[）)\]】]"
QUOTES = "\"'「」『』【】"


def _without_forms(c: Column, forms: tuple[str, ...]) -> Column:
    return F.regexp_replace(c, "|".join(forms), "")


def _one_space(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def _composed(c: Column) -> Column:
    return nfkc(strip(F.coalesce(c, F.lit(""))))


def master_name(c: Column) -> Column:
    """Profile of the company master: notes go before quotes, at the start as well as at the end."""
    s = _one_space(_without_forms(_composed(c), (*LEGAL, *LEGAL_MORE, *LEGAL_MASTER)))
    s = strip(F.regexp_replace(F.regexp_replace(s, rf"^{NOTE}{WS}*", ""), rf"{WS}*{NOTE}{WS}*$", ""))
    return F.trim(s, F.lit(QUOTES))


def listing_name(c: Column) -> Column:
    """Profile of the job listings: quotes go before the note at the end."""
    s = F.trim(_one_space(_without_forms(_composed(c), (*LEGAL, *LEGAL_MORE))), F.lit(QUOTES))
    return strip(F.regexp_replace(s, rf"{WS}*{NOTE}{WS}*$", ""))


def review_name(c: Column) -> Column:
    """Profile of the review site: fewer legal forms, small letters."""
    return F.lower(strip(_without_forms(nfkc(F.coalesce(c, F.lit(""))), LEGAL)))


def label_key(c: Column) -> Column:
    """A label without white space, in small letters."""
    return F.lower(F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), f"{WS}+", ""))


def without_notes(c: Column) -> Column:
    """A label key without bracketed notes and what follows a reference mark."""
    bare = F.regexp_replace(c, r"[（(\[【「][^）)\]】」]*[）)\]】」]", "")
    return strip(F.regexp_replace(bare, "[※*].+$", ""))


def without_region_code(c: Column) -> Column:
    return F.regexp_replace(c, "^[0-9]{2}:", "")


PROFILES = {"master": master_name, "listing": listing_name, "review": review_name}

__all__ = ["PROFILES", "label_key", "let", "listing_name", "master_name", "review_name", "without_notes", "without_region_code"]
