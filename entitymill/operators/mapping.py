"""Raw labels to canonical names.

The dictionary of aliases is a dimension. Exact steps are equi-joins. In the last step one contains
the other and the longest alias wins. An alias inside a label is a prefix of one of its suffixes: of
all of them the longest is found beside the suffix's place among the sorted aliases. A label inside
aliases is a range of their sorted suffixes. So no label meets the aliases that share a part with it,
however common that is.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.functions.names import label_key, without_notes
from entitymill.operators.ordered import places, range_minima
from entitymill.scratch import written

MIN_ALIAS = 3


def _suffixes(c: Column, length: Column) -> Column:
    """All suffixes of a text, up to a length."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, length)))


def longest_inside(labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """(n, rank) of texts n (distinct) that hold an alias: the rank of the longest one. aliases: k, rank."""
    # of each alias the aliases that it begins with, the longest last
    own = aliases.select("k", F.explode(F.sequence(F.lit(1), F.length("k"))).alias("l")).select("k", F.expr("left(k, l)").alias("start"))
    chain = own.join(aliases.select(F.col("k").alias("start"), "rank"), "start").groupBy("k").agg(F.array_sort(F.collect_list(F.struct(F.length("start").alias("l"), "start", "rank"))).alias("chain"))
    longest = F.lit(aliases.agg(F.coalesce(F.max(F.length("k")), F.lit(0))).first()[0])
    parts = labels.select("n", F.explode(_suffixes(F.col("n"), longest)).alias("u"))
    probes = parts.select("u").distinct().withColumn("at", F.concat(F.col("u").cast("binary"), F.unhex(F.lit("00"))))
    keys, found = places(chain.withColumn("at", F.col("k").cast("binary")), probes, "at")
    # the last alias that is not behind the suffix shares with it the longest prefix that is an alias
    beside = found.select("u", (F.col("place") - 1).alias("place")).join(keys.select("place", "chain"), "place")
    best = beside.withColumn("hit", F.try_element_at(F.filter("chain", lambda c: F.startswith(F.col("u"), c["start"])), F.lit(-1))).where("hit IS NOT NULL")
    return parts.join(best.select("u", "hit.rank"), "u").groupBy("n").agg(F.min("rank").alias("rank"))


def longest_around(labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """(n, rank) of texts n (distinct) that an alias holds: the rank of the longest one."""
    longest = F.lit(labels.agg(F.coalesce(F.max(F.length("n")), F.lit(0))).first()[0])
    keys = aliases.select("rank", F.explode(_suffixes(F.col("k"), longest)).alias("suffix")).groupBy("suffix").agg(F.min("rank").alias("rank"))
    ends = F.explode(F.array(F.col("n").cast("binary"), F.concat(F.col("n").cast("binary"), F.unhex(F.lit("FF")))))
    placed, probes = places(keys.select(F.col("suffix").cast("binary").alias("at"), "rank"), labels.select("n", ends.alias("at")), "at")
    ranges = probes.groupBy("n").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low < high")
    return range_minima(placed, ranges, "rank", ["n"])


def map_labels(labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """labels: label. aliases: alias, canonical, pos. Gives label and canonical (null: unknown)."""
    known = aliases.select(label_key(F.col("alias")).alias("k"), "canonical", "pos").groupBy("k").agg(F.max_by("canonical", "pos").alias("canonical"), F.min("pos").alias("pos"))
    rows = labels.select("label").distinct().withColumn("n", label_key(F.col("label"))).withColumn("s", without_notes(F.col("n")))
    one = known.select(F.col("k").alias("k1"), F.col("canonical").alias("c1"))
    two = known.select(F.col("k").alias("k2"), F.col("canonical").alias("c2"))
    rows = rows.join(one, F.col("n") == F.col("k1"), "left").join(two, (F.col("s") == F.col("k2")) & (F.col("s") != "") & (F.col("s") != F.col("n")), "left")
    rows = rows.select("label", "n", F.coalesce("c1", "c2").alias("exact"))

    rows = written(rows)
    open_ = rows.where("exact IS NULL AND n <> ''").select("n").distinct()
    # the longest alias ranks first, of equally long ones the first
    long = known.where(F.length("k") >= MIN_ALIAS).select("k", F.struct((-F.length("k")).alias("size"), "pos", "canonical").alias("rank"))
    hits = longest_inside(open_.where(F.length("n") >= MIN_ALIAS), long).unionByName(longest_around(open_, long))
    part = rows.where("exact IS NULL").join(hits.groupBy("n").agg(F.min("rank")["canonical"].alias("partial")), "n").select("label", "partial")
    return rows.join(part, "label", "left").select("label", F.coalesce("exact", "partial").alias("canonical"))


def map_fields(fields: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """fields: entity, media, label, value, pos. Mapped (first label of a canonical wins), and what
    no alias covers."""
    mapped = fields.join(map_labels(fields, aliases), "label")
    best = mapped.where("canonical IS NOT NULL").groupBy("entity", "media", "canonical").agg(F.min_by("value", "pos").alias("value"))
    return best, mapped.where("canonical IS NULL").select("entity", "media", "label", "value", "pos")


def unmapped_counts(rows: DataFrame, label: str, pos: str) -> DataFrame:
    """label, n and first_pos, most frequent first, ties by first sight."""
    return rows.groupBy(label).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos")).orderBy(F.desc("n"), "first_pos")


def accept_suggestions(mapped: DataFrame, suggested: DataFrame, canonicals: DataFrame) -> DataFrame:
    """Suggestions that name a known canonical and override nothing are added to mapped
    (entity, media, canonical, value)."""
    fresh = suggested.join(canonicals, "canonical", "left_semi").join(mapped, ["entity", "media", "canonical"], "left_anti")
    return mapped.unionByName(fresh.select(*mapped.columns))


#: Labels of forms and navigation, that no suggestion is asked for.
SKIPPED = (
    "会員の方はこちら", "まだ会員でない方は", "ログイン / 新規会員登録", "OpenES", "内々定", "時給制、日給制、週給制、月給制", "年俸制、半期年俸制", "その他のポイント",
    "注意事項", "応募方法", "セミナー／説明会", "直近の説明会・面接", "お知らせ・イベント", "エントリー完了企業", "エントリーできなかった企業",
)
SKIPPED_STARTS, SKIPPED_YEAR, SKIPPED_NOTICE = ("セミナー", "説明会"), "年卒", "情報"


def is_skipped(label: Column) -> Column:
    """Whether a label is chrome: listed, a seminar, or a year's notice."""
    starts = reduce(or_, [label.startswith(s) for s in SKIPPED_STARTS])
    return label.isin(*SKIPPED) | starts | (F.contains(label, F.lit(SKIPPED_YEAR)) & F.contains(label, F.lit(SKIPPED_NOTICE)))


def worth_asking(unmapped: DataFrame, label: str = "label") -> DataFrame:
    """Rows of unmapped whose label may be a field."""
    return unmapped.where(~is_skipped(F.col(label)))
