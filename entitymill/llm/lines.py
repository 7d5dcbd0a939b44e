"""Line dedup: lines that several documents hold stay only in the smallest doc_id.

Lines are exploded once, as 128-bit hashes of their keys with document and position, and written to
the shared folder. Distinct documents are counted per hash, with what a task sees of a hash combined
before each shuffle. The lines that must go are found by a join of the written lines with the keys
over the threshold; the texts are shuffled once, to meet the list of their dropped positions.

A line that a third of all documents hold would be one task of that join. Keys with more lines than
HOT, and more than one in HOT_KEYS of all lines, are therefore joined by broadcast: there are fewer
than HOT_KEYS of them whatever the size of the table. All other keys meet in a shuffle join. Both give
the same rows. All of it runs in the JVM.

Defined results: a null or empty text is one empty line. Rows that share a doc_id are one document
for the count, and rows that repeat are each returned. A null doc_id is one document, ordered after
all others. Other columns are not read by `dedup_lines`. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import ascii_lower, materialize

MIN_CHARS, MIN_DOCS = 10, 2
#: Keys are joined by broadcast above so many lines, if they are also more than one in HOT_KEYS of all.
HOT, HOT_KEYS = 1000, 50_000
STRIP = " \t\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(STRIP)))


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each line whose key is long enough: doc_id, t (hash of the text), position, hash of
    the key. Written once."""
    key = line_key(F.col("line"))
    rows = (
        docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split(_text(F.col("text")), "\n", -1)).alias("pos", "line"))
        .select("doc_id", "t", "pos", key.alias("k"))
        .where(F.length("k") >= min_chars)
        .select("doc_id", "t", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(7), "k").alias("h2"))
    )
    return materialize(rows, "lines")


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, keeper (a struct that orders null last), n_docs and n_lines of keys in min_docs documents."""
    who = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    return (
        lines.groupBy("h1", "h2", "doc_id")
        .agg(F.count("*").alias("n"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_lines"), F.min(who).alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS, hot: int = HOT) -> DataFrame:
    """doc_id, t and pos of the lines that go."""
    shared = materialize(repeated_keys(lines, min_docs).select("h1", "h2", "keeper", "n_lines"), "keys")
    hot = max(hot, lines.count() // HOT_KEYS)
    few = F.broadcast(shared.where(F.col("n_lines") > hot).select("h1", "h2", "keeper"))  # below HOT_KEYS rows
    rest = lines.join(few.select("h1", "h2"), ["h1", "h2"], "left_anti").join(shared.where(F.col("n_lines") <= hot).select("h1", "h2", "keeper"), ["h1", "h2"])
    found = lines.join(few, ["h1", "h2"]).unionByName(rest)
    return found.where(~F.col("doc_id").eqNullSafe(F.col("keeper.id"))).select("doc_id", "t", "pos")


def with_dropped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot: int = HOT) -> DataFrame:
    """`row`, a struct of the columns of docs (so that no name of theirs can clash), and `dropped`, the
    positions of the lines that go, null if none does."""
    drops = dropped_lines(line_table(docs, min_chars), min_docs, hot).groupBy("doc_id", "t").agg(F.collect_set("pos").alias("dropped"))
    drops = materialize(drops, "drops")
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    same = rows["row.doc_id"].eqNullSafe(drops["doc_id"]) & (F.xxhash64(rows["row.text"]) == drops["t"])
    return rows.join(drops, same, "left").select("row", "dropped")


def kept_text(text: Column) -> Column:
    """The text of what stays, of rows of with_dropped. Only texts that lose lines are split."""
    kept = lambda every: F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("dropped"))
    # the lambda's variable holds the lines, which are split once
    joined = F.get(F.transform(F.array(F.split(text, "\n", -1)), lambda every: F.array_join(F.transform(kept(every), lambda i: F.get(every, i)), "\n")), F.lit(0))
    return F.when(F.col("dropped").isNull(), text).otherwise(joined)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot: int = HOT) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text."""
    rows = with_dropped(docs.select("doc_id", "text"), min_chars, min_docs, hot)
    text = _text(F.col("row.text"))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return rows.select(
        "row.doc_id",
        (breaks + 1).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        kept_text(text).alias("kept_text"),
    )


def rewrite_documents(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the same columns, whatever their names, their text deduped; a null text stays null."""
    rows, text = with_dropped(docs, min_chars, min_docs), F.col("row.text")
    new = F.when(text.isNull(), F.lit(None).cast("string")).otherwise(kept_text(text))
    return rows.select(*[(new if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
