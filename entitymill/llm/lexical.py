"""Ranked lexical search: the ten best documents of each item, by variable-block-max WAND.

Index. The task that reads documents cuts them into shards of a bounded number of postings, of the
terms that the items ask for (of all terms, if they ask for too many to be sent). A shard
numbers its documents by doc_id and holds, for each of its terms, the documents and the impacts (the
factor of the score that depends on the document). Dynamic programming cuts each list into blocks of
variable length, so that the sum over all blocks of what their maximum overstates, and a fixed cost
for each block, is smallest. Lists, blocks and maxima are written once to the shared folder; no text
is shuffled.

Search. The items come in blocks of a bounded number of terms. Only lists of their terms are read.
A shard is searched by one task: the ends of the blocks of an item's lists cut its documents into
ranges, in each of which every list has one block. The sum of the blocks' maxima bounds the scores
in the range (the pivot test of WAND, for all ranges at once). Ranges are evaluated from the highest
bound down; those that cannot reach the score of the k-th best document so far are skipped with all
their postings, and no other. The best documents of the shards are merged by rank.

The score is that of `score_terms`, in 64-bit integers (a term's weight is floored from doubles).

Defined results: a null or empty text, or one without terms, is no document for the statistics and
is never found; an item without terms finds nothing. Rows that repeat, also with one doc_id or a null
one, are documents of their own; null ids rank behind all others of equal score. Items that repeat
each give their rows. Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitymill.llm.common import ascii_lower, materialize

#: A term is a longest run of these characters, only A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Postings of a shard, terms of a block of items (both about), and results of an item.
SHARD_POSTINGS, BLOCK_TERMS, BEST = 3_000_000, 200_000, 10
#: Longest block, and what a block costs, in units of impact.
REACH, BLOCK_COST = 32, 3_000_000
#: Ranges evaluated first; each further round takes twice as many.
FIRST_RANGES = 64

#: UTF-8 bytes: A-Z in lower case, those of no term to a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m), m = 10 + (90 n docs) div total."""
    m = 10 + (90 * n.astype(np.int64) * docs) // total
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


def variable_blocks(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, reach: int = REACH, cost: int = BLOCK_COST) -> np.ndarray:
    """Marks the last posting of each block. List i is values[starts[i]:starts[i] + lengths[i]].

    best[t], the least cost of the first t postings, is the minimum over the last block's length k
    of best[t - k] + k * (maximum of those k) + cost. One step handles the t-th posting of all lists
    that are so long; costs are kept relative to one another, which 32 bits hold."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    choice = np.zeros(len(values), np.uint8)
    if not len(values):
        return choice.astype(bool)
    longest = int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    sizes = np.arange(1, reach + 1, dtype=np.int32)
    top = np.zeros((len(starts), reach), np.int32)
    best = np.full((len(starts), reach), 1 << 30, np.int32)  # best[:, k]: k + 1 postings back from the end of the block
    best[:, 0] = 0
    for t in range(longest):
        a, w = alive[t], min(t + 1, reach)
        s = values[starts[:a] + t].astype(np.int32)
        top[:a, 1:w] = top[:a, : w - 1]
        top[:a, 0] = 0
        np.maximum(top[:a, :w], s[:, None], out=top[:a, :w])
        total = best[:a, :w] + top[:a, :w] * sizes[:w]
        pick = total.argmin(1)
        found = total[np.arange(a), pick] + cost
        choice[starts[:a] + t] = pick
        if t + 1 < longest:
            w = min(t + 2, reach)
            best[:a, 1:w] = best[:a, : w - 1]
            best[:a, 0] = found
            best[:a, :w] -= best[:a, w - 1 : w].copy()
    last = np.zeros(len(values), bool)
    at = lengths - 1
    while len(at):
        last[starts + at] = True
        at = at - choice[starts + at] - 1
        starts, at = starts[at >= 0], at[at >= 0]
    return last


_INDEX = "shard long, term string, n long, docs binary, impacts binary, ends binary, tops binary"


class _Shard:
    """Documents on their way to a shard."""

    def __init__(self, only: frozenset[bytes] | None) -> None:
        self.only = only
        self.ids: list = []
        self.sizes: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.postings = 0

    def add(self, doc_id, text: bytes) -> None:
        found = Counter(words := terms(text))
        if self.only is not None:
            found = {w: n for w, n in found.items() if w in self.only}
        if not found:
            return
        number = self.numbers
        which = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found))
        self.parts.append((which, np.fromiter(found.values(), np.int32, len(found))))
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.postings += len(found)

    def rows(self, shard: int, docs: int, total: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        rank = np.empty(len(self.ids), np.int32)
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))
        rank[order] = np.arange(len(order), dtype=np.int32)
        which = np.concatenate([a for a, _ in self.parts])
        tf = np.concatenate([b for _, b in self.parts])
        doc = np.repeat(np.arange(len(self.ids)), [len(a) for a, _ in self.parts])
        size = np.asarray(self.sizes, np.int64)[doc]
        doc = rank[doc]
        at = np.lexsort((doc, which))
        which, doc, impact = which[at], doc[at], impacts(tf, size, docs, total)[at].astype(np.int32)
        lengths = np.bincount(which, minlength=len(self.numbers))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        last = variable_blocks(impact, starts, lengths)
        begins = np.flatnonzero(np.concatenate([[True], last[:-1]]))
        tops = np.maximum.reduceat(impact, begins)
        ends = doc[last]
        # blocks of a list are neighbours
        blocks = np.concatenate([[0], np.cumsum(np.add.reduceat(last.astype(np.int64), starts))])
        names = list(self.numbers)
        # without terms stand the documents
        yield _batch([shard], [None], [len(order)], [b""], [b""], [b""], [b""], [[self.ids[i] for i in order]], kind)
        step = 20_000
        for a in range(0, len(names), step):
            part = range(a, min(len(names), a + step))
            cut = lambda x, i: x[starts[i] : starts[i] + lengths[i]].tobytes()
            yield _batch(
                [shard] * len(part), [names[i].decode() for i in part], [int(lengths[i]) for i in part],
                [cut(doc, i) for i in part], [cut(impact, i) for i in part],
                [ends[blocks[i] : blocks[i + 1]].tobytes() for i in part], [tops[blocks[i] : blocks[i + 1]].tobytes() for i in part],
                [None] * len(part), kind,
            )


def _batch(shard, term, n, docs, impact, ends, tops, ids, kind) -> pa.RecordBatch:
    data = [pa.array(shard, pa.int64()), pa.array(term, pa.string()), pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (docs, impact, ends, tops)), pa.array(ids, pa.list_(kind))]
    return pa.RecordBatch.from_arrays(data, names=["shard", "term", "n", "docs", "impacts", "ends", "tops", "ids"])


def statistics(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms(t.as_py())) for t in batch.column("text").drop_null().cast(pa.binary())]
            yield pa.RecordBatch.from_pydict({"docs": [sum(map(bool, sizes))], "total": [sum(sizes)]})

    return docs.select("text").mapInArrow(run, "docs long, total long").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("docs", "total"))).first()


def build_index(docs: DataFrame, n_docs: int, total: int, only: frozenset[bytes] | None = None, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The index of docs (doc_id, text), written once, of all terms or of some; with the statistics of docs.

    It has a row for each term of a shard: its documents' numbers and impacts (int32), and the last
    document and largest impact of each block; and a row without term with a shard's doc_ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, shard = TaskContext.get().partitionId(), 0, _Shard(kept.value)
        own = None
        for batch in batches:
            own = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                shard.add(doc_id, text.as_py() or b"")
                if shard.postings >= shard_postings:
                    yield from shard.rows((part << 32) + count, n_docs, total, own)
                    count, shard = count + 1, _Shard(kept.value)
        if shard.postings:
            yield from shard.rows((part << 32) + count, n_docs, total, own)

    return materialize(docs.select("doc_id", "text").mapInArrow(run, f"{_INDEX}, ids array<{kind}>"), "index")


class Postings:
    """One term's list in a shard."""

    def __init__(self, docs: bytes, impact: bytes, ends: bytes, tops: bytes) -> None:
        self.docs, self.impacts, self.ends, self.tops = (np.frombuffer(x, np.int32) for x in (docs, impact, ends, tops))


def search_shard(lists: list[tuple[int, Postings]], n_docs: int, best: int = BEST, first: int = FIRST_RANGES) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, their scores, number of postings evaluated) of the best documents with a score
    above 0; lists: (weight, postings) of an item's terms. Equal scores go by document number."""
    lists = [(w, p) for w, p in lists if w > 0]
    none = np.empty(0, np.int64)
    if not lists:
        return none, none, 0
    ends = np.unique(np.concatenate([p.ends for _, p in lists]))
    bound = np.zeros(len(ends), np.int64)
    for w, p in lists:
        at = np.searchsorted(p.ends, ends)
        inside = at < len(p.ends)
        bound[inside] += w * p.tops[at[inside]].astype(np.int64)
    order = np.argsort(-bound, kind="stable")
    scores = np.zeros(n_docs, np.int64)
    least, done, wide, evaluated = 1, 0, first, 0
    docs = none
    while done < len(order) and bound[order[done]] >= least:
        take = order[done : done + wide]
        take = np.sort(take[bound[take] >= least])
        done, wide = done + wide, wide * 2
        lo, hi = np.where(take > 0, ends[take - 1], -1), ends[take]
        touched = [docs]
        for w, p in lists:
            a, b = np.searchsorted(p.docs, lo, side="right"), np.searchsorted(p.docs, hi, side="right")
            size = b - a
            n = int(size.sum())
            if n:
                at = np.arange(n) + np.repeat(a - np.cumsum(size) + size, size)
                scores[p.docs[at]] += w * p.impacts[at].astype(np.int64)
                touched.append(p.docs[at])
                evaluated += n
        docs = np.unique(np.concatenate(touched)).astype(np.int64)
        docs = docs[scores[docs] > 0]
        docs = docs[np.lexsort((docs, -scores[docs]))][:best]
        if len(docs) == best:
            least = max(1, int(scores[docs[-1]]))
    return docs, scores[docs], evaluated


def _search(block, best: int):
    """A shard's rows to (item, doc_id, score) of the items of a block."""

    def run(shard: pa.Table) -> pa.Table:
        items, weights = block.value
        ids, found = [], {}
        for term, docs, impact, ends, tops, own in zip(*(shard.column(c).to_pylist() for c in ("term", "docs", "impacts", "ends", "tops", "ids"))):
            if term is None:
                ids = own
            else:
                found[term] = Postings(docs, impact, ends, tops)
        out: tuple[list, list, list] = ([], [], [])
        for item, own in items:
            docs, scores, _ = search_shard([(weights[t], found[t]) for t in own if t in found], len(ids), best)
            out[0].extend([item] * len(docs))
            out[1].extend(ids[d] for d in docs.tolist())
            out[2].extend(scores.tolist())
        return pa.table({"item": pa.array(out[0], pa.int64()), "doc_id": pa.array(out[1], shard.schema.field("ids").type.value_type), "score": pa.array(out[2], pa.int64())})

    return run


def score_terms(wanted: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """term and weight of the terms (distinct) that the index holds: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    df = index.join(wanted, "term").groupBy("term").agg(F.sum("n").alias("df"))
    return df.select("term", F.floor(1000 * F.ln((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight"))


def rank_documents(docs: DataFrame, items: DataFrame, *, best: int = BEST, shard_postings: int = SHARD_POSTINGS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of docs (doc_id, text) for each row of
    items (item_id, text)."""
    spark = docs.sparkSession
    rows = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    rows = rows.withColumn("terms", F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(TERM), F.lit(0))))
    rows = materialize(rows.select("item_id", "times", "terms", F.monotonically_increasing_id().alias("item")), "items")
    every = rows.select("item", F.explode("terms").alias("term"))
    wanted = materialize(every.select("term").distinct(), "terms")
    # few terms (their number is checked) are all that the index holds; else it holds every term
    few = wanted.count() <= block_terms
    n_docs, total = statistics(docs)
    index = build_index(docs, n_docs, total, frozenset(r["term"].encode() for r in wanted.collect()) if few else None, shard_postings)
    weights = materialize(score_terms(wanted, index, n_docs).where("weight > 0"), "weights")
    blocks = max(1, -(-every.count() // block_terms))
    found = None
    for b in range(blocks):
        # a block holds about block_terms terms, whatever the number of items
        own = every.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).join(weights, "term").collect()
        by: dict[int, list[str]] = {}
        for r in own:
            by.setdefault(r["item"], []).append(r["term"])
        block = spark.sparkContext.broadcast((sorted(by.items()), weight := {r["term"]: r["weight"] for r in own}))
        mine = F.broadcast(spark.createDataFrame([(t,) for t in weight], "term string"))
        lists = index.where("term IS NULL").unionByName(index.join(mine, "term", "left_semi").select(*index.columns))
        part = lists.groupBy("shard").applyInArrow(_search(block, best), f"item long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
        found = part if found is None else found.unionByName(part)
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    out = ranked.join(rows.select("item", "item_id", "times"), "item")
    return out.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).select("item_id", "rank", "doc_id", "score")
