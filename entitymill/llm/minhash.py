"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

A document is the set of its distinct word shingles. Documents with equal sets form a class, and
from there on classes stand for their documents. SuperMinHash gives each shingle a permutation of
the slots; level by level, a shingle offers its rank plus a random fraction to the slot that its
permutation names next, and a document stops as soon as no slot can still improve. Bands of slots
hash classes into buckets.

All pairs of a bucket are never listed. First, each bucket compares its members with one of them,
the one that stands in the most and fullest buckets: the original among its copies. Verified links
are joined into components, and buckets that lie in one component are done. For what is left, two
counts bound each intersection from above: a document's shingles shared with its bucket's first
centre, and those that no other open document holds. Two documents of a bucket have in common at most
the lesser of what they share with the centre, and outside it the lesser of what others hold too; a
pair for which that is too few is never made. After a round with other centres, the open pairs that
this bound allows are compared exhaustively. So every pair that shares a bucket
is verified, already joined, or proven to be no link. Links are confirmed on the full sets, exactly.
With 32 bands of 5 slots, a pair at similarity 0.8 shares no bucket with a probability of about
3e-6, less above.

Components come from a union-find over parts of at most UNITE links; if there is more than one part,
alternating stars over the cluster join the parts' forests until nothing changes. No links, labels
or fingerprints go to the driver.

Defined results: a null or empty text, or one without words, has the empty set and is linked with
nothing. Fewer words than a shingle are one shingle. Rows that repeat, also with the same doc_id,
are each returned; unlike texts that share a doc_id have the same id, but are linked, and counted as
one component, only if their sets say so. A component's id is its smallest doc_id; a null doc_id is
never that if another is there. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import WORD, discard, materialize, scratch_tables

BANDS, ROWS = 32, 5
#: Rounds in which each open bucket has one centre, before its open pairs are compared one by one.
ROUNDS = 2
#: Links that a task joins at a time.
UNITE = 200_000
#: Shingles that are sketched together: their permutations stay in a core's cache.
TOGETHER = 1 << 14
SLICE = 1 << 20

U = np.uint64
_GOLD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of the whole text, A-Z in lower case."""
    data, out, start = (text or "").encode().lower(), [], 0
    while start < len(data):
        gap = re.compile(rb"[\x20\x09-\x0d]").search(data, start + SLICE) if len(data) - start > SLICE else None
        stop = gap.start() if gap else len(data)
        if words := data[start:stop].split():
            out.append(pd.util.hash_array(np.array(words, dtype=object), categorize=False))
        start = stop
    return np.concatenate(out) if out else np.empty(0, U)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - k + 1)
    total = np.full(n, (min(len(w), k) * _GOLD) & _MASK, U)
    for j in range(min(len(w), k)):
        total += w[j : j + n] * U((_GOLD * (2 * j + 3)) & _MASK | 1)
        total = _mix(total)
    return np.unique(total)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash of non-empty sets: m slots each, level in the upper 16 bits."""
    sig = np.full(len(sets) * m, _MASK, U)
    begin = 0
    while begin < len(sets):
        end, n = begin, 0
        while end < len(sets) and (end == begin or n + len(sets[end]) <= TOGETHER):
            n += len(sets[end])
            end += 1
        doc = np.repeat(np.arange(begin, end), [len(s) for s in sets[begin:end]])
        element, perm = np.concatenate(sets[begin:end]), None
        for j in range(m):
            x = _mix(element + U((_GOLD * (j + 1)) & _MASK))
            k = j + (((x & U(0xFFFF)) * U(m - j)) >> U(16)).astype(np.int64)
            if j == 0:
                slot = k
            else:
                at = np.arange(len(perm))
                slot = perm[at, k].astype(np.int64)
                perm[at, k] = perm[:, j]
                perm[:, j] = slot
            np.minimum.at(sig, doc * m + slot, (x >> U(16)) | U(j << 48))
            open_docs = sig[begin * m : end * m].reshape(-1, m).max(axis=1) >= U((j + 1) << 48)
            keep = open_docs[doc - begin]
            if not keep.any():
                break
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint16), (int(keep.sum()), 1))
                at, k = np.arange(len(perm)), k[keep]
                perm[at, k] = 0
                perm[:, 0] = k
            elif not keep.all():
                perm = perm[keep]
            if not keep.all():
                element, doc = element[keep], doc[keep]
        begin = end
    return sig.reshape(len(sets), m)


def bands(sig: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(len(sig), n_bands, rows)
    total = np.broadcast_to(np.arange(1, n_bands + 1, dtype=U) * U(_GOLD), parts.shape[:2]).copy()
    for i in range(rows):
        total = _mix(total + parts[:, :, i])
    return total.view(np.int64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def is_link(a: int, b: int, both: int, percent: int) -> bool:
    """100 * intersection >= percent * union."""
    return 100 * both >= percent * (a + b - both)


def _sketch(k: int, n_bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.as_py(), k) for t in part.column("text")]
                some = [i for i, s in enumerate(sets) if len(s)]
                found = bands(signatures([sets[i] for i in some], n_bands * rows), n_bands, rows) if some else []
                keys: list = [None] * len(sets)
                lists: list = [None] * len(sets)
                for i, row in zip(some, found):
                    keys[i], lists[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "t", "n", "node", "bands"],
                )

    return run


def _verify(k: int, percent: int):
    """Rows (a, text_a, b, text_b), those with equal a close together, to the number of shingles in
    both and whether they are a link."""

    def run(batches):
        last, left = None, None
        for batch in batches:
            both, linked = [], []
            for a, text_a, text_b in zip(*(batch.column(c) for c in ("a", "text_a", "text_b"))):
                if (a := a.as_py()) != last:
                    last, left = a, shingles(text_a.as_py(), k)
                right = shingles(text_b.as_py(), k)
                both.append(common(left, right))
                linked.append(is_link(len(left), len(right), both[-1], percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "both", "linked"])

    return run


def _union_find(batches):
    """The links of a partition to (node, root) of the same components; root is the smallest."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def rows():
        out = [(x, root(x)) for x in parent if root(x) != x]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], names=["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u"), batch.column("v")):
            u, v = root(u.as_py()), root(v.as_py())
            parent[max(u, v)] = min(u, v)
    yield rows()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (u, v): root is the smallest node it is connected with."""
    parts = max(1, -(-links.count() // UNITE))
    dealt = links.coalesce(1) if parts == 1 else links.repartition(parts)
    with scratch_tables() as made:
        now = materialize(dealt.mapInArrow(_union_find, "u binary, v binary"), "forest")
        while parts > 1:
            both = now.union(now.select("v", "u"))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u")
            small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).distinct()
            after = materialize(small, "stars")
            done = now.count() == after.count() and after.join(now, ["u", "v"], "left_anti").isEmpty()
            discard(links.sparkSession, made[-2:-1])
            now = after
            if done:
                break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _explode_shingles(k: int):
    def run(batches):
        for batch in batches:
            for node, text in zip(batch.column("node"), batch.column("text")):
                found = shingles(text.as_py(), k)
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(found), pa.binary()), pa.array(found.view(np.int64))], names=["node", "h"])

    return run


def _own_shingles(texts: DataFrame, k: int) -> DataFrame:
    """(node, own): how many shingles of a text no other of the texts holds; nodes without any are
    left out."""
    seen = texts.mapInArrow(_explode_shingles(k), "node binary, h long")
    once = seen.groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    return once.groupBy("node").agg(F.count("*").alias("own"))


def _measured(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) with both, the size of their intersection, and linked."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "text_a", "b", "text_b").mapInArrow(_verify(k, percent), "a binary, b binary, both long, linked boolean")


def _across(slots: DataFrame, forest: DataFrame) -> DataFrame:
    """slots with the root of their node, of the buckets that hold nodes of several components."""
    labels = forest.withColumnRenamed("node", "_n")
    rows = slots.join(labels, slots["node"] == labels["_n"], "left").select(*slots.columns, F.coalesce("root", "node").alias("root"))
    mixed = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    return rows.join(mixed, "bucket")


def near_duplicate_rows(docs: DataFrame, k: int, percent: int = 80, n_bands: int = BANDS, rows: int = ROWS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, component_id and root of each row of docs. Rows are
    of one component if their roots are equal; root is null for a row without shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    sketches = materialize(source.mapInArrow(_sketch(k, n_bands, rows), f"doc_id {kind}, t long, n long, node binary, bands array<long>"), "sketches")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("first")
    classes = materialize(sketches.where("node IS NOT NULL").groupBy("node").agg(first, F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    slots = classes.select("node", "n", F.explode("bands").alias("bucket"))
    crowded = slots.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    slots = materialize(slots.join(crowded, "bucket"), "slots")

    wanted = slots.select("node").distinct().join(classes, "node").select("node", F.col("first.doc_id").alias("_d"), F.col("first.t").alias("_t"))
    chosen = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")))
    texts = materialize(chosen.select("node", "text").dropDuplicates(["node"]), "texts")

    fame = slots.join(slots.groupBy("bucket").agg(F.count("*").alias("size")), "bucket").groupBy("node").agg(F.sum("size").alias("fame"))
    ranked = slots.join(fame, "node")
    hubs = materialize(ranked.groupBy("bucket").agg(F.min(F.struct((-F.col("fame")).alias("f"), F.col("node").alias("c"))).alias("x")).select("bucket", "x.c"), "hubs")
    pairs = slots.join(hubs, "bucket").where("node <> c").select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
    tested = materialize(_measured(pairs, texts, k, percent), "measured")
    forest = components(tested.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))

    # what still lies across components, with what bounds its intersections
    open_slots = _across(slots, forest).join(hubs, "bucket").withColumn("a", F.least("node", "c")).withColumn("b", F.greatest("node", "c"))
    open_slots = open_slots.join(tested.select("a", "b", "both"), ["a", "b"], "left").select("bucket", "node", "n", "root", F.when(F.col("node") == F.col("c"), F.col("n")).otherwise(F.col("both")).alias("inside"))
    open_slots = materialize(open_slots, "open")
    own = _own_shingles(texts.join(open_slots.select("node").distinct(), "node"), k)
    outside = F.col("n") - F.col("inside") - F.coalesce("own", F.lit(0))
    open_slots = open_slots.join(own, "node", "left").withColumn("outside", outside).drop("own")
    open_slots = materialize(open_slots.where((F.col("inside") + F.col("outside")) * 100 >= F.col("n") * percent), "open")

    reach = F.least("inside", "ci") + F.least("outside", "co")
    possible = reach * (100 + percent) >= (F.col("n") + F.col("cn")) * percent
    for turn in range(1, rounds + 1):
        if turn > 1:
            open_slots = materialize(_across(open_slots.drop("root"), forest), "open")
        last = turn == rounds
        mine = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("c"), F.col("n").alias("cn"), F.col("root").alias("cr"), F.col("inside").alias("ci"), F.col("outside").alias("co"))
        apart = F.col("root") != F.col("cr")
        if last:
            # a pair is made in the first bucket that it shares, and there alone
            shared = open_slots.groupBy(F.col("node").alias("_n")).agg(F.collect_set("bucket").alias("own"))
            here = open_slots.join(shared, F.col("node") == F.col("_n")).drop("_n")
            other = here.select("bucket", mine.alias("x"), F.col("own").alias("theirs")).select("bucket", "x.*", "theirs")
            apart = (F.col("node") < F.col("c")) & apart & possible & (F.array_min(F.array_intersect("own", "theirs")) == F.col("bucket"))
        else:
            here, other = open_slots, open_slots.groupBy("bucket").agg(F.min(mine).alias("x")).select("bucket", "x.*")
        pairs = here.join(other, "bucket").where(apart & possible).select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
        pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = materialize(_measured(pairs, texts, k, percent), "measured")
        tested = tested.union(found)
        links = found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        forest = components(links.union(forest.select(F.col("node").alias("u"), F.col("root").alias("v"))))

    members = classes.select(F.col("node").alias("_n"), F.col("first.doc_id").alias("_d"))
    members = members.join(forest, members["_n"] == forest["node"], "left").select("_n", "_d", F.coalesce("root", "_n").alias("root"))
    smallest = members.groupBy("root").agg(F.min("_d").alias("component_id"))
    members = members.select("_n", "root").join(smallest, "root").select("_n", "component_id", "root")
    found = sketches.select("doc_id", "t", "n", "node").join(members, F.col("node") == F.col("_n"), "left")
    return found.select("doc_id", "t", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, **how) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs (doc_id, text)."""
    rows = near_duplicate_rows(docs, k, percent, **how)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, **how) -> DataFrame:
    """docs, all columns, one row of each component: that of its smallest doc_id, a null one only if
    there is no other. Rows without words are linked with nothing and all stay."""
    rows = near_duplicate_rows(docs, k, percent, **how)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n_shingles", "t")).alias("x")
    kept = rows.where("root IS NOT NULL").groupBy("root").agg(first)
    kept = kept.select("root", F.col("x.doc_id").alias("first_id"), F.col("x.t").alias("first_t"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    found = docs.where(worded).select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("t"))
    found = found.join(kept, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("t") == F.col("first_t")))
    return found.select("root", "row").dropDuplicates(["root"]).select("row.*").union(docs.where(~worded))
