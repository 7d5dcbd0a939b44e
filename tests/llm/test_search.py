"""Ranked search against scores of all documents."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitymill.llm import lexical


def brute(docs, items, best=10):
    """(item_id, rank, doc_id, score) from every document's score."""
    split = lambda t: re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(i, split(t)) for i, t in docs]
    rows = [(i, t) for i, t in rows if t]
    n_docs, total = len(rows), sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, t in rows:
            m = 10 + (90 * len(t) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * t.count(w)) // (1000 * t.count(w) + 8 * m)) for w in set(split(text)) if w in t)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:best], 1)]
    return sorted(out, key=str)


def texts(n, seed=0):
    r = random.Random(seed)
    words = ["The", "the", "naïve", "x1", "日本", "a\x00b", "Ünder", "end.", "K", "a_b", *(f"w{i}" for i in range(60))]
    return [" ".join(r.choice(words[: r.choice([5, 20, len(words)])]) for _ in range(r.choice([1, 3, 30, 200]))) for _ in range(n)]


ODD = [None, "", " .,", "x" * 5000, "the " * 4000, "w7 " * 3 + "w8"]


def test_ranks(spark):
    body = [*texts(250), *ODD, *texts(20)[:20]]  # the last repeat the first
    docs = [(None if i % 40 == 0 else i % 130, t) for i, t in enumerate(body)]
    items = [(0, "The w1 w2"), (1, None), (2, "none of these"), (None, "w7, W8 w7 x1"), (3, texts(1, 5)[0]), (3, texts(1, 5)[0]), (4, "日本 naïve a_b"), (4, "k")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit(1)).withColumn("term", F.lit("x")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1)).withColumn("terms", F.lit(1))
    want = brute(docs, items)
    for how in ({}, {"shard_postings": 300}, {"block_terms": 7}, {"block_terms": 3, "shard_postings": 1000}):
        got = lexical.rank_documents(frame, asked, **how)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert lexical.rank_documents(frame.limit(0), asked).count() == 0
    assert lexical.rank_documents(frame, asked.limit(0)).count() == 0


def least_cost(values, reach, cost):
    best = [0]
    for t in range(1, len(values) + 1):
        best.append(min(best[t - k] + k * max(values[t - k : t]) + cost for k in range(1, min(reach, t) + 1)))
    return best[-1]


@pytest.mark.parametrize("cost", [1, 500, 5000])
def test_blocks_cost_least(cost):
    r = np.random.default_rng(cost)
    lists = [r.integers(1, 1000, n) for n in (1, 2, 3, 40, 200, 7, 33, 1)] + [np.repeat(5, 50), np.arange(1, 90)]
    lengths = np.array([len(x) for x in lists])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    last = lexical.variable_blocks(np.concatenate(lists), starts, lengths, 16, cost)
    for x, a, n in zip(lists, starts, lengths):
        ends = np.flatnonzero(last[a : a + n]) + 1
        assert ends[-1] == n
        parts = np.split(x, ends[:-1])
        assert sum(len(p) * p.max() + cost for p in parts) == least_cost(x.tolist(), 16, cost)


def test_blocks_are_skipped():
    """Few documents score high: most postings of a frequent term are not looked at, and the result is that of all."""
    r = np.random.default_rng(3)
    n = 20_000
    often = np.arange(n, dtype=np.int32)
    impact = r.integers(100, 200, n).astype(np.int32)
    impact[r.integers(0, n, 30)] = 5000
    rare = np.sort(r.choice(n, 300, replace=False)).astype(np.int32)
    rare_impact = r.integers(100, 9000, 300).astype(np.int32)
    made = []
    for docs, values in ((often, impact), (rare, rare_impact)):
        last = lexical.variable_blocks(values, np.array([0]), np.array([len(values)]), 32, 3000)
        tops = np.maximum.reduceat(values, np.flatnonzero(np.concatenate([[True], last[:-1]])))
        made.append(lexical.Postings(docs.tobytes(), values.tobytes(), docs[last].tobytes(), tops.tobytes()))
    found, scores, evaluated = lexical.search_shard([(10, made[0]), (30, made[1])], n)
    every = np.zeros(n, np.int64)
    every[often] += 10 * impact.astype(np.int64)
    every[rare] += 30 * rare_impact.astype(np.int64)
    want = np.lexsort((np.arange(n), -every))[:10]
    assert found.tolist() == want.tolist() and scores.tolist() == every[want].tolist()
    assert evaluated < n / 3
