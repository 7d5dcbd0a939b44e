"""Token counts of whole texts by a vocabulary file of the tokenizers library.

A byte-level pre-tokeniser never joins a character that is not white space to white space after it.
If the file says that its vocabulary is read by that pre-tokeniser, without a normaliser, and that no
added token holds or strips white space (`bounded`), then each such position is a proven stable
boundary: what stands on either side is tokenised as if the other side were not there. A file that
does not say so is counted the plain way, a whole text at a time in the task that reads it.

A huge text is cut into overlapping chunks that reach over the splices at both of their ends, and the
chunks are dealt over the cluster and encoded with offsets. A splice is a stable boundary; both
neighbours must have a token's edge there and the same edges behind it. Texts with a splice at which
they don't are cut again with wider overlaps, at last whole, until all neighbours agree. An overlap
without a stable boundary is doubled until it has one, or the text ends. Smaller texts are encoded
where they are read: as the stable units between their boundaries, whose counts a table of bounded
size remembers, since they repeat.

Defined results: a null or empty text has 0 bytes and 0 tokens. Rows that repeat each give a row.
Truncation and padding that the file asks for are not applied. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import materialize, text_key

CHUNK, OVERLAP, BIG, LIMIT = 16384, 256, 1 << 16, 1024
#: Units remembered at most, and characters of one.
SEEN, LONG = 400_000, 64

#: The characters with the Unicode property White_Space.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
STABLE = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def bounded(path: str) -> bool:
    """Whether the vocabulary's rules prove that its tokens end before white space that follows
    another character."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    before = rules.get("pre_tokenizer") or {}
    if rules.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
        return False
    if rules["model"].get("type", "BPE") != "BPE" or rules["model"].get("dropout"):
        return False
    added = rules.get("added_tokens") or []
    return not any(re.search(f"[{SPACE}]", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)


@functools.lru_cache(maxsize=4)
def _seen(path: str) -> dict[str, int]:
    return {}


def count_text(text: str, path: str) -> int:
    """Tokens of text, as the sum over its stable units."""
    seen, units = _seen(path), UNIT.findall(text)
    fresh = [u for u in set(units) if u not in seen]
    if len(seen) + len(fresh) > SEEN:
        seen.clear()
        fresh = list(set(units))
    found = dict(zip(fresh, map(len, tokenizer(path).encode_batch_fast(fresh, add_special_tokens=False)))) if fresh else {}
    total = sum(found[u] if u in found else seen[u] for u in units)
    seen.update((u, n) for u, n in found.items() if len(u) <= LONG)
    return total


def splices(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """Chunks as (start, stop, first, end): encode text[start:stop], count the tokens between the
    splices first and end."""
    n, cuts = len(text), [0]
    while n - cuts[-1] > chunk + overlap:
        nominal, wide, cut = cuts[-1] + chunk, overlap, None
        while cut is None and nominal + wide < n:
            found = STABLE.search(text, nominal, nominal + wide)
            cut = found.start() if found else None
            wide *= 2
        if cut is None:
            break
        cuts.append(cut)
    return [(max(0, a - overlap), min(n, b + overlap), a, b) for a, b in zip(cuts, [*cuts[1:], n])] if n else []


def count_between(part: str, first: int, end: int, reach: int, path: str) -> tuple[int, list[int], list[int]]:
    """Tokens of part between the offsets first and end, and what the neighbours must have too at
    each: 0 if a token's edge is there, -1 if a token crosses it, then the edges up to `reach` behind."""
    offsets = tokenizer(path).encode(part, add_special_tokens=False).offsets
    ends = sorted({b for _, b in offsets})

    def edges(p: int) -> list[int]:
        return [-1 if any(a < p < b for a, b in offsets) else 0, *(e - p for e in ends if p < e <= p + reach)]

    return sum(first <= a and b <= end for a, b in offsets), edges(first), edges(end)


def _small(path: str, count):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [count(t.as_py() or "", path) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def _whole(text: str, path: str) -> int:
    return len(tokenizer(path).encode(text, add_special_tokens=False))


_PART = pa.schema([("key", pa.binary()), ("i", pa.int32()), ("last", pa.bool_()), ("first", pa.int32()), ("end", pa.int32()), ("part", pa.string())])
_COUNT = pa.schema([("key", pa.binary()), ("i", pa.int32()), ("last", pa.bool_()), ("n", pa.int64()), ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32()))])


def _cut(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                key, text = key.as_py(), text.as_py()
                found = splices(text, chunk, overlap)
                for i, (start, stop, first, end) in enumerate(found):
                    yield pa.RecordBatch.from_pylist([{"key": key, "i": i, "last": i == len(found) - 1, "first": first - start, "end": end - start, "part": text[start:stop]}], schema=_PART)

    return run


def _parts(path: str, reach: int):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["n"], r["left"], r["right"] = count_between(r.pop("part"), r.pop("first"), r.pop("end"), reach, path)
            yield pa.RecordBatch.from_pylist(rows, schema=_COUNT)

    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of texts (key, text), all keys unlike."""
    total = None
    while True:
        cut = texts.mapInArrow(_cut(chunk, overlap), "key binary, i int, last boolean, first int, end int, part string").repartition("key", "i")
        parts = materialize(cut.mapInArrow(_parts(path, overlap // 2), "key binary, i int, last boolean, n long, left array<int>, right array<int>"), "parts")
        joints = parts.where(~F.col("last")).select("key", "i", F.col("right").alias("e")).unionByName(parts.where("i > 0").select("key", (F.col("i") - 1).alias("i"), F.col("left").alias("e")))
        apart = joints.groupBy("key", "i").agg(F.min("e").alias("a"), F.max("e").alias("b")).where((F.col("a") != F.col("b")) | (F.get("a", F.lit(0)) < 0))
        apart = materialize(apart.select("key").distinct(), "apart")
        fits = parts.join(apart, "key", "left_anti").groupBy("key").agg(F.sum("n").alias("n_tokens"))
        total = fits if total is None else total.unionByName(fits)
        if apart.isEmpty():
            return total
        # a whole text has no splice, so this ends
        texts, overlap = texts.join(apart, "key", "left_semi"), overlap * 4
        chunk = max(chunk, overlap)


def count_tokens(docs: DataFrame, path: str, *, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, big: int = BIG) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row of docs."""
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    if not bounded(path):
        return rows.mapInArrow(_small(path, _whole), kind).withColumn("over_limit", F.col("n_tokens") > limit)
    small = rows.where(F.col("n_bytes") <= big).mapInArrow(_small(path, count_text), kind)
    keyed = rows.where(F.col("n_bytes") > big).withColumn("key", text_key(F.col("text")))
    counts = _spliced(keyed.select("key", "text").dropDuplicates(["key"]), path, chunk, overlap)
    large = keyed.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(large).withColumn("over_limit", F.col("n_tokens") > limit)
