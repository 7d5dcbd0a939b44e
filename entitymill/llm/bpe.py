"""Byte-level BPE encoding and decoding of whole texts, in parallel also inside a text.

A text is cut into overlapping chunks. Each chunk is pre-tokenised alone; where the pre-token
boundaries of two neighbours coincide inside their overlap, the scan has resynchronised and the
text is cut there. The pieces between cuts are encoded apart, so that their ids concatenate to
those of the whole text. The pattern looks ahead only, so what follows a boundary does not depend
on what precedes it; a boundary at least LOOK characters before a chunk's end does not depend on
what the chunk leaves out; and one behind a character that is no white space does not depend on
what follows it, so the piece before it is pre-tokenised alone as it is in the text.

Texts of at most `big` bytes are cut, encoded and hashed in the task that reads them. A longer
text is encoded once per distinct content, its chunks and pieces dealt over the cluster.

Defined results: a null or empty text has no ids, and its hashes are those of the empty string.
Rows that repeat, also with the same doc_id or a null one, each give a row. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import text_key

CHUNK, OVERLAP, BIG, LOOK = 8192, 256, 1 << 16, 3


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _compiled(pattern: str):
    return regex.compile(pattern)


def boundaries(text: str, start: int, stop: int, pattern: str) -> list[int]:
    """Ends of the pre-tokens of text[start:stop] at which text may be cut."""
    safe = stop if stop == len(text) else stop - LOOK
    ends = [m.end() for m in _compiled(pattern).finditer(text, start, stop)]
    return [p for p in ends if p <= safe and not text[p - 1].isspace()]


def first_common(tail: list[int], head: list[int]) -> int | None:
    found = set(tail).intersection(head)
    return min(found) if found else None


def pieces(text: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Offsets 0 = c0 < c1 < ... = len(text) at which text may be cut. An overlap without a common
    boundary is doubled until there is one or the text ends."""
    n, cuts = len(text), [0]
    while n - cuts[-1] > chunk + overlap:
        nominal, wide, cut = cuts[-1] + chunk, overlap, None
        while cut is None and nominal + wide < n:
            stop = nominal + wide
            tail = [p for p in boundaries(text, cuts[-1], stop, pattern) if p > nominal]
            cut = first_common(tail, boundaries(text, nominal, stop, pattern))
            wide *= 2
        if cut is None:
            break
        cuts.append(cut)
    return [*cuts, n] if n else [0]


def encode_text(text: str, path: str, pattern: str) -> list[int]:
    enc, cuts = encoding(path, pattern), pieces(text, pattern)
    ids: list[int] = []
    for a, b in zip(cuts, cuts[1:]):
        ids += enc.encode_ordinary(text[a:b])
    return ids


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    """The raw bytes of the ids in order; a character may be spread over several."""
    return encoding(path, pattern).decode_bytes(ids)


def _digest(ids: list[int]) -> bytes:
    return " ".join(map(str, ids)).encode()


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encode_small(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for text in batch.column("text"):
                ids = encode_text(text.as_py() or "", path, pattern)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(_digest(ids)).hexdigest())
                text_hash.append(hashlib.sha256(decode_ids(ids, path, pattern)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _chunks(chunk: int, overlap: int):
    """(key, text) to one row for each overlapping chunk."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                key, text = key.as_py(), text.as_py()
                for i, a in enumerate(range(0, len(text), chunk)):
                    stop = min(len(text), a + chunk + overlap)
                    last = stop == len(text)
                    yield pa.RecordBatch.from_pylist([{"key": key, "i": i, "start": a, "last": last, "part": text[a:stop]}], schema=_CHUNK)
                    if last:
                        break

    return run


_CHUNK = pa.schema([("key", pa.binary()), ("i", pa.int32()), ("start", pa.int32()), ("last", pa.bool_()), ("part", pa.string())])


def _scan(pattern: str, chunk: int, overlap: int):
    """The boundaries of a chunk inside the overlap with its predecessor and with its successor."""

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                part = row["part"]
                safe = len(part) - (0 if row["last"] else LOOK)
                ends = [m.end() for m in _compiled(pattern).finditer(part)]
                ends = [p for p in ends if p <= safe and not part[p - 1].isspace()]
                out.append({"key": row["key"], "i": row["i"], "head": [row["start"] + p for p in ends if p <= overlap], "tail": [row["start"] + p for p in ends if p > chunk], "last": row["last"]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("key", pa.binary()), ("i", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32())), ("last", pa.bool_())]))

    return run


def _pieces(pattern: str, chunk: int, overlap: int):
    """(key, text, scans) to one row for each piece. A chain that breaks is widened here."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text, scans = row["text"], sorted(row["scans"], key=lambda s: s["i"])
                joints = [first_common(a["tail"], b["head"]) for a, b in zip(scans, scans[1:])]
                cuts = [0, *joints, len(text)] if None not in joints else pieces(text, pattern, chunk, overlap)
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    yield pa.RecordBatch.from_pylist([{"key": row["key"], "i": i, "part": text[a:b]}], schema=pa.schema([("key", pa.binary()), ("i", pa.int32()), ("part", pa.string())]))

    return run


def _encode_pieces(path: str, pattern: str):
    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("i"), pa.array([enc.encode_ordinary(t.as_py()) for t in batch.column("part")], pa.list_(pa.int32()))],
                names=["key", "i", "ids"],
            )

    return run


def _fold(path: str, pattern: str):
    """Pieces in order to a row for each key; holds one piece at a time."""

    def run(batches):
        enc, key, state = encoding(path, pattern), None, None

        def row():
            return pa.RecordBatch.from_pylist([{"key": key, "n_tokens": state[0], "ids_sha256": state[1].hexdigest(), "decoded_sha256": state[2].hexdigest()}], schema=pa.schema([("key", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

        for batch in batches:
            for k, ids in zip(batch.column("key"), batch.column("ids")):
                k, ids = k.as_py(), ids.as_py()
                if k != key:
                    if key is not None:
                        yield row()
                    key, state = k, [0, hashlib.sha256(), hashlib.sha256()]
                state[1].update((b" " if state[0] and ids else b"") + _digest(ids))
                state[2].update(enc.decode_bytes(ids))
                state[0] += len(ids)
        if key is not None:
            yield row()

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, *, chunk: int = CHUNK, overlap: int = OVERLAP, big: int = BIG) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of docs (doc_id, text)."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    large = F.coalesce(F.octet_length("text"), F.lit(0)) > big
    small = rows.where(~large).mapInArrow(_encode_small(path, pattern), f"doc_id {kind}, {RESULT}")

    keyed = rows.where(large).select("doc_id", text_key(F.col("text")).alias("key"), "text")
    texts = keyed.select("key", "text").dropDuplicates(["key"])
    scans = (
        texts.mapInArrow(_chunks(chunk, overlap), "key binary, i int, start int, last boolean, part string")
        .repartition("key", "i")
        .mapInArrow(_scan(pattern, chunk, overlap), "key binary, i int, head array<int>, tail array<int>, last boolean")
        .groupBy("key")
        .agg(F.collect_list(F.struct("i", "head", "tail")).alias("scans"))
    )
    coded = (
        texts.join(scans, "key")
        .mapInArrow(_pieces(pattern, chunk, overlap), "key binary, i int, part string")
        .repartition("key", "i")
        .mapInArrow(_encode_pieces(path, pattern), "key binary, i int, ids array<int>")
        .repartition("key")
        .sortWithinPartitions("key", "i")
        .mapInArrow(_fold(path, pattern), f"key binary, {RESULT}")
    )
    return small.unionByName(keyed.select("doc_id", "key").join(coded, "key").drop("key"))


def token_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The operator's real output: doc_id and ids array<int>."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([encode_text(t.as_py() or "", path, pattern) for t in batch.column("text")], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and bytes of rows (doc_id, ids)."""
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([decode_ids(t.as_py() or [], path, pattern) for t in batch.column("ids")], pa.binary())], names=["doc_id", "bytes"])

    return ids.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")
