"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Both tokenizers' tokens are laid over the bytes of space + text. Offsets where both end cut the text
into groups; an A and a B token whose byte ranges overlap are linked. A link's key packs both ids in
64 bits (A's above B's).

Counts. Texts are encoded once; a row with its distinct keys and how often each occurs is written for
each. A task sums the keys of its rows by `np.unique`. These partial counts are sorted over the whole
corpus by a range partitioning; a task sums the runs of equal keys of its range and writes them as one
sorted shard of keys and counts to the shared folder. The shards are memory-mapped by the tasks that
read the rows again and look up their keys by `searchsorted`. The highest count of each B id (no more
than the vocabulary has) is sent along.

Shared folder. Shards are written and read through the file system that the folder's URI names; one
that is a path of the machines (file:) is mapped, from any other the shards that a task needs are read.

Units. If the vocabularies prove that none of their tokens goes on from a character that is no white
space to a space or line feed behind it (`splits`), each such place ends a token of both, and so a
group. What stands between, a unit, is encoded once for many occurrences; the new units of many texts
are encoded side by side, as one text. Otherwise the whole text is one unit, encoded alone.

Defined results: a text that is null or empty, or whose joined token bytes differ from space + text
for A or B (a text with U+2581, for one), has no tokens: zeros and an empty hash, and its links count
nowhere. Rows that repeat, also with one doc_id or a null one, each count and each give a row. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import io
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import materialize, scratch_path
from entitymill.llm.tokencount import SPACE, bounded

#: Units that a task remembers, rows of a shard (about), characters that are cut into units at a time.
UNITS, SHARD_ROWS, WINDOW = 500_000, 4_000_000, 1 << 20
#: Characters of texts that are linked at a time (about), units that are encoded side by side.
GATHERED, TOGETHER = 1 << 16, 1000
#: Link keys that a task remembers for each unit that it may remember.
LINKS = 16
#: Keys that a task sums at a time.
SUMMED = 8_000_000
BLANK = "▁"
#: White space behind which a unit goes on.
OTHER = SPACE.replace(" ", "").replace("\n", "")
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+(?:[{OTHER}][{SPACE}]*[^{SPACE}]+)*(?:[{OTHER}][{SPACE}]*\\Z)?|[{SPACE}]+")
BLANKS = {chr(i) for i in range(0x3001) if re.match(f"[{SPACE}]", chr(i))}
CUT = re.compile(f"(?<=[^{SPACE}])(?=[ \n])")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at, out, shift = at + 1, out | (byte & 127) << shift, shift + 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, data[at : at + size]
            at += size


def keeps_text(model: bytes) -> bool:
    """Whether a sentencepiece model leaves texts as they are but for a space before them."""
    spec = dict(_fields(dict(_fields(model)).get(3, b"")))
    # fixed values: 2 the character map, 3 a space before the text, 4 spaces removed (unless set to 0), 5 spaces escaped
    return not spec.get(2) and spec.get(3, 1) == 1 and spec.get(4, 1) == 0 and spec.get(5, 1) == 1


def _byte_table() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for
    themselves, the others in order from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Two vocabularies: the tokenizers library's file A, the sentencepiece model B."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        table, vocabulary = _byte_table(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(table.__getitem__, token)) if all(c in table for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.ids = max(len(self.bytes_a), len(pieces))
        #: Bits of a link's key, and how many numbers fit above it.
        self.bits = 32 + self.ids.bit_length()
        self.room = 1 << (63 - self.bits)
        self.shown = [f"{i}{c}" for c in ",|;" for i in range(self.ids)]
        self.shown_length = np.array([len(x) for x in self.shown], np.int64)
        self.blank = self.b.piece_to_id(BLANK)
        words = [p for i, p in enumerate(pieces) if len(p) > 1 and not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        apart = not any(re.search(f"[^{BLANK}]{BLANK}|[ \n]", p) for p in words) and pieces[self.blank] == BLANK
        #: Whether both end a token wherever a space or line feed follows a character that is no white space.
        self.splits = bounded(a) and keeps_text(self.b.serialized_model_proto()) and apart

    def has_bytes(self, a: np.ndarray, b: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw == b"".join(map(self.bytes_b.__getitem__, b.tolist()))

    def encode_joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order. Those that end in white space, at the end of texts, are encoded
        alone: the next unit's place would not end a token."""
        parts, at = [], 0
        alone = [i for i, u in enumerate(units) if u[-1] in BLANKS] if self.splits else range(len(units))
        for i in (*alone, len(units)):
            parts += ["".join(units[k : min(k + TOGETHER, i)]) for k in range(at, i, TOGETHER)]
            parts += units[i : i + 1]
            at = i + 1
        a = chain.from_iterable(self.a.encode_batch_fast([p], add_special_tokens=False)[0].ids for p in parts)
        return np.fromiter(a, np.int64), np.concatenate([np.empty(0, np.int64), *map(self.encode_b, parts)])

    def encode_b(self, part: str) -> np.ndarray:
        """B adds a space itself: a part's own first one is left out, the added one taken back. One text
        a call, since a list of them starts a pool of threads."""
        if part == " ":
            return np.array([self.blank], np.int64)
        out = self.b.encode_as_numpy(part[1:] if part[0] == " " else part)
        return (out[1:] if part[0] != " " and len(out) and out[0] == self.blank else out).astype(np.int64)

    def windows(self, text: str) -> Iterator[list[str]]:
        """The units of space + text, in order, a bounded number of characters at a time."""
        text = " " + text
        if not self.splits:
            yield [text]
            return
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > WINDOW and (found := CUT.search(text, at + WINDOW)):
                end = found.start()
            yield UNIT.findall(text[at:end])
            at = end

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte offsets at which the tokens of both end."""
        return np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])

    def align(self, units: list[str]) -> "Aligned":
        return Aligned(self, units)


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


class Aligned:
    """Alignment of units, side by side: each ends a token of A and of B, so all lie on one axis.

    good: whether a unit's tokens have its bytes. The other members hold for the good units only:
    n_a, n_b, n_groups, and the keys of the links of unit i, keys[links[i]:links[i + 1]]."""

    def __init__(self, own: Aligner, units: list[str]) -> None:
        raw = [u.encode() for u in units]
        self.own, (self.a, self.b, self.good) = own, _tokens(own, units, raw)
        last = _ends([len(r) for r, ok in zip(raw, self.good.tolist()) if ok])
        self.ends_a, self.ends_b = own.ends(self.a, self.b)
        every = np.union1d(self.ends_a, self.ends_b)
        self.keys = self.a[np.searchsorted(self.ends_a, every)] << 32 | self.b[np.searchsorted(self.ends_b, every)]
        self.common = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        upto = lambda x: np.concatenate([[0], np.searchsorted(x, last, side="right")])
        self.links, self.groups, self.of_a, self.of_b = (upto(x) for x in (every, self.common, self.ends_a, self.ends_b))
        self.n_a, self.n_b, self.n_groups = (np.diff(x) for x in (self.of_a, self.of_b, self.groups))

    def shown(self) -> list[str]:
        """The groups of each good unit as text."""
        own, n = self.own, self.own.ids
        group_a, group_b = np.searchsorted(self.common, self.ends_a), np.searchsorted(self.common, self.ends_b)
        # what follows a token: a comma inside its group, | behind A's last one, ; behind B's
        code = np.concatenate([self.a + n * (self.ends_a == self.common[group_a]), self.b + 2 * n * (self.ends_b == self.common[group_b])])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        text = "".join(map(own.shown.__getitem__, code[order].tolist()))
        ends = np.concatenate([[0], np.cumsum(own.shown_length[code[order]])])[self.of_a + self.of_b].tolist()
        return [text[i : j - 1] for i, j in zip(ends, ends[1:])]


def _ends(lengths: list[int]) -> np.ndarray:
    return np.cumsum(np.array(lengths, np.int64))


def _tokens(own: Aligner, units: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both for the units whose tokens have their bytes, and which units those are. Where the
    joined tokens differ from the units, fewer are joined, at last one."""
    a, b = own.encode_joined(units)
    last = _ends([len(r) for r in raw])
    if all(len(x) and x[-1] == last[-1] and np.array_equal(x[np.searchsorted(x, last)], last) for x in own.ends(a, b)) and own.has_bytes(a, b, b"".join(raw)):
        return a, b, np.ones(len(units), bool)
    if len(units) < 2:
        return a[:0], b[:0], np.zeros(len(units), bool)
    step = max(1, len(units) // 16)
    each = [_tokens(own, units[i : i + step], raw[i : i + step]) for i in range(0, len(units), step)]
    return tuple(map(np.concatenate, zip(*each)))


class Numbers(dict):
    """Numbers of units, in the order in which they are asked for first; fresh: those asked for first."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.fresh.append(unit)
        return number


class Units:
    """Units met so far, numbered: columns n_a, n_b, n_groups, n_links, their groups and link keys (of
    units that are not good: none)."""

    def __init__(self, own: Aligner) -> None:
        self.own, self.number = own, Numbers()
        self.shown: list[str] = []
        self.good, self.columns = np.zeros(1024, bool), np.zeros((1024, 4), np.int64)
        self.first, self.keys = np.zeros(1025, np.int64), np.zeros(4096, np.int64)

    @property
    def links(self) -> int:
        return int(self.first[len(self.shown)])

    def numbers(self, units: Iterator[str], n: int) -> np.ndarray:
        """Numbers of n units; those not met before are aligned."""
        at = np.fromiter(map(self.number.__getitem__, units), np.int64, n)
        if self.number.fresh:
            self._add(self.number.fresh)
            self.number.fresh = []
        return at

    def _add(self, units: list[str]) -> None:
        got, n, links = self.own.align(units), len(self.shown), self.links
        end, good = n + len(units), np.flatnonzero(got.good)
        if end > len(self.columns):
            self.good, self.columns, self.first = (np.concatenate([x, np.zeros((max(end, len(x)), *x.shape[1:]), x.dtype)]) for x in (self.good, self.columns, self.first))
        if links + len(got.keys) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros(max(len(got.keys), len(self.keys)), np.int64)])
        size = np.zeros(len(units), np.int64)
        size[good] = np.diff(got.links)
        self.good[n:end] = got.good
        self.columns[n + good] = np.stack([got.n_a, got.n_b, got.n_groups, np.diff(got.links)], 1)
        self.first[n + 1 : end + 1] = links + np.cumsum(size)
        self.keys[links : links + len(got.keys)] = got.keys
        shown = iter(got.shown())
        self.shown.extend(next(shown) if ok else "" for ok in got.good.tolist())

    def linked(self, at: np.ndarray, part: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each part (keys, how often each occurs) of the links of its units; part: that of each unit."""
        size = self.first[at + 1] - self.first[at]
        place = np.arange(int(size.sum())) + np.repeat(self.first[at] - np.cumsum(size) + size, size)
        # a link's part stands above its key
        keys = np.sort(self.keys[place] | np.repeat(part << self.own.bits, size))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        times, keys = np.diff(first, append=len(keys)), keys[first]
        cuts = np.searchsorted(keys >> self.own.bits, np.arange(parts + 1)).tolist()
        keys &= (1 << self.own.bits) - 1
        return [(keys[i:j], times[i:j]) for i, j in zip(cuts, cuts[1:])]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    every, where = np.unique(keys, return_inverse=True)
    return every, np.bincount(where, n, len(every)).astype(np.int64)


@functools.lru_cache(maxsize=2)
def _known(a: str, b: str) -> list[Units]:
    """The units that the tasks of a process have met."""
    return [Units(aligner(a, b))]


_LINKS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>"


class Rows:
    """The numbers, groups and link keys of the rows of a batch, from their units in order."""

    def __init__(self, n: int) -> None:
        self.good, self.numbers = np.ones(n, bool), np.zeros((n, 4), np.int64)
        self.digests: list = [None] * n
        self.found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]

    def add(self, parts: list[tuple[int, list[str]]], met: Units) -> None:
        """parts: a row and units of it, each row in one of them."""
        rows, size = np.array([r for r, _ in parts]), np.array([len(u) for _, u in parts])
        at = met.numbers(chain.from_iterable(u for _, u in parts), int(size.sum()))
        ends = np.cumsum(size)
        self.good[rows] &= np.logical_and.reduceat(met.good[at], ends - size)
        self.numbers[rows] += np.add.reduceat(met.columns[at], ends - size)
        shown = list(map(met.shown.__getitem__, at.tolist()))
        linked = met.linked(at, np.repeat(np.arange(len(parts)), size), len(parts))
        for row, end, n, found in zip(rows.tolist(), ends.tolist(), size.tolist(), linked):
            text = ";".join(shown[end - n : end]).encode()
            if self.digests[row]:
                self.digests[row].update(b";" + text)
            else:
                self.digests[row] = hashlib.sha256(text)
            self.found[row].append(found)

    def columns(self) -> list[pa.Array]:
        none = (np.empty(0, np.int64),) * 2
        self.good &= np.array([d is not None for d in self.digests], bool)
        good = self.good.tolist()
        self.numbers[~self.good] = 0
        hashes = [d.hexdigest() if ok else "" for d, ok in zip(self.digests, good)]
        both = [none if not ok else f[0] if len(f) == 1 else _summed(*map(np.concatenate, zip(*f))) for f, ok in zip(self.found, good)]
        lists = (pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, v)]), pa.int32()), np.concatenate([none[0], *v])) for v in ([k for k, _ in both], [n for _, n in both]))
        return [*(pa.array(self.numbers[:, i]) for i in range(4)), pa.array(hashes, pa.string()), *lists]


def _link(a: str, b: str, remembered: int):
    """(doc_id, text) to the text's numbers, groups and link keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = aligner(a, b), _known(a, b)
        for batch in batches:
            rows, parts, size = Rows(batch.num_rows), [], 0

            def add() -> None:
                if len(known[0].number) > remembered or known[0].links > LINKS * remembered:
                    known[0] = Units(own)
                rows.add(parts, known[0])

            for row, t in enumerate(batch.column("text")):
                for units in own.windows(text) if (text := t.as_py()) else ():
                    parts.append((row, units))
                    size += min(len(text), WINDOW)
                    # a row's next window comes after this one was added
                    if size > GATHERED or len(text) >= WINDOW or len(parts) == own.room:
                        add()
                        parts, size = [], 0
                        if not rows.good[row]:
                            break
            if parts:
                add()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rows.columns()], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"])

    return run


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (keys, times) to (key, n): the sums of a task."""
    held, size = [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _summed(*map(np.concatenate, zip(*held)))

    for batch in batches:
        keys, n = (batch.column(c).flatten().to_numpy() for c in ("keys", "times"))
        held.append(_summed(keys, n))
        size += len(held[-1][0])
        if size > SUMMED:
            held = [merged()]
            size = len(held[0][0])
            if size > SUMMED // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["key", "n"])
                held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["key", "n"])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _write_shard(folder: str):
    """Sorted (key, n) to one shard for a task: path, first key, and the highest count of each B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            k = np.concatenate([held[0], batch.column("key").to_numpy()])
            n = np.concatenate([held[1], batch.column("n").to_numpy()])
            if not len(k):
                continue
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            k, n = k[first], np.add.reduceat(n, first)
            # the last run may go on in the next batch
            keys.append(k[:-1])
            counts.append(n[:-1])
            held = k[-1:], n[-1:]
        if not len(held[0]):
            return
        k, n = np.concatenate([*keys, held[0]]), np.concatenate([*counts, held[1]])
        # a run of this task again makes files of its own; the table of shards names those that count
        path = f"{folder}/{uuid.uuid4().hex}"
        where, to = _open(folder)
        where.create_dir(to, recursive=True)
        for name, values in (("keys", k), ("counts", n)):
            out = io.BytesIO()
            np.save(out, values)
            with where.open_output_stream(f"{to}/{path.rsplit('/', 1)[1]}.{name}.npy") as f:
                f.write(out.getbuffer())
        ids, low = np.unique(k & 0xFFFFFFFF, return_inverse=True)
        most = np.zeros(len(ids), np.int64)
        np.maximum.at(most, low, n)
        yield pa.RecordBatch.from_pydict({"path": [path], "first": [int(k[0])], "ids": [ids], "most": [most]}, schema=pa.schema([("path", pa.string()), ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))]))

    return run


def count_shards(partial: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """path, first (key), ids and most (highest count of each B id) of the shards of partial (key, n)."""
    spark = partial.sparkSession
    parts = max(1, -(-partial.count() // shard_rows))
    ordered = partial.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return materialize(ordered.mapInArrow(_write_shard(scratch_path(spark, "counts")), "path string, first long, ids array<long>, most array<long>"), "shards")


@functools.lru_cache(maxsize=64)
def _mapped(path: str) -> tuple[np.ndarray, np.ndarray]:
    where, at = _open(path)
    if isinstance(where, fs.LocalFileSystem):
        return tuple(np.load(f"{at}.{x}.npy", mmap_mode="r") for x in ("keys", "counts"))
    return tuple(np.load(io.BytesIO(where.open_input_file(f"{at}.{x}.npy").read())) for x in ("keys", "counts"))


def look_up(keys: np.ndarray, shards: list[tuple[int, str]]) -> np.ndarray:
    """Counts of keys (all known), by shards (first key, path) in order."""
    every, back = np.unique(keys, return_inverse=True)
    out = np.zeros(len(every), np.int64)
    home = np.searchsorted(np.array([first for first, _ in shards], np.int64), every, side="right") - 1
    for i in np.unique(home):
        mine = home == i
        k, n = _mapped(shards[i][1])
        out[mine] = n[np.searchsorted(k, every[mine])]
    return out[back]


def _best(sent):
    """Rows of _link to the links that are their B id's most frequent, and the sum of all counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, best = sent.value
        for batch in batches:
            keys, times = (batch.column(c).flatten().to_numpy() for c in ("keys", "times"))
            row = np.repeat(np.arange(batch.num_rows), batch.column("keys").value_lengths().to_numpy())
            counts = look_up(keys, shards) if len(keys) else keys
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, row, times * (counts == best[keys & 0xFFFFFFFF]))
            np.add.at(total, row, times * counts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _OWN), pa.array(n_best), pa.array(total), batch.column("groups_sha256")], names=[*_OWN, "n_best", "count_sum", "groups_sha256"])

    return run


_OWN = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, a: str, b: str, *, remembered: int = UNITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of docs."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = materialize(docs.select("doc_id", "text").mapInArrow(_link(a, b, remembered), f"doc_id {kind}, {_LINKS}"), "links")
    partial = materialize(rows.select("keys", "times").mapInArrow(_partial_counts, "key long, n long"), "pairs")
    shards = count_shards(partial, shard_rows)
    # as many rows as shards, and as B has tokens
    places = sorted((r["first"], r["path"]) for r in shards.select("first", "path").collect())
    best = np.full(aligner(a, b).b.get_piece_size(), -1, np.int64)
    high = shards.select(F.explode(F.arrays_zip("ids", "most")).alias("x")).groupBy("x.ids").agg(F.max("x.most").alias("most"))
    for r in high.collect():
        best[r["ids"]] = r["most"]
    sent = spark.sparkContext.broadcast((places, best))
    return rows.mapInArrow(_best(sent), f"doc_id {kind}, {RESULT}")


def token_groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """The operator's real output: doc_id and groups, an array of (a, b), the ids of each group in
    order; empty for texts without tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a, b)
        shape = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            out = []
            for t in batch.column("text"):
                groups: list[dict] | None = []
                for units in own.windows(t.as_py()) if t.as_py() else ():
                    got = own.align(units)
                    if not got.good.all():
                        groups = []
                        break
                    groups += [dict(zip("ab", ([int(i) for i in side.split(",")] for side in g.split("|")))) for u in got.shown() for g in u.split(";")]
                out.append(groups)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, shape)], names=["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>")
