"""Alignment of two tokenizers against whole texts encoded by the libraries and compared token by token."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from entitymill.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        code = {chr(b): b for b in shown}
        for i, b in enumerate(x for x in range(256) if x not in shown):
            code[chr(256 + i)] = b
        self.code = code

    def tokens(self, text):
        """(ids, bytes) of both, or nothing."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        of_a = [bytes(self.code[c] for c in self.a.id_to_token(i)) for i in a]
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        want = (" " + text).encode()
        return (list(zip(a, of_a)), list(zip(b, of_b))) if b"".join(of_a) == want == b"".join(of_b) else None

    def links(self, text):
        """(links, groups): pairs that overlap, and the groups as text."""
        if not text or not (both := self.tokens(text)):
            return None
        spans = []
        for side in both:
            at, out = 0, []
            for i, raw in side:
                out.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, t, i in side if low < t <= e) for side in spans))
            low = e
        return links, groups, len(both[0]), len(both[1])

    def rows(self, docs):
        found = [(i, self.links(t)) for i, t in docs]
        counts = Counter(x for _, f in found if f for x in f[0])
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for i, f in found:
            if not f:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            links, groups, n_a, n_b = f
            out.append((i, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def brute():
    return Brute()


def text(n, seed):
    r = random.Random(seed)
    parts = ["the", "naïve", "don't", "x1", "日本", "\n", "\r\n", "\t", " ", "  ", "\x85", "\xa0", "end.", ");\r", "𝔘", "é́", "\x00", "<s>", "<|endoftext|>", "<unk>", "<0x0A>", "​", "Ġ", "ﬁ", "thenation", "12345"]
    return "".join(r.choice(parts) + r.choice(["", " ", " ", "\n"]) for _ in range(n))


ODD = [None, "", " ", "  ", "\n", " \n ", "x ", "x\t ", "a▁b", "▁", "a▁b", "x" * 700, " " * 300, "<|endoftext|> a", "﻿x", "x\r y\r\n z", "the the the", "The nation."]


def test_alignment(spark, brute):
    body = [*ODD, *(text(random.Random(i).choice([1, 3, 20, 120]), i) for i in range(120)), text(30, 1), text(30, 1)]
    docs = [(None if i % 50 == 7 else i // 2, t) for i, t in enumerate(body)]
    want = brute.rows(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("k")).withColumn("n_a", F.lit(1)).repartition(3)
    for how in ({}, {"remembered": 40, "shard_rows": 50}):
        got = alignment.align_documents(frame, A, B, **how)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    shown = {r.doc_id: ["|".join(",".join(map(str, s)) for s in (g.a, g.b)) for g in r.groups] for r in alignment.token_groups(frame.where("doc_id > 20"), A, B).collect()}
    assert all(hashlib.sha256(";".join(g).encode()).hexdigest() in {x[7] for x in want if x[0] == i} if g else True for i, g in shown.items())
    empty = frame.limit(0)
    assert alignment.align_documents(empty, A, B).count() == 0
    alone = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_documents(alone, A, B).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_units_and_windows(brute, monkeypatch):
    """Units are those of the whole text, also where it is cut into windows or not into units at all."""
    own = alignment.aligner(A, B)
    assert own.splits
    for size in (1 << 20, 5, 60):
        monkeypatch.setattr(alignment, "WINDOW", size)
        for seed in range(60):
            t = text(40, seed)
            units = [u for w in own.windows(t) for u in w]
            assert "".join(units) == " " + t
            assert own.align([u for u in units if u.isspace()] * 3).good.all()
            got = own.align(units)
            links, groups, n_a, n_b = brute.links(t)
            assert got.good.all() and ";".join(got.shown()) == ";".join(groups)
            assert [(k >> 32, k & 0xFFFFFFFF) for k in got.keys.tolist()] == sorted(links, key=links.index) or Counter((k >> 32, k & 0xFFFFFFFF) for k in got.keys.tolist()) == Counter(links)
    monkeypatch.setattr(own, "splits", False)
    t = text(40, 3)
    whole = own.align([u for w in own.windows(t) for u in w])
    assert ";".join(whole.shown()) == ";".join(brute.links(t)[1])


def test_fields():
    model = alignment.aligner(A, B).b.serialized_model_proto()
    assert alignment.keeps_text(model)
    # the default removes spaces; a character map changes texts
    assert not alignment.keeps_text(b"\x1a\x00")
    assert not alignment.keeps_text(b"\x1a\x05\x12\x01x\x20\x00")
    assert alignment.keeps_text(b"\x1a\x02\x20\x00")


class Counting:
    """An encoder that counts its calls."""

    def __init__(self, of, calls):
        self.of, self.calls = of, calls

    def __getattr__(self, name):
        if name.lower().startswith("encode"):
            self.calls.append(name)
        return getattr(self.of, name)


def linked(texts, remembered=alignment.UNITS):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts}, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    return [r for out in alignment._link(A, B, remembered)(iter([batch])) for r in out.to_pylist()]


def test_texts_are_encoded_together(monkeypatch):
    """The new units of many texts take one call of each encoder, not one for each text."""
    own, calls = alignment.aligner(A, B), []
    monkeypatch.setattr(own, "a", Counting(own.a, calls))
    monkeypatch.setattr(own, "b", Counting(own.b, calls))
    alignment._known(A, B)[0] = alignment.Units(own)
    texts = [f"new{i} other{i} the nation{i}" for i in range(300)]
    assert len(linked(texts)) == 300
    assert len(calls) <= 4


def test_gathered_texts(brute, monkeypatch):
    """Texts that are gathered give what each gives alone, also beside texts without tokens, cut into
    windows or with few rows at a time; tables of units that are full are begun again."""
    own = alignment.aligner(A, B)
    texts = [*ODD, *(text(n % 30 + 1, n) for n in range(150)), *(f"{text(9, n)} a▁b {text(9, n + 1)}" for n in range(3)), *(text(12, n) for n in range(40))]
    want = [brute.links(t) for t in texts]
    for window, gathered, room, together, remembered in ((1 << 20, 1 << 18, own.room, 1000, 10**6), (50, 300, own.room, 7, 10**6), (1 << 20, 1 << 18, 3, 1, 60), (20, 1, 1, 1000, 5)):
        for name, value in (("WINDOW", window), ("GATHERED", gathered), ("TOGETHER", together)):
            monkeypatch.setattr(alignment, name, value)
        monkeypatch.setattr(own, "room", room)
        for splits in (True, False):
            monkeypatch.setattr(own, "splits", splits)
            alignment._known(A, B)[0] = alignment.Units(own)
            for row, found in zip(linked(texts, remembered), want, strict=True):
                links, groups, n_a, n_b = found or ([], [], 0, 0)
                assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (n_a, n_b, len(groups), len(links))
                assert row["groups_sha256"] == (hashlib.sha256(";".join(groups).encode()).hexdigest() if found else "")
                assert dict(zip([(k >> 32, k & 0xFFFFFFFF) for k in row["keys"]], row["times"], strict=True)) == Counter(links)
    alignment._known(A, B)[0] = alignment.Units(own)
