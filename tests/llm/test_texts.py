"""Operators on texts: line dedup, BPE, token counts, quality, media. Brute force and edge cases."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from entitymill.llm import bpe, jpeg, lines, quality, tokencount

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed=0):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "naïve", "don't", "x1", "日本", "a\n\nb", "  ", "end."]) for _ in range(n))


ODD = [None, "", "a", " \n ", "x" * 3000, " " * 3000, words(4000), "<|endoftext|> tail<|endoftext|>", "é\x1c!\x1c a", "a\r\nb\x85c\xa0d", words(30000, 1), words(30000, 1)]


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], schema)


@pytest.fixture(scope="module")
def enc():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, enc):
    docs = frame(spark, ODD).union(frame(spark, ODD[:3])).withColumn("key", F.lit(1)).withColumn("n_tokens", F.lit(1))
    for how in ({}, {"chunk": 200, "overlap": 8, "big": 1000}):
        got = sorted(tuple(r) for r in bpe.encode_documents(docs, RANKS, P.PATTERN, **how).collect())
        want = []
        for i, t in [*enumerate(ODD), *enumerate(ODD[:3])]:
            ids = enc.encode_ordinary(t or "")
            want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert got == sorted(want)
    ids = bpe.token_ids(frame(spark, ODD), RANKS, P.PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_documents(ids, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(ODD)}
    assert bpe.encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_bpe_pieces(enc):
    for text in (words(3000, 2), "ab" * 4000 + " c" * 50, " " * 5000 + "a", "'re" * 2000):
        cuts = bpe.pieces(text, P.PATTERN, 300, 4)
        ids = [i for a, b in zip(cuts, cuts[1:]) for i in enc.encode_ordinary(text[a:b])]
        assert ids == enc.encode_ordinary(text)


def test_token_counts(spark):
    t = Tokenizer.from_file(JSON)
    docs = frame(spark, ODD).withColumn("n", F.lit(1))
    want = {(i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for i, x in enumerate(ODD)}
    for how in ({}, {"chunk": 300, "overlap": 4, "big": 500}):
        rows = tokencount.count_tokens(docs, JSON, **how).collect()
        assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in rows} == want and len(rows) == len(ODD)
        assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert tokencount.count_tokens(docs.limit(0), JSON).count() == 0


def small_vocabulary(folder, name, use_regex=True, added=()):
    """Bytes, a word, and a full stop that merges with the new line after it."""
    from tokenizers import AddedToken, models, pre_tokenizers

    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    every = [*letters, "ab", ".\u010a"]
    t = Tokenizer(models.BPE({x: i for i, x in enumerate(every)}, [("a", "b"), (".", "\u010a")]))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=use_regex)
    t.add_tokens([AddedToken(a, normalized=False) for a in added])
    t.enable_truncation(5)
    t.enable_padding(length=9)
    t.save(str(folder / name))
    return str(folder / name)


def test_token_counts_of_other_vocabularies(spark, tmp_path, monkeypatch):
    texts = ["ab.\nab", "ab.\n" * 900, " ab ab" * 500, "x" * 3000 + ".\n ab", None, ""]
    docs = frame(spark, texts)
    files = {name: small_vocabulary(tmp_path, name, **how) for name, how in (("regex.json", {}), ("joined.json", {"use_regex": False}), ("added.json", {"added": ["b a", "."]}))}
    assert [tokencount.bounded(f) for f in files.values()] == [True, False, False] and tokencount.bounded(JSON)

    def check(path):
        t = Tokenizer.from_file(path)
        t.no_truncation(), t.no_padding()
        want = {i: len(t.encode(x or "", add_special_tokens=False)) for i, x in enumerate(texts)}
        assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(docs, path, chunk=100, overlap=8, big=200).collect()} == want

    for path in files.values():
        check(path)
    # splices at which the neighbours disagree are not used, even where the vocabulary was taken for bounded
    monkeypatch.setattr(tokencount, "bounded", lambda path: True)
    t = Tokenizer.from_file(files["joined.json"])
    t.no_truncation(), t.no_padding()
    big = frame(spark, ["ab.\n" * 900])
    assert tokencount.count_tokens(big, files["joined.json"], chunk=100, overlap=8, big=200).first().n_tokens == len(t.encode("ab.\n" * 900))


def test_units_seen_are_bounded(monkeypatch):
    t = Tokenizer.from_file(JSON)
    monkeypatch.setattr(tokencount, "SEEN", 50)
    tokencount._seen(JSON).clear()
    for seed in range(5):
        text = words(300, seed) + " " + " ".join(str(i * seed) for i in range(100)) + " " + "long" * 100
        assert tokencount.count_text(text, JSON) == len(t.encode(text, add_special_tokens=False))
        assert max(map(len, tokencount._seen(JSON)), default=0) <= tokencount.LONG
    tokencount._seen(JSON).clear()


def strip_key(line):
    return line.strip(" \t\n\r\x0b\x0c").translate({c: c + 32 for c in range(65, 91)})


def brute_lines(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(strip_key(line)) >= 10:
                holders.setdefault(strip_key(line), set()).add(i)
    rank = lambda i: (i is None, i or 0)
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(holders.get(strip_key(x), ())) < 2 or i == min(holders[strip_key(x)], key=rank)]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    rows = [(3, "Common line here\nown line three\nCOMMON LINE HERE \nshort"), (1, "  common line here\x0b\nÉtoile commune ici"), (2, None), (4, ""), (None, "common line here\nétoile commune ici"), (5, "short\n\n\x1cabcdefghij\n"),
            (6, "own twice in one doc\nown twice in one doc"), (7, "same text line"), (7, "same text line"), (8, "Étoile commune ici\n" + "z" * 50000), (7, "other text, same text line\nsame text line")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit("clash")).withColumn("pos", F.lit(1))
    for how in ({}, {"hot": 1}, {"hot": 3}):  # no, all and some shared keys by broadcast
        got = sorted((tuple(r) for r in lines.dedup_lines(df, **how).collect()), key=str)
        assert got == brute_lines(rows)
    kept = lines.rewrite_documents(df)
    assert kept.columns == df.columns and kept.where("text is null").count() == 1 and kept.where("h1 = 'clash'").count() == len(rows)
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_quality(spark):
    r = random.Random(1)
    good = lambda: " ".join(r.choice(["sun", "rain", "wind", "hill", "road"]) for _ in range(30)) + "."
    bad = lambda: " ".join(r.choice(["SUN!!", "RAIN!!", "WIND!!"]) for _ in range(30))
    rows = [(i, good() if i % 3 else bad()) for i in range(600)]
    docs = spark.createDataFrame([*rows, (600, None), (601, ""), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("quality", F.lit(9))
    labels = spark.createDataFrame([*[(i, int(i % 3 > 0), 0) for i in range(600)], (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.score_documents(docs, labels).collect()}
    assert len(got) == 603 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())
    import zlib

    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in range(600) if got[i].held_out} == set(held)
    assert np.mean([got[i].predicted == int(i % 3 > 0) for i in held]) > 0.97
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("score = 'clash'").count() == kept.count() < 603
    one = quality.score_documents(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0].score > 0.9
    assert quality.score_documents(docs, labels.limit(0)).where("score = 0.5").count() == 603
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_quality_repeats_and_long_texts(spark):
    """Repeated rows and doc_ids, and very long texts; the order of rows does not change a score."""
    r = random.Random(3)
    text = lambda good: " ".join(r.choice(["sun", "rain", "wind"] if good else ["SUN!!", "RAIN!!"]) for _ in range(20))
    rows = [(i % 150, text(i % 2)) for i in range(300)] + [(i, text(i % 2)) for i in range(20)] * 2 + [(1000, "word " * 400_000), (1000, "word " * 400_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] * 2, "doc_id long, quality int")
    scores = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3 if order is rows else 7)
        scores.append(sorted(map(tuple, quality.score_documents(docs, labels).collect())))
    assert scores[0] == scores[1] and len(scores[0]) == len(rows)
    assert len({x for x in scores[0] if x[0] == 1000}) == 1


def test_quality_word_vectors(spark):
    """Word vectors of the cluster are those of a loop over texts."""
    rows = [(i * 7919, w) for i, w in enumerate(["a b a", "B c! c c", None, "", "a", "x " * 500])]
    df = spark.createDataFrame(rows, "h long, text string")
    got = quality.word_vectors(df)
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for h, t in rows:
        for found in quality.tokens(t):
            for b in set(found.tolist()):
                want[b] += round(float(np.log1p((found == b).sum())) * 65536) * quality.index_vector(h)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want, atol=1e-6) and (np.abs(quality.index_vector(5)).sum() == quality.NONZERO)


def test_held_out_accuracy(spark):
    """On the supplied labels: most of what is held out is told right, clean documents stay."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    scored = quality.score_documents(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    right = np.mean([x.predicted == x.quality for x in scored])
    kept = np.mean([x.predicted for x in scored if x.quality == 1])
    assert right > 0.9 and kept > 0.95, (right, kept)


def test_jpeg_round_trip(spark):
    texts = [None, "", "a", "日本語" * 100, "x" * 5000, "x" * 5000, "\x00\x01" * 40, "é" * 40000]
    df = frame(spark, texts).withColumn("feature", F.lit("clash"))
    rows = {r.doc_id: r for r in jpeg.digest_media(df, rows=3).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        full = data + bytes(-len(data) % 64 if data else 64)
        assert (rows[i].n_bytes, rows[i].payload_bytes, rows[i].payload_sha256) == (len(data), len(full), hashlib.sha256(full).hexdigest())
        import zlib

        assert rows[i].tail_crc32 == zlib.crc32(full[-64:]) and rows[i].media_bytes > 0
        # stored, read and described alone, tile by tile, by the plain functions
        stored = jpeg.write_payloads([full[a : a + jpeg.TILE] for a in range(0, len(full), jpeg.TILE)])
        marks = "+".join(jpeg.feature(t) for t in jpeg.decode(stored))
        assert (rows[i].media_bytes, rows[i].media_sha256, rows[i].feature) == (len(b"".join(stored)), hashlib.sha256(b"".join(stored)).hexdigest(), marks)
    assert rows[4][2:] == rows[5][2:] and rows[0][1:] == rows[1][1:]
    assert jpeg.digest_media(df.limit(0)).count() == 0


def test_jpeg_tiles(monkeypatch):
    monkeypatch.setattr(jpeg, "TILE", 640)
    data = bytes(range(256)) * 20
    stored = jpeg.write_payloads([data[i : i + 640] for i in range(0, len(data), 640)])
    images, coef = jpeg.read_files(stored)
    assert len(stored) == 8 and b"".join(jpeg.read_payload(i, coef) for i in images) == data


def sequential(image, coef):
    """A plain inverse transform of one image's first component."""
    c = image.components[0]
    u, x = np.mgrid[0:8, 0:8]
    d = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)
    out = np.zeros((c.rows * 8, c.stride * 8))
    for b in range(c.rows * c.stride):
        f = np.zeros(64)
        f[jpeg.ZIGZAG] = coef[c.base + b]
        y, x0 = divmod(b, c.stride)
        out[8 * y : 8 * y + 8, 8 * x0 : 8 * x0 + 8] = d.T @ f.reshape(8, 8) @ d + 128
    return np.clip(out, 0, 255)


def test_jpeg_transform():
    files = jpeg.write_payloads([bytes(range(128)) * 10])
    images, coef = jpeg.read_files(files)
    y = jpeg._samples(coef, np.ones_like(coef))
    c = images[0].components[0]
    got = y[: c.rows * c.stride].reshape(c.rows, c.stride, 8, 8).transpose(0, 2, 1, 3).reshape(c.rows * 8, -1)
    assert np.abs(got - sequential(images[0], coef)).max() <= 1.0
    assert jpeg.decode(files)[0].shape == (images[0].height, images[0].width, 3)


def _bits(codes):
    s = "".join(format(c, f"0{n}b") if n else "" for c, n in codes)
    s += "1" * (-len(s) % 8)
    return bytes(int(s[i : i + 8], 2) for i in range(0, len(s), 8)).replace(b"\xff", b"\xff\x00")


def test_jpeg_general_scans():
    """A grey 16 x 8 file by hand: runs of zeros, end-of-band runs over blocks, and a refinement that
    places a new coefficient between old ones."""
    lengths = {0x00: 2, 0x01: 3, 0x10: 3, 0x11: 3, 0x21: 3, 0xF0: 3}
    code = jpeg._codes(lengths)
    symbols = sorted(lengths, key=lambda s: lengths[s])
    dht = lambda kind: jpeg._segment(0xC4, bytes([kind, *[sum(n == i for n in lengths.values()) for i in range(1, 17)], *symbols]))
    sos = lambda ss, se, ah, al: jpeg._segment(0xDA, bytes([1, 1, 0, ss, se, ah << 4 | al]))
    frame_ = jpeg._segment(0xC2, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0]))
    dc = _bits([code[0x01], (1, 1), code[0x00]])  # +1, then no difference
    first = _bits([code[0x11], (1, 1), code[0x10], (0, 1)])  # coefficient 2 is +1 << 1, then an end-of-band run of 2 blocks
    # refinement of block 0: symbol run 1 passes coefficient 1, places -1 at 3 (crossing 2 with a correction bit 1); then a run of 2 blocks
    second = _bits([code[0x11], (0, 1), (1, 1), code[0x10], (0, 1)])
    data = b"\xff\xd8" + jpeg._segment(0xDB, b"\x00" + b"\x01" * 64) + frame_ + dht(0x00) + dht(0x10) + sos(0, 0, 0, 0) + dc + sos(1, 63, 0, 1) + first + sos(1, 63, 1, 0) + second + b"\xff\xd9"
    images, coef = jpeg.read_files([data])
    want = np.zeros((2, 64), int)
    want[:, 0], want[0, 2], want[0, 3] = 1, 3, -1
    assert (coef == want).all()
    assert jpeg.decode([data])[0].shape == (8, 16, 3)


def test_decode_media_nulls(spark):
    file = jpeg.write_payloads([b"a" * 64])[0]
    rows = spark.createDataFrame([(1, bytearray(file)), (2, None)], "doc_id long, media binary")
    got = {r.doc_id: r for r in jpeg.decode_media(rows).collect()}
    assert got[1].height == 16 and len(got[1].rgb) == 16 * 16 * 3 and got[2].rgb is None
