"""Secret scans against plain loops over all matches and all pairs of candidates."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from entitymill.llm import secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def strong(text):
    """The patterns as they are given, short matches dropped after the search."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)  # the names in either case
    assign = []
    at = 0
    while m := re.compile(ASSIGN).search(low, at):
        # the value's class holds both cases, so the lower text matches at the same places
        if m.end(2) - m.start(2) >= 12:
            assign.append(m.span())
        at = m.end()
    plain = lambda p, n: [m.span() for m in re.finditer(p, text) if len(m[0]) >= n]
    return {"assign": assign, "access": plain(r"AKIA[A-Z0-9]+", 18), "hex": plain(r"[0-9a-f]+", 16)}


def brute(text, reach):
    base = strong(text)
    cross = lambda x, y: x[0] < y[1] and y[0] < x[1]
    ends = [m.span() for m in secrets.ENDPOINT.finditer(text)]
    fixed = sum(base.values(), []) + ends
    idents = [s for s in (m.span() for m in secrets.IDENT.finditer(text)) if not any(cross(s, f) for f in fixed)]
    parts = [m.span() for m in secrets.PART.finditer(text) if re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0]) and re.search("[0-9]", m[0])]
    parts = [s for s in parts if not any(cross(s, f) for f in fixed + idents)]
    breaks = [m.start() for m in re.finditer(r"\n(?=[ \t\r]*\n)", text)]

    def near(s, others):
        lo = max([s[0] - reach, 0, *(b for b in breaks if b <= s[0])])
        hi = min([s[1] + reach, len(text), *(b for b in breaks if b >= s[1])])
        return any(cross((lo, hi), o) for o in others)

    weak = {
        "ident": [s for s in idents if near(s, base["assign"]) or near(s, parts) and near(s, ends)],
        "part": [s for s in parts if near(s, base["access"]) or near(s, idents) and near(s, ends)],
        "endpoint": [s for s in ends if (near(s, base["access"]) or near(s, idents)) and (near(s, base["assign"]) or near(s, parts))],
    }
    return base, weak


def show(found, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, kinds.index(k), k, b) for k in kinds for a, b in found[k]))


PIECES = [
    "password = abcdefghijkl", "Token: short", "token: password: abcdefghijklmnop", "API_KEY='A1b2C3d4E5f6'", "apikey=" + "x" * 40, "ſecret=abcdefghijklmn", "toKen=abcdefghijklmno",
    "AKIA1234567890ABCD", "AKIAAKIAAKIAAKIAA", "AKIA12345678", "deadbeef" * 2, "DEADBEEF" * 2, "a1" * 40, "https://api.example.com:8443/v1", "jdbc:mysql://db.internal:3306", "user=bob.smith", "client_id: 'svc-17'",
    "wJalrXUtnFEMI7MDENGbPxRfiCY", "A1b2C3d4E5f6G7h8I9j0K1", "plainwordsthatarelongenough", "\n", "\n\n", "\n \t\n", " ", " and then some words ", "日本語 ", "é" * 30, ".", "secret" + '"' + " : " + '"' + "Zm9vYmFyYmF6cXV4",
]
ODD = [None, "", " ", "password=" * 3000, "f" * 100000, "AKIA" * 6, "\n" * 500, "x " * 20000 + "token=abcdefghijkl", "password:abcdefghijkl" * 200]


def texts(n):
    for i in range(n):
        r = random.Random(i)
        yield "".join(r.choice(PIECES) + r.choice(["", " ", " ", "\n", "\n\n"]) for _ in range(r.choice([1, 2, 4, 9, 40])))


def test_scan(spark):
    docs = [(None if i % 30 == 3 else i // 2, t) for i, t in enumerate([*ODD, *texts(250), *texts(5)])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("n_hex", F.lit("x")).repartition(3)
    want = []
    for i, t in docs:
        base, weak = brute(t or "", secrets.REACH)
        want.append((i, *(len(base[k]) for k in secrets.KINDS[:3]), hashlib.sha256(show(base, secrets.KINDS[:3]).encode()).hexdigest(), show(base | weak, secrets.KINDS)))
    got = secrets.scan_documents(frame)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {w[1:4] == (0, 0, 0) for w in want} == {True, False} and any("part" in w[5] for w in want) and any("endpoint" in w[5] for w in want)
    assert secrets.scan_documents(frame.limit(0)).count() == 0


def test_scope_length():
    for reach in (0, 5, 60):
        for t in texts(120):
            base, weak = brute(t, reach)
            assert secrets.all_spans(t, reach) == base | weak


def test_parts_need_their_complement():
    weak = "wJalrXUtnFEMI7MDENGbPxRfiCY"
    assert "part" not in show(secrets.all_spans(f"id {weak} alone"), secrets.KINDS)
    assert secrets.all_spans(f"AKIA1234567890ABCD and {weak}")["part"]
    assert not secrets.all_spans(f"AKIA1234567890ABCD\n\n{weak}")["part"]
    assert not secrets.all_spans("AKIA1234567890ABCD " + "x " * 300 + weak)["part"]
    found = secrets.all_spans(f"user=bob at https://db.example.com with {weak}")
    assert all(len(found[k]) == 1 for k in ("ident", "part", "endpoint"))
    assert not any(secrets.all_spans(f"user=bob with {weak}")[k] for k in ("ident", "part"))
    assert not secrets.all_spans("see https://example.com")["endpoint"]


def test_links(spark):
    weak = "wJalrXUtnFEMI7MDENGbPxRfiCY"
    text = f"AKIA1234567890ABCD {weak} https://s3.example.com\n\nuser=bob password=abcdefghijklm\n\nAKIA0000000000ABCD"
    row = secrets.find_secrets(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    cut = lambda s: s and text[s.start : s.end]
    assert [tuple(map(cut, c)) for c in row[0].credentials] == [("AKIA1234567890ABCD", weak, "https://s3.example.com"), ("user=bob", "password=abcdefghijklm", None)]
    assert [s.kind for s in row[0].spans] == ["access", "part", "endpoint", "ident", "assign", "access"]
    assert row[1].spans == [] and row[1].credentials == []
