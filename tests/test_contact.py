"""Contacts in free text against the patterns taken whole, label and separators included."""

import random
import re

from pyspark.sql import functions as F

from entitymill.functions import contact

WS = "[\t-\r\x1c-\x20\x85\xa0  -     　]"
WHOLE = (
    rf"(?:TEL|Tel|tel|電話|℡|☎)?(?:[:：]|{WS})*(0\d{{1,4}}(?:[\-－‐‑–—・]|{WS})\d{{2,4}}(?:[\-－‐‑–—・]|{WS})\d{{3,4}})",
    rf"(?:TEL|Tel|電話)?(?:[:：]|{WS})*(\(0\d{{1,4}}\)(?:[\-－]|{WS})?\d{{2,4}}[\-－]\d{{3,4}})",
    r"(0120[\-－]?\d{2,3}[\-－]?\d{3,4})",
)
PARTS = ["TEL", "Tel", "tel", "電話", "℡", "☎", ":", "：", " ", "　", "\n", "03-1234-5678", "(03)1234-5678", "(06) 123-4567", "0120-123-456", "0120123456", "03 12 345", "０３－1234－5678", "採用", "人事部", "x", "0", "(", "代表", "12", "-", " "]


def brute(text):
    out, seen = [], set()
    for p in WHOLE:
        for m in re.finditer(p, text):
            raw = m[1]
            n = re.sub(WS, "", raw.translate(str.maketrans("０１２３４５６７８９－‐‑–—・", "0123456789------"))).replace("(", "").replace(")", "")
            if 10 <= len(re.sub("[^0-9]", "", n)) <= 12 and n not in seen:
                seen.add(n)
                around = text[max(0, m.start() - 100) : m.start() + 100]
                out.append((raw, n, [w for w in contact.NEAR_PHONE if w in around], m.start()))
    return out


def texts():
    for i in range(400):
        r = random.Random(i)
        yield "".join(r.choice(PARTS) for _ in range(r.choice([3, 8, 30])))


def test_phones(spark):
    every = [None, "", "0", *texts()]
    df = spark.createDataFrame(list(enumerate(every)), "i int, t string").select("i", contact.phones(F.col("t")).alias("p"))
    got = {r.i: r.p and [(x.raw, x.normalized, x.context_keywords, x.char_position) for x in r.p] for r in df.collect()}
    assert got[0] is None
    assert {i: got[i] or [] for i, t in enumerate(every) if t} == {i: brute(t) for i, t in enumerate(every) if t}


def test_emails(spark):
    parts = ["a@b.com", "_x@y.org", "hr@", "@", ".", "-", "Ａ", "info", "saiyo", " ", "x.y+z%q", "@c.co.jp", "@d.e", "m-x@y.org"]
    every = [None, "", *("".join(random.Random(i).choice(parts) for _ in range(random.Random(-i).choice([2, 5, 12]))) for i in range(400)), "a" * 20000]
    every += ["".join(random.Random(i + 0.5).choices(parts, k=6)) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(every)), "i int, t string").select("i", F.transform(contact.emails(F.col("t")), lambda x: x["address"]).alias("p"))
    got = {r.i: r.p for r in df.collect()}
    assert got[0] is None
    assert {i: got[i] for i in got if i} == {i: list(dict.fromkeys(m.lower() for m in re.findall(contact.MAIL, t))) for i, t in enumerate(every) if t is not None}
