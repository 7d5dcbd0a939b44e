"""Secret scans: strong patterns, and credentials whose parts stand apart, linked by an interval join.

Strong spans (assignments to secret names, access identifiers, hexadecimal runs) are always reported.
Weak candidates (identifiers by name or too short, mixed runs of characters, endpoints) are reported
only when complementary parts co-occur in their scope: the text up to REACH characters around them,
inside the block of lines between empty lines that they stand in.

* A weak secret needs a strong identifier, or a weak one and an endpoint.
* A weak identifier needs a strong secret, or a weak one and an endpoint.
* An endpoint needs an identifier and a secret.

The spans of a kind do not overlap, so the join of scopes with a kind is one binary search for each
scope in the kind's sorted ends: no pairs are listed, and a text is read by one task from end to end.
Kinds that cannot complete anything in a text are not searched for in it.

`find_secrets` also links the parts: each identifier that is reported, or strong, with the nearest
secret and the nearest endpoint of its scope.

Defined results: a null or empty text has no spans. Rows that repeat each give a row. Other columns are
not read. An empty table gives an empty result. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The strong patterns and the shortest match of each (an assignment's value).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # of AKIA[A-Z0-9]+, those of 18 characters
HEX = re.compile(r"[0-9a-f]{16,}")  # of [0-9a-f]+, those of 16
VALUE = 12
#: Weak patterns.
IDENT = re.compile(r"""(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}|AKIA[A-Z0-9]{4,13}(?![A-Z0-9])""", re.IGNORECASE | re.ASCII)
PART = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ENDPOINT = re.compile(r"(?:https?|ftps?|sftp|ssh|amqps?|rediss?|mongodb(?:\+srv)?|postgres(?:ql)?|mysql|jdbc:[a-z]+)://[A-Za-z0-9.-]+(?::[0-9]+)?")
BREAK = re.compile(r"\n[\x20\t\r]*(?=\n)")
KINDS = ("assign", "access", "hex", "ident", "part", "endpoint")
STRONG = 3
#: Characters around a candidate that its scope reaches.
REACH = 400

Spans = list[tuple[int, int]]


def strong_spans(text: str) -> dict[str, Spans]:
    return {
        "assign": [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE],
        "access": [m.span() for m in ACCESS.finditer(text)] if "AKIA" in text else [],
        "hex": [m.span() for m in HEX.finditer(text)],
    }


def _mixed(run: str) -> bool:
    """Whether a run has capitals, small letters and digits: words, numbers and rules have not."""
    return all(re.search(p, run) for p in ("[A-Z]", "[a-z]", "[0-9]"))


def overlaps(spans: Spans, others: Spans) -> np.ndarray:
    """Whether each span overlaps one of others (sorted, apart from each other)."""
    if not others or not spans:
        return np.zeros(len(spans), bool)
    a, b = np.array(spans), np.array(others)
    first = np.searchsorted(b[:, 1], a[:, 0], side="right")
    return (first < len(b)) & (b[np.minimum(first, len(b) - 1), 0] < a[:, 1])


def scopes(text: str, spans: Spans, reach: int = REACH) -> Spans:
    """The scope of each span."""
    breaks = np.array([m.start() for m in BREAK.finditer(text)], np.int64)
    out = []
    for a, b in spans:
        i, j = np.searchsorted(breaks, a, side="right"), np.searchsorted(breaks, b)
        out.append((max(a - reach, int(breaks[i - 1]) if i else 0), min(b + reach, int(breaks[j]) if j < len(breaks) else len(text))))
    return out


def weak_spans(text: str, strong: dict[str, Spans], reach: int = REACH) -> dict[str, Spans]:
    """The weak candidates that complementary parts confirm."""
    none: dict[str, Spans] = {"ident": [], "part": [], "endpoint": []}
    endpoints = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    if not (endpoints or strong["access"] or strong["assign"]):
        return none
    base = [strong[k] for k in KINDS[:STRONG]]
    free = lambda spans: [s for s, *hits in zip(spans, *(overlaps(spans, o) for o in [*base, endpoints])) if not any(hits)]
    idents = free([m.span() for m in IDENT.finditer(text)]) if endpoints or strong["assign"] else []
    taken = overlaps(parts := free([m.span() for m in PART.finditer(text) if _mixed(m[0])]), idents) if strong["access"] or endpoints else []
    parts = [p for p, t in zip(parts, taken) if not t] if strong["access"] or endpoints else []

    def beside(spans: Spans) -> dict[str, np.ndarray]:
        around = scopes(text, spans, reach)
        return {k: overlaps(around, v) for k, v in (("access", strong["access"]), ("assign", strong["assign"]), ("ident", idents), ("part", parts), ("endpoint", endpoints))}

    near = {k: beside(v) for k, v in (("ident", idents), ("part", parts), ("endpoint", endpoints))}
    keep = {
        "part": near["part"]["access"] | (near["part"]["ident"] & near["part"]["endpoint"]),
        "ident": near["ident"]["assign"] | (near["ident"]["part"] & near["ident"]["endpoint"]),
        "endpoint": (near["endpoint"]["access"] | near["endpoint"]["ident"]) & (near["endpoint"]["assign"] | near["endpoint"]["part"]),
    }
    return {k: [s for s, ok in zip(v, keep[k]) if ok] for k, v in (("ident", idents), ("part", parts), ("endpoint", endpoints))}


def ordered(found: dict[str, Spans], kinds=KINDS) -> list[tuple[str, int, int]]:
    rows = sorted((a, i, b) for i, k in enumerate(kinds) for a, b in found[k])
    return [(kinds[i], a, b) for a, i, b in rows]


def all_spans(text: str, reach: int = REACH) -> dict[str, Spans]:
    strong = strong_spans(text)
    return strong | weak_spans(text, strong, reach)


def nearest(spans: Spans, around: Spans, others: Spans) -> list[tuple[int, int] | None]:
    """For each span, of the others (sorted, apart) that overlap its scope the one with the smallest
    gap, the first of equals: the last one that starts before the span, or the first behind."""
    behind = np.searchsorted([a for a, _ in others], [a for a, _ in spans]).tolist()
    out = []
    for (a, b), (lo, hi), at in zip(spans, around, behind):
        near = [(max(s - b, a - e, 0), (s, e)) for s, e in others[max(at - 1, 0) : at + 1] if s < hi and e > lo]
        out.append(min(near)[1] if near else None)
    return out


def link_parts(text: str, found: dict[str, Spans], reach: int = REACH) -> list[dict]:
    """Identifiers with the nearest secret of their scope, and the nearest endpoint if there is one."""
    idents, secrets = sorted(found["access"] + found["ident"]), sorted(found["assign"] + found["part"])
    around = scopes(text, idents, reach)
    rows = zip(idents, nearest(idents, around, secrets), nearest(idents, around, found["endpoint"]))
    return [{"identifier": i, "secret": s, "endpoint": e} for i, s, e in rows if s]


def _written(rows: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, base, spans = [], [], []
        for t in batch.column("text"):
            found = all_spans(t.as_py() or "")
            counts.append([len(found[k]) for k in KINDS[:STRONG]])
            base.append(hashlib.sha256(_written(ordered(found, KINDS[:STRONG])).encode()).hexdigest())
            spans.append(_written(ordered(found)))
        n = np.array(counts, np.int64).reshape(-1, STRONG)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(n[:, i]) for i in range(STRONG)), pa.array(base, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the strong spans) and spans (all, as text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digests, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


_SPAN = "struct<start: int, end: int>"
FOUND = f"spans array<struct<kind: string, start: int, end: int>>, credentials array<struct<identifier: {_SPAN}, secret: {_SPAN}, endpoint: {_SPAN}>>"


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The operator's real output: doc_id, spans (kind, start, end) and credentials, the linked parts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    shapes = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.struct([(k, span) for k in ("identifier", "secret", "endpoint")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, linked = [], []
            for t in batch.column("text"):
                text = t.as_py() or ""
                found = all_spans(text, reach)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in ordered(found)])
                linked.append([{k: v and {"start": v[0], "end": v[1]} for k, v in x.items()} for x in link_parts(text, found, reach)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, shapes[0]), pa.array(linked, shapes[1])], names=["doc_id", "spans", "credentials"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {FOUND}")
