"""Secret scans: three base patterns, and weak parts of a credential that count only together.

Weak parts are access identifiers, bare secrets and service endpoints. Each has an interval of
code points. Parts of one scope (text between blank lines) are joined when their intervals are
at most REACH apart, and are reported only where an identifier or an endpoint meets a secret.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
#: Cheap tests: a text without any of these has no match of ASSIGN, or no weak part.
_ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Names may have a prefix (AWS_, DB_), but a secret access key is no identifier. What ACCESS takes is left out in scan().
IDENT = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?<!secret[_-])access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})"""
    r"""|(?<![A-Za-z0-9])(A[KSG][IC]A[A-Z0-9]{8,})""",
    re.ASCII | re.IGNORECASE,
)
_IDENT_HINTS = (b"access", b"client", b"account", b"user", b"login", b"akia", b"asia", b"agia", b"akca", b"asca", b"agca")
#: A whole run of its alphabet, of any length; it may follow the = of an assignment.
BARE_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9])(?:https?|wss?|s3a?|gs|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)://[^\s"'<>]{3,}"""
    r"""|(?<![A-Za-z0-9])(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[a-z]{2,}(?::\d+)?""",
    re.ASCII | re.IGNORECASE,
)
_ENDPOINT_HINTS = (b"://", b"host", b"endpoint", b"server")
_SCOPE = re.compile(r"\n[ \t\r]*\n")
#: Code points between two parts that still belong together.
REACH = 200


def base_spans(text: str, raw: bytes, low: bytes) -> list[tuple[int, int, int]]:
    """(start, index of kind, end): leftmost matches of each base kind that do not overlap and are long enough."""
    out = []
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def _mixed(word: str) -> bool:
    """Looks random: small and capital letters and digits, and at least 8 different characters, however long."""
    return any(c.islower() for c in word) and any(c.isupper() for c in word) and any(c.isdigit() for c in word) and len(set(word)) >= 8


def weak_parts(text: str, low: bytes) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of possible identifiers, secrets and endpoints; too weak to report alone."""
    out = []
    if any(h in low for h in _IDENT_HINTS):
        for m in IDENT.finditer(text):
            g = 1 if m.group(1) is not None else 2
            out.append((m.start(g), 3, m.end(g)))
    if any(h in low for h in _ENDPOINT_HINTS):
        out += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return out


#: Kinds that complete each kind. Identifiers and bare secrets are compared apart, as one value can look like both.
_PARTNERS = ((1, 3, 5), (0, 2, 4), (1, 3, 5), (0, 2), (1, 5), (0, 2, 4))


def link(parts: list[tuple[int, int, int]], text: str, reach: int = REACH) -> set[tuple[int, int, int]]:
    """Parts that have a complement within reach in their scope: an interval join by one sweep.

    Parts are sorted by start and each scope is swept with the furthest end of each kind so far,
    forwards for partners to the left and backwards for those to the right. An identifier and a
    bare secret that overlap are one value, and complete each other only if another one is near.
    """
    cuts = [m.start() for m in _SCOPE.finditer(text)]
    ends, starts, kept = {}, {}, set()
    parts = sorted(set(parts))
    scope = [bisect_left(cuts, p[0] + 1) for p in parts]
    weak: dict[tuple[int, int], tuple[list[int], list[int]]] = {}  # starts and ends; within a kind none overlap
    for p, s in zip(parts, scope, strict=True):
        if any(ends.get((s, k), -reach - 1) + reach >= p[0] for k in _PARTNERS[p[1]]):
            kept.add(p)
        ends[s, p[1]] = max(ends.get((s, p[1]), 0), p[2])
        if p[1] in (3, 4):
            own = weak.setdefault((s, p[1]), ([], []))
            own[0].append(p[0])
            own[1].append(p[2])
    for p, s in reversed(list(zip(parts, scope, strict=True))):
        if any(starts.get((s, k), len(text) + reach + 1) <= p[2] + reach for k in _PARTNERS[p[1]]):
            kept.add(p)
        starts[s, p[1]] = p[0]
        if p[1] in (3, 4) and (s, 7 - p[1]) in weak:
            first, last = weak[s, 7 - p[1]]
            left, right = bisect_right(last, p[0]), bisect_left(first, p[2])
            if (left and last[left - 1] + reach >= p[0]) or (right < len(first) and first[right] <= p[2] + reach):
                kept.add(p)
    return kept


def scan(text: str, reach: int = REACH) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, spans that the linking adds), each sorted by start, then kind."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    base = base_spans(text, raw, low)
    weak = weak_parts(text, low)
    if weak or any(k == 1 for _, k, _ in base):
        # A bare secret must have a partner (a base access span is one too), so it is only looked for where there is one.
        weak += [(m.start(), 4, m.end()) for m in BARE_SECRET.finditer(text) if _mixed(m.group())]
    taken = sorted((a, b) for a, _, b in base)
    begins, reached = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]

    def free(p):
        """No base span overlaps p: of those that begin before its end, none reaches past its start."""
        return reached[bisect_left(begins, p[2])] <= p[0]

    weak = [p for p in weak if free(p)]
    found = link([*weak, *base], text, reach) if weak else set()
    return sorted(base), sorted(p for p in found if p[1] >= 3)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_spans(docs: DataFrame, text: str = "text", ident: str = "doc_id", reach: int = REACH) -> DataFrame:
    """One row for each input row: identifier, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    spans lists kind:start:end (code points, end exclusive) by start, then kind; base spans are
    always among them, weak ones only where complementary parts co-occur. Null counts as empty
    (no spans, digest of the empty string). Rows are independent: repeated rows and null
    identifiers pass through; other columns are dropped.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, linked = [[], [], []], [], [], []
            for value in batch.column(1):
                base, more = scan(value.as_py() or "", reach)
                for k in range(3):
                    counts[k].append(sum(1 for x in base if x[1] == k))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(sorted([*base, *more])))
                linked.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(linked, pa.int64())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"],
            )

    shape = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
    return docs.select(docs[ident].alias("id"), docs[text].alias("text")).mapInArrow(run, shape).withColumnRenamed("id", ident)
