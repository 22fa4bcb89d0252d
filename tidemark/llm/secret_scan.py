"""Secrets in texts: well-known forms by pattern, unknown ones by the entropy of a window slid over them.

Patterns find assignments, access keys and long hexadecimal numbers. Beside them every unbroken run of key
characters is a candidate: over it slides a window, whose Shannon entropy follows from counts that change by
one character in and one out. What passes the threshold of the window's character class is a span, unless
the candidate is of a form on the allow-list.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

# The patterns of the contract, their kinds in the order in which kinds stand, and the least
# length of a match or of its second group.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))

WINDOW = 20
# Entropies are compared as whole numbers, so that no order of additions decides: a character that is found
# c times in a window adds round(c * log2(c) * SCALE), and a window passes if the sum is at most its class's.
SCALE = 1 << 20
COST = [0, *[round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1)]]


@dataclass(frozen=True)
class CharClass:
    """Windows of these characters only, with at least `bits` of entropy a character, are random."""

    name: str
    characters: str
    bits: float

    @property
    def most(self) -> int:
        """The greatest sum of costs of a window that passes: H = log2 W - sum / W."""
        return math.floor((math.log2(WINDOW) - self.bits) * WINDOW * SCALE)


# From the narrowest to the widest; a window belongs to the first class that holds all its characters.
CLASSES = (
    CharClass("digits", "0123456789", math.inf),
    CharClass("lower_hex", "0123456789abcdef", 3.2),
    CharClass("upper_hex", "0123456789ABCDEF", 3.2),
    CharClass("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", math.inf),
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Candidates that are no secrets, whole: words and numbers joined by signs, UUIDs, digests named as such.
ALLOWED = (
    re.compile(r"[+/_=-]*(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*"),
    re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),
    re.compile(r"(?:sha1|sha256|sha384|sha512|md5)[-_=].*"),
)
KINDS = ("assign", "access", "hex", *[f"entropy_{c.name}" for c in CLASSES])
_BITS = {ch: sum(1 << k for k, c in enumerate(CLASSES) if ch in c.characters) for ch in CLASSES[-1].characters}
_MOST = [c.most if math.isfinite(c.bits) else -1 for c in CLASSES]

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, leftmost and without overlap for each kind; too short ones are dropped after that."""
    return [(kind, m.start(), m.end()) for kind, pattern, group, least in BASE for m in pattern.finditer(text) if len(m.group(group)) >= least]


def _random_windows(candidate: str) -> Iterator[tuple[int, int]]:
    """`start, class` of each window of the candidate that passes its class's threshold."""
    counts = dict.fromkeys(candidate, 0)
    total, outside = 0, [0] * len(CLASSES)
    for k, ch in enumerate(candidate):
        # Out goes the character a window before, in comes this one; all else stays as it was.
        if k >= WINDOW:
            gone = candidate[k - WINDOW]
            counts[gone] -= 1
            total += COST[counts[gone]] - COST[counts[gone] + 1]
            for c in range(len(CLASSES)):
                outside[c] -= not _BITS[gone] >> c & 1
        total += COST[counts[ch] + 1] - COST[counts[ch]]
        counts[ch] += 1
        for c in range(len(CLASSES)):
            outside[c] += not _BITS[ch] >> c & 1
        if k >= WINDOW - 1:
            own = outside.index(0)
            if total <= _MOST[own]:
                yield k - WINDOW + 1, own


def entropy_spans(text: str) -> list[Span]:
    """Random windows, those of one class that overlap or touch put together."""
    found: list[Span] = []
    for m in CANDIDATE.finditer(text):
        if any(form.fullmatch(m.group()) for form in ALLOWED):
            continue
        last: dict[int, list[int]] = {}
        for start, own in _random_windows(m.group()):
            begin, end = m.start() + start, m.start() + start + WINDOW
            if own in last and begin <= last[own][1]:
                last[own][1] = end
            else:
                if own in last:
                    found.append((f"entropy_{CLASSES[own].name}", *last[own]))
                last[own] = [begin, end]
        found += [(f"entropy_{CLASSES[own].name}", *span) for own, span in last.items()]
    return found


def listed(spans: list[Span]) -> str:
    """`kind:start:end` by start, then by kind as listed in `KINDS`, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def scan_secrets(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """`doc_id, n_assign, n_access, n_hex, base_sha256, spans` of every row.

    `spans` lists all finds, `base_sha256` is the digest of the list of those by pattern. Places are code
    points of the whole text, ends exclusive. Windows that lie in a find by pattern are spans, too. A null or
    empty text has no spans and the digest of an empty list. Rows that repeat, and null ids, are scanned like
    all others; a text is scanned whole by one task, however long, and nothing is gathered. No rows, no
    result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                own = t.as_py() or ""
                base = base_spans(own)
                kinds = [s[0] for s in base]
                counts = [kinds.count(k) for k, *_ in BASE]
                rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + entropy_spans(own))))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, types, strict=True)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    picked = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
