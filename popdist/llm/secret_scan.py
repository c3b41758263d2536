"""Secret scans: base patterns, plus sliding-window entropy over candidates.

A candidate is a run of at least ``SHORTEST`` token characters.  For each
character class, a window slides over the candidate's stretches of that class;
its Shannon entropy follows from counts that change by one character in and
one out.  Windows at or above the class's threshold are merged into a span,
unless an allow-list pattern explains the whole span or the whole run.
Harmless pieces (fillers, placeholder words) are cut out before, and explain
nothing but themselves.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import text_slices
from popdist.llm.common import unused

SHORTEST = 20

#: fixed values: the base patterns and least lengths, kinds in reporting order
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE_KINDS = ("assign", "access", "hex")
LEAST = {"assign": 8, "access": 16, "hex": 32}


@dataclass(frozen=True)
class CharClass:
    """A class of characters, its window and the entropy (bits) to report."""

    kind: str
    letters: str
    window: int
    bits: float
    #: what a stretch must also match, so that plain words are no candidates
    needs: str


CLASSES = (
    CharClass("entropy_hex", "0123456789abcdefABCDEF", 24, 3.0, r"(?=.*[0-9])(?=.*[a-fA-F])"),
    CharClass("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.9,
              r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
    # of 20 random characters, 0.6 % (base32) and 0.2 % (base36) have less than 3.3 bits
    CharClass("entropy_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20, 3.3, r"(?=.*[0-9])(?=.*[A-Z])"),
    CharClass("entropy_lower", "abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.3, r"(?=.*[0-9])(?=.*[a-z])"),
)
#: whole spans or runs that are not secrets although they look random
ALLOW = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
    r"[0-9_.=+/-]+",  # numbers, dates
    r"[A-Za-z]+([_/=.-][A-Za-z]+)*[0-9]{0,4}",  # words and paths
)
#: harmless pieces of a stretch; what is left of it counts
PIECES = (
    r"(?i:example|placeholder|changeme|x{4,})",
    r"(.)\1{7,}",  # fillers
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))


def high_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows whose entropy is at least ``bits``.

    H = log2 w - (sum of c log2 c) / w; the sum changes in two terms a step.
    """
    if len(text) < window:
        return []
    term = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    total, spans, most = 0.0, [], (math.log2(window) - bits) * window + 1e-9
    for i, ch in enumerate(text):
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    def __init__(self, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ALLOW, pieces: Iterable[str] = PIECES):
        self.classes = [(c, re.compile(f"[{re.escape(c.letters)}]{{{c.window},}}"), re.compile(c.needs)) for c in classes]
        self.allow = [re.compile(a) for a in allow]
        self.pieces = [re.compile(p) for p in pieces]

    @staticmethod
    def base(text: str) -> list[tuple[int, str, int]]:
        """(start, kind, end) of the base kinds; kinds of one start as listed."""
        low, out = text.lower(), []
        if any(w in low for w in ("passw", "secret", "token", "api")):
            out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
        if "AKIA" in text:
            out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
        return out

    @staticmethod
    def hexes(run: str, at: int) -> list[tuple[int, str, int]]:
        return [(at + m.start(), "hex", at + m.end()) for m in HEX.finditer(run) if len(m[0]) >= LEAST["hex"]]

    def left(self, stretch: str) -> list[tuple[int, int]]:
        """[start, end) of what stays of a stretch without its harmless pieces."""
        out, at = [], 0
        for a, b in sorted(m.span() for p in self.pieces for m in p.finditer(stretch)):
            if a > at:
                out.append((at, a))
            at = max(at, b)
        return [*out, (at, len(stretch))] if at < len(stretch) else out

    def added(self, run: str, at: int) -> list[tuple[int, str, int]]:
        """Entropy spans of one candidate."""
        if any(x.fullmatch(run) for x in self.allow):
            return []
        out = []
        for c, stretch, needs in self.classes:
            for m in stretch.finditer(run):
                parts, first = self.left(m[0]), [0]
                for a, b in parts:
                    first.append(first[-1] + b - a)
                rest = "".join(m[0][a:b] for a, b in parts)
                for a, b in high_windows(rest, c.window, c.bits):
                    found = rest[a:b]
                    if not needs.match(found) or any(x.fullmatch(found) for x in self.allow):
                        continue
                    i = bisect_right(first, a) - 1
                    while i < len(parts) and first[i] < b:  # the span's parts, where they were
                        s, e = max(a, first[i]), min(b, first[i + 1])
                        out.append((at + m.start() + parts[i][0] + s - first[i], c.kind, at + m.start() + parts[i][0] + e - first[i]))
                        i += 1
        return out

    def scan(self, text: str, runs: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
        """All spans as (kind, start, end) in code points; ``runs`` are the
        text's candidates with their places."""
        base = self.base(text)
        for at, run in runs:
            base += self.hexes(run, at)
        inside = lambda s, e: any(a <= s and e <= b for a, _, b in base)
        more = {x for at, run in runs for x in self.added(run, at) if not inside(x[0], x[2])}
        order = {k: i for i, k in enumerate(KINDS)}
        return [(k, s, e) for s, k, e in sorted({*base, *more}, key=lambda x: (x[0], order.get(x[1], len(order)), x[2]))]


_CANDIDATE = np.zeros(256, dtype=bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True


def candidates(raw: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first byte, end byte) of the runs of candidate characters in the
    texts raw[bounds[i]:bounds[i+1]]; runs stop at a text's border."""
    inside = _CANDIDATE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[bounds] = True
    first = inside & np.concatenate([[True], ~inside[:-1]]) if len(raw) else inside
    first |= inside & edge[:-1]
    last = inside & np.concatenate([~inside[1:], [True]]) if len(raw) else inside
    last |= inside & edge[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= SHORTEST
    start, end = start[long], end[long]
    text = np.searchsorted(bounds, start, side="right") - 1
    return list(zip(text.tolist(), start.tolist(), end.tolist(), strict=True))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _each(column: pa.Array, scanner: Scanner) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Every text with its spans, in order."""
    for _, texts in text_slices(column):
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        raw = b"".join(texts)
        runs: dict[int, list[tuple[int, str]]] = {}
        for i, s, e in candidates(np.frombuffer(raw, np.uint8), bounds):
            at = len(raw[bounds[i]:s].decode())  # code points before the run
            runs.setdefault(i, []).append((at, raw[s:e].decode()))
        for i, t in enumerate(texts):
            text = t.decode()
            yield text, scanner.scan(text, runs.get(i, []))


def spans_of(text: Column, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ALLOW) -> Column:
    """``spans`` of every whole text; only the text goes to Python."""
    classes, allow = tuple(classes), tuple(allow)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(classes, allow)
        for column in columns:
            yield pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans] for _, spans in _each(column, scanner)], SPANS)

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return F.arrow_udf(run, kind, F.ArrowUDFType.SCALAR_ITER)(F.coalesce(text, F.lit("")))


def mask(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with the union of the spans replaced, a ``mark`` for each run."""
    out, at = [], 0
    for _, start, end in spans:  # by start
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ALLOW) -> DataFrame:
    """(doc_id, spans array<struct<kind,start,end>>) of every row, in whole texts.

    Offsets are code points, ends exclusive; sorted by start, then kind.  Null
    and empty texts have no spans; each repeated row is scanned.  The scan is
    one pass, no shuffle.
    """
    return docs.select("doc_id", spans_of(docs["text"], classes, allow).alias("spans"))


def joined(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", classes: Iterable[CharClass] = CLASSES,
           allow: Iterable[str] = ALLOW) -> DataFrame:
    """``docs`` with the text of every span replaced by ``mark``; overlapping
    spans are replaced once.  Clean rows are unchanged; n_chars follows the
    text.  Null texts stay null."""
    classes, allow, word = tuple(classes), tuple(allow), mark

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(classes, allow)
        for column in columns:  # null where nothing is found
            yield pa.array([mask(t, spans, word) if spans else None for t, spans in _each(column, scanner)], pa.string())

    masked = F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(F.coalesce(docs["text"], F.lit("")))
    new = unused(docs.columns, "_masked")
    changed = {"text": F.coalesce(new, "text"),
               "n_chars": F.when(F.col(new).isNotNull(), F.char_length(new).cast("long")).otherwise(F.col("n_chars"))
               if "n_chars" in docs.columns else None}
    return docs.withColumn(new, masked).select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])
