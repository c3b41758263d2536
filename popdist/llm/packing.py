"""Packing token sequences by non-negative least squares.

A document gives whole windows of its own and one remainder.  The remainders'
length histogram (at most window - 1 bins, so it may pass the driver) is
matched with shallow combinations of lengths that fill a window exactly: least
squares gives each combination's repeat count, rounded down to what the
histogram still holds.  What is left is packed greedily: laid end to end and
cut at window borders; the last, partial window is split by its binary digits
into sequences of power-of-two length, which need no padding.

Only counts meet on the driver.  A document finds its place from its rank
among the documents of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import LEAF, encode_documents
from popdist.llm.common import buckets_for, running, staged

WINDOW = 4096
#: equal lengths in a combination, at most
DEPTH = 12
STEPS = 300


def combinations(window: int, depth: int = DEPTH) -> list[tuple[tuple[int, int], ...]]:
    """Shallow fillings: m times a, plus one of the rest; as (length, times)."""
    found = set()
    for m in range(1, depth + 1):
        for a in range(1, window // m + 1):
            rest = window - m * a
            if rest == 0:
                found.add(((a, m),))
            elif rest == a:
                found.add(((a, m + 1),))
            else:
                found.add(tuple(sorted([(a, m), (rest, 1)], reverse=True)))
    return sorted((c for c in found if c[0][0] < window), reverse=True)


def nnls(combos: list[tuple[tuple[int, int], ...]], histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that bring A x near ``histogram`` (least squares,
    by accelerated projected gradient; A is sparse)."""
    if not combos:
        return np.zeros(0)
    col = np.array([j for j, c in enumerate(combos) for _ in c])
    row = np.array([a for c in combos for a, _ in c])
    val = np.array([m for c in combos for _, m in c], dtype=float)
    times = lambda x: np.bincount(row, val * x[col], len(histogram))
    back = lambda r: np.bincount(col, val * r[row], len(combos))
    v = np.ones(len(combos))
    for _ in range(30):  # largest eigenvalue of A'A: the step size
        v = back(times(v))
        v /= (norm := np.linalg.norm(v))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(times(y) - histogram) / norm)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass
class Plan:
    """Where the documents of each remainder length go, by rank."""

    window: int
    #: length -> first rank of each run, the run's first sequence, and offset
    runs: dict[int, tuple[list[int], list[int], list[int]]] = field(default_factory=dict)
    #: length -> (ranks used by runs, where the rest begin in the residual line)
    rest: dict[int, tuple[int, int]] = field(default_factory=dict)
    residual_sequence: int = 0
    residual_tokens: int = 0
    #: borders of the last partial window's pieces, from its start
    tail: list[int] = field(default_factory=list)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, tokens) of the pieces of one remainder."""
        used, begin = self.rest[length]
        if rank < used:
            first, seq, at = self.runs[length]
            i = bisect_right(first, rank) - 1
            return [(seq[i] + rank - first[i], at[i], length)]
        pieces, at, end = [], begin + (rank - used) * length, begin + (rank - used + 1) * length
        whole = self.residual_tokens // self.window
        while at < end:
            seq, offset = divmod(at, self.window)
            border = (seq + 1) * self.window
            if seq == whole:
                i = bisect_right(self.tail, offset) - 1
                border = whole * self.window + self.tail[i + 1]
                seq, offset = whole + i, offset - self.tail[i]
            stop = min(end, border)
            pieces.append((self.residual_sequence + seq, offset, stop - at))
            at = stop
        return pieces


def make_plan(histogram: dict[int, int], first_sequence: int, window: int = WINDOW) -> Plan:
    """From remainder length -> documents."""
    bins = np.zeros(window + 1)
    for a, n in histogram.items():
        bins[a] = n
    combos = [c for c in combinations(window) if all(bins[a] >= m for a, m in c)]
    x = nnls(combos, bins)
    plan, left, sequence = Plan(window), bins.astype(np.int64), first_sequence
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window + 1, dtype=np.int64)
    for j in np.argsort(-x, kind="stable"):
        n = min([int(np.floor(x[j] + 0.5)), *(left[a] // m for a, m in combos[j])])
        if n <= 0:
            continue
        offset = 0
        for a, m in combos[j]:
            for _ in range(m):
                runs.setdefault(a, []).append((int(used[a]), sequence, offset))
                used[a] += n
                left[a] -= n
                offset += a
        sequence += int(n)
    plan.runs = {a: tuple(map(list, zip(*r, strict=True))) for a, r in runs.items()}
    total = 0
    for a in sorted(histogram, reverse=True):
        plan.rest[a] = (int(used[a]), total)
        total += int(left[a]) * a
    plan.residual_sequence, plan.residual_tokens = int(sequence), total
    plan.tail, rest = [0], total % window
    for bit in reversed(range(window.bit_length())):
        if rest >> bit & 1:
            plan.tail.append(plan.tail[-1] + (1 << bit))
    return plan


def with_end(end_id: int):
    """Columns n and ids, the end id appended; ids as 16-bit where they fit."""

    def finish(ids: list[np.ndarray]) -> dict[str, pa.Array]:
        ended = [np.append(i, np.uint32(end_id)) for i in ids]
        return {"n": pa.array([len(i) for i in ended], pa.int64()),
                "ids": pa.array([i.astype(np.uint16 if i.max() < 1 << 16 else np.uint32).tobytes() for i in ended], pa.binary())}

    return finish


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, leaf: int = LEAF) -> DataFrame:
    """Every token of ``docs`` in exactly one piece of a sequence.

    A document's tokens are its encoding and ``end_id``; a null or empty text
    is that id alone.  Repeated rows and rows without doc_id are documents of
    their own.  No rows in, no rows out.  Columns: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian, 32-bit).
    """
    tokens = staged(encode_documents(docs, path, leaf, with_end(end_id), "n long, ids binary"), "pack-tokens")
    narrow = tokens.select(
        "row", (F.col("n") % window).cast("int").alias("rest"),
        F.expr(f"n div {window}").alias("full"))
    counts = narrow.groupBy("rest").agg(F.count("*").alias("c"), F.sum("full").alias("f")).collect()  # <= window rows
    buckets = buckets_for(sum(r.c for r in counts))
    plan = make_plan({r.rest: r.c for r in counts if r.rest}, sum(r.f for r in counts), window)
    ranked = running(narrow, ["rest"], "row", buckets, F.lit(1), "rank")
    placed = running(ranked, [], "row", buckets, F.col("full"), "first_sequence")

    def pieces(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, n, raw, rank, first in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "ids", "rank", "first_sequence")), strict=True):
                ids = np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype("<u4")
                full, rest = divmod(n, window)
                spots = [(first + i, 0, window) for i in range(full)]
                if rest:
                    spots += plan.place(rest, rank)
                at = 0
                for seq, offset, length in spots:
                    piece = ids[at:at + length].tobytes()
                    for k, v in zip(out, (doc_id, at, length, zlib.crc32(piece), n, seq, offset, piece), strict=True):
                        out[k].append(v)
                    at += length
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()})

    return tokens.select("row", "doc_id", "n", "ids").join(placed.select("row", "rank", "first_sequence"), "row") \
        .select("doc_id", "n", "ids", "rank", "first_sequence").mapInArrow(
            pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                    "sequence_id long, offset long, ids binary")
