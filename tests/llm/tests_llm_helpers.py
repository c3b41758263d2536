"""Brute-force helpers that several test modules use."""

import zlib
from collections import defaultdict

import numpy as np


def low(text):
    return (text or "").encode().lower()


def check_pieces(rows, docs, window):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, ids in docs.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            piece = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece))
            at += r.length
        assert at == len(ids)
    padding = 0
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def linked_classes(rows):
    """doc_id -> smallest doc_id reachable by 5-word shingle links of 0.8."""
    sets = []
    for _, t in rows:
        w = low(t).split()
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    return {i: find(i) for i, _ in rows}
