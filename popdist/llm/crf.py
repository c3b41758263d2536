"""Line features and a two-label linear-chain conditional random field (numpy).

All lines of many documents are handled at once: a document's lines are
padded to its length class, and forward-backward runs over positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER, LOWER, DIGIT, BLANK, CONTROL, LEAD, TAIL = range(7)
N_CLASSES = 7 + len(PUNCTUATION)
#: own features of a line: a rate for each class, and nine more
N_OWN = N_CLASSES + 9
#: words back with which a word is compared
LAGS = (1, 2, 3)
#: with the previous and the next line's
N_FEATURES = 3 * N_OWN


def _byte_classes() -> np.ndarray:
    of = np.full(256, CONTROL, dtype=np.int64)
    for letters, c in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), (b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"0123456789", DIGIT), (b" ", BLANK)):
        of[list(letters)] = c
    of[0x80:0xC0], of[0xC0:] = TAIL, LEAD
    for i, p in enumerate(PUNCTUATION):
        of[p] = 7 + i
    return of


_CLASS = _byte_classes()
_BYTE = np.random.default_rng(11).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.random.default_rng(12).integers(1, 2 ** 63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass
class Lines:
    """``own``: features of each line; ``weight``: its length in bytes plus 1;
    ``doc``: its text's number (ascending)."""

    own: np.ndarray
    weight: np.ndarray
    doc: np.ndarray
    n_docs: int


def line_features(texts: list[bytes]) -> Lines:
    """Features of every line of every text; an empty text has one empty line."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    length = ends - starts
    doc_end = np.cumsum([len(t) + 1 for t in texts]) - 1
    doc = np.searchsorted(doc_end, ends)
    n = len(ends)
    line = np.repeat(np.arange(n), length + 1)
    kind = _CLASS[raw]
    kind_at = line * N_CLASSES + kind
    counts = np.bincount(kind_at, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(float)
    counts[:, CONTROL] -= 1  # the line's end
    size = np.maximum(length, 1)[:, None]
    same = np.zeros(len(raw), dtype=bool)
    same[1:] = (raw[1:] == raw[:-1]) & (kind[1:] >= 7)
    doubled = np.bincount(line, same, n)
    words = np.bincount(line[1:], (kind[1:] == BLANK) & (kind[:-1] != BLANK), n) + 1 if len(raw) else np.zeros(0)
    mark = np.bincount(line[:-1], (kind[:-1] >= 7) & ((kind[1:] == BLANK) | (raw[1:] == 10)), n) if len(raw) else np.zeros(0)
    # words by hash, to see repeats within a line and of the line before
    solid = kind != BLANK
    solid[ends] = False
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid]).astype(np.int8)) == 1)
    place = np.arange(len(raw)) - np.repeat(edge, np.diff(np.append(edge, len(raw)))) if len(edge) and edge[0] == 0 else None
    if place is None and len(edge):
        place = np.concatenate([np.zeros(edge[0], dtype=np.int64), np.arange(edge[0], len(raw)) - np.repeat(edge, np.diff(np.append(edge, len(raw))))])
    word = np.add.reduceat(np.where(solid, _BYTE[raw] * _PLACE[place % len(_PLACE)], np.uint64(0)), edge) if len(edge) else np.zeros(0, np.uint64)
    word_line = line[edge]
    repeats = []
    for lag in LAGS:
        equal = (word[lag:] == word[:-lag]) & (word_line[lag:] == word_line[:-lag])
        repeats.append(np.bincount(word_line[lag:], equal, n)[:, None] / np.maximum(words, 1)[:, None])
    line_hash = np.zeros(n, np.uint64)
    np.add.at(line_hash, word_line, word * np.uint64(0x9E3779B97F4A7C15) ^ (word >> np.uint64(29)))
    twin = np.zeros((n, 1))
    if n > 1:
        twin[1:, 0] = (line_hash[1:] == line_hash[:-1]) & (doc[1:] == doc[:-1]) & (length[1:] > 0)
    own = np.concatenate([
        *repeats, twin,
        np.sqrt(counts / size), np.sqrt(doubled[:, None] / size), np.log1p(length)[:, None] / 5,
        np.sqrt(mark / np.maximum(words, 1))[:, None], (length / np.maximum(words, 1) / 10)[:, None].clip(0, 5),
        (length == 0)[:, None]], axis=1)
    return Lines(own, length + 1.0, doc, len(texts))


def join_lines(parts: list[Lines]) -> Lines:
    """The lines of several lists of texts, as of one list."""
    before = np.cumsum([0, *(p.n_docs for p in parts)])
    if not parts:
        return line_features([])
    return Lines(np.concatenate([p.own for p in parts]), np.concatenate([p.weight for p in parts]),
                 np.concatenate([p.doc + n for p, n in zip(parts, before, strict=False)]), int(before[-1]))


def with_neighbours(lines: Lines) -> np.ndarray:
    """Own features, those of the line before and of the line after (zeros at a
    document's ends)."""
    own, n = lines.own, len(lines.own)
    before, after = np.zeros_like(own), np.zeros_like(own)
    if n > 1:
        joined = (lines.doc[1:] == lines.doc[:-1])[:, None]
        before[1:], after[:-1] = own[:-1] * joined, own[1:] * joined
    return np.concatenate([own, before, after], axis=1)


def _length_classes(doc: np.ndarray, n_docs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents whose line counts pad to the same power of two: (line numbers
    [documents, positions], mask)."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    padded = 1 << np.ceil(np.log2(np.maximum(count, 1))).astype(int)
    for width in np.unique(padded):
        who = np.flatnonzero((padded == width) & (count > 0))
        step = max(1, 4_000_000 // int(width))
        for i in range(0, len(who), step):
            some = who[i:i + step]
            place = np.arange(width)[None, :]
            mask = place < count[some][:, None]
            yield first[some][:, None] + np.minimum(place, count[some][:, None] - 1), mask


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emit: np.ndarray, trans: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each line [lines, 2], expected transitions [2, 2] and the
    sum of log Z, in log space."""
    marginal, pairs, total = np.zeros_like(emit), np.zeros((2, 2)), 0.0
    for at, mask in _length_classes(doc, n_docs):
        e = emit[at]
        width = at.shape[1]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            step = _lse(alpha[:, t - 1, :, None] + trans[None], 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = _lse(trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        z = _lse(alpha[:, -1], 1)
        total += z.sum()
        p = np.exp(alpha + beta - z[:, None, None])
        marginal[at[mask]] = p[mask]
        for t in range(1, width):
            joint = alpha[:, t - 1, :, None] + trans[None] + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            pairs += (np.exp(joint) * mask[:, t, None, None]).sum(0)
    return marginal, pairs, total


@dataclass
class LineCrf:
    """Emission weights [features + 1, 2], transitions [2, 2], scaling."""

    weights: np.ndarray
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    #: score of a text of no lines at all, or of every text of a flat model
    prior: float
    #: learnt from labels of one kind, or from none
    flat: bool = False
    #: there were labels
    known: bool = True

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    @classmethod
    def fit(cls, lines: Lines, labels: np.ndarray, epochs: int = 30, rate: float = 0.03, decay: float = 1e-3, batch: int = 256, seed: int = 0) -> "LineCrf":
        """Every line of a document is taught the document's label.  With labels
        of fewer than two kinds the model is flat and scores the labels' mean."""
        x = with_neighbours(lines)
        flat = cls(np.zeros((x.shape[1] + 1, 2)), np.zeros((2, 2)), np.zeros(x.shape[1]), np.ones(x.shape[1]),
                   float(labels.mean()) if len(labels) else 0.5, flat=True, known=len(labels) > 0)
        if len(np.unique(labels)) < 2:
            return flat
        model = cls(flat.weights, flat.trans, x.mean(0), x.std(0) + 1e-3, float(labels.mean()))
        z, y = model._scaled(x), labels[lines.doc].astype(int)
        gold, random = np.eye(2)[y], np.random.default_rng(seed)
        first = np.searchsorted(lines.doc, np.arange(lines.n_docs + 1))
        m = [np.zeros_like(model.weights), np.zeros((2, 2))]
        v = [np.zeros_like(model.weights), np.zeros((2, 2))]
        step = 0
        for epoch in range(epochs):
            order = random.permutation(lines.n_docs)
            for i in range(0, len(order), batch):
                docs = order[i:i + batch]
                rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
                doc = np.repeat(np.arange(len(docs)), first[docs + 1] - first[docs])
                emit = z[rows] @ model.weights
                marginal, pairs, _ = forward_backward(emit, model.trans, doc, len(docs))
                inside = doc[1:] == doc[:-1]
                seen = gold[rows][:-1][inside].T @ gold[rows][1:][inside]
                grads = (z[rows].T @ (marginal - gold[rows]) / len(docs) + decay * model.weights,
                         (pairs - seen) / len(docs) + decay * model.trans)
                step += 1
                lr = rate * (0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 0.02)
                for k, (w, g) in enumerate(zip((model.weights, model.trans), grads, strict=True)):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return model

    def line_marginals(self, lines: Lines) -> np.ndarray:
        """P(good) of each line."""
        emit = self._scaled(with_neighbours(lines)) @ self.weights
        return forward_backward(emit, self.trans, lines.doc, lines.n_docs)[0][:, 1]

    def score(self, lines: Lines) -> np.ndarray:
        """Length-weighted mean of the lines' marginals, by document."""
        if self.flat:
            return np.full(lines.n_docs, self.prior)
        p = self.line_marginals(lines)
        total = np.bincount(lines.doc, lines.weight, lines.n_docs)
        part = np.bincount(lines.doc, lines.weight * p, lines.n_docs)
        return np.where(total > 0, part / np.maximum(total, 1e-12), self.prior).clip(0, 1)
