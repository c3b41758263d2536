"""Bidirectional gated recurrent network with attention pooling, in numpy.

Input of a word: the embedding of its vocabulary entry (entry 0: any other
word) and the embeddings of its known character sequences, those of 4 and of 6
bytes at every place of the word, its borders included.  A run of letters longer
than a word ever is (scripts without spaces) is cut into overlapping pieces, so
every sequence lies whole in one of them.  A window of words gives one score; a
document's score is that of its worst window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: words of a window; windows overlap by half
WINDOW = 32
STRIDE = 16
WORD_DIM = 12
CHAR_DIM = 8
HIDDEN = 8
#: bytes of the character sequences
SIZES = (4, 6)
#: a longer run of letters is cut into pieces that begin so many bytes apart
PIECE = 32
#: a word or a sequence is known from so many documents of the sample on, if of
#: all of them no more than CHANCE would be as toxic by chance
MIN_DOCS = 3
CHANCE = 5.0
PRIOR = 4.0
_K = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.random.default_rng(21).integers(1, 2 ** 63, 64, dtype=np.uint64) | np.uint64(1)
_BYTE = np.random.default_rng(22).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)

#: ASCII letters, digits and all bytes of other letters make words
_SOLID = np.zeros(256, dtype=bool)
_SOLID[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")] = True
_SOLID[0x80:] = True


@dataclass
class Words:
    """The words of many texts: the 64-bit ``hash`` of every different word,
    its character sequences ``grams[bounds[i]:bounds[i + 1]]``; and of the words
    in a row the number ``of`` the different word and the ``doc``."""

    hash: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray
    of: np.ndarray
    doc: np.ndarray
    n_docs: int

    def owners(self) -> np.ndarray:
        """The different word that each character sequence belongs to."""
        return np.repeat(np.arange(len(self.hash)), np.diff(self.bounds))

    def only(self, used: np.ndarray) -> "Words":
        """The different words numbered ``used`` alone, without the texts."""
        size = np.diff(self.bounds)[used]
        at = _ranges(self.bounds[used], size)
        none = np.zeros(0, np.int64)
        return Words(self.hash[used], self.grams[at], np.concatenate([[0], np.cumsum(size)]), none, none, self.n_docs)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), then the next."""
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - size), size)


def read_words(texts: list[bytes]) -> Words:
    """Lower-cased (A-Z) words of every text; vectorised over all bytes."""
    raw = np.frombuffer(b"\n" + b"\n".join(t.lower() for t in texts) + b"\n", np.uint8)
    solid = _SOLID[raw]
    change = np.diff(solid.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    pieces = np.maximum(1, -(-(end - start - max(SIZES)) // PIECE))
    nth = _ranges(np.zeros(len(start), np.int64), pieces)
    begin, run_end = np.repeat(start, pieces) + nth * PIECE, np.repeat(end, pieces)
    last = nth == np.repeat(pieces, pieces) - 1
    finish = np.where(last, run_end, np.minimum(begin + PIECE + max(SIZES), run_end))
    length = finish - begin
    first = np.cumsum(length) - length
    at = _ranges(begin, length)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw[at]] * _PLACE[(at - np.repeat(begin, length)) % 64])])  # modulo 2 ** 64
    hashes, where, of = np.unique(_mix(total[first + length] - total[first]), return_index=True, return_inverse=True)
    # sequences of the different words; a zero byte stands for a border
    plain = np.where(solid, raw, 0).astype(np.uint64)
    open_, close = begin[where] - 1, finish[where] + 1
    counts = [np.maximum(0, close - open_ - n + 1) for n in SIZES]
    bounds = np.concatenate([[0], np.cumsum(sum(counts))])
    grams = np.empty(int(bounds[-1]), np.uint64)
    filled = bounds[:-1].copy()
    for n, count in zip(SIZES, counts, strict=True):
        place = _ranges(open_, count)
        key = np.full(len(place), n, np.uint64) << np.uint64(56)
        for j in range(n):
            key |= plain[place + j] << np.uint64(8 * j)
        grams[_ranges(filled, count)] = key
        filled += count
    doc_end = np.cumsum([len(x) + 1 for x in texts])
    return Words(hashes, grams, bounds, of, np.searchsorted(doc_end, begin - 1, side="right"), len(texts))


def _mix(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(31))) * _K


@dataclass
class Windows:
    """``at`` [windows, WINDOW]: places in a row of words, -1 beyond the end; ``doc``."""

    at: np.ndarray
    doc: np.ndarray


def windows_of(doc: np.ndarray, n_docs: int) -> Windows:
    """All overlapping windows; a text without words has none."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    many = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(n_docs), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    at = nth[:, None] * STRIDE + np.arange(WINDOW)[None, :]
    return Windows(np.where(at < count[owner][:, None], at + first[owner][:, None], -1), owner)


def _entries(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """1 + the place in ``known``; 0 for others."""
    if not len(known):
        return np.zeros(hashes.shape, dtype=np.int64)
    i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[i] == hashes, i + 1, 0)


def word_windows(words: Words) -> Windows:
    """All overlapping windows, of numbers of different words."""
    windows = windows_of(words.doc, words.n_docs)
    return Windows(np.where(windows.at >= 0, words.of[windows.at] if len(words.of) else -1, -1), windows.doc)


def _add_rows(n: int, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """[n, columns]: the sums of ``values`` by row number."""
    return np.stack([np.bincount(rows, values[:, j], n) for j in range(values.shape[1])], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class BiGru:
    """Parameters ``p``; ``vocabulary`` and ``sequences``: sorted hashes of the
    known words and character sequences."""

    def __init__(self, vocabulary: np.ndarray, sequences: np.ndarray, seed: int = 0):
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        self.vocabulary, self.sequences = vocabulary, sequences
        self.slots = np.zeros(1 << 20, dtype=bool)  # most sequences are unknown: told by one look
        self.slots[(_mix(sequences) >> np.uint64(44)).astype(np.int64)] = True
        self.base_rate = 0.5
        draw = lambda *s, scale: r.normal(0, scale, s).astype(np.float32)
        self.p = {"word": draw(len(vocabulary) + 1, WORD_DIM, scale=0.05), "char": draw(len(sequences) + 1, CHAR_DIM, scale=0.05),
                  "att": draw(2 * h, scale=0.3), "out": draw(2 * h, scale=0.3), "bias": np.full(1, -1.0, np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": draw(d, 3 * h, scale=d ** -0.5), f"u{way}": draw(h, 3 * h, scale=h ** -0.5),
                       f"c{way}": np.zeros(3 * h, np.float32)}

    def known_grams(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries and owners of the known character sequences, and the weight
        of each owner's: 1 / square root of their number."""
        slot = (_mix(words.grams) >> np.uint64(44)).astype(np.int64)
        some = np.flatnonzero(self.slots[slot])
        entry = _entries(self.sequences, words.grams[some])
        some, entry = some[entry > 0], entry[entry > 0]
        owner = np.searchsorted(words.bounds, some, side="right") - 1
        count = np.bincount(owner, minlength=len(words.hash))
        return entry, owner, 1 / np.sqrt(np.maximum(count, 1)).astype(np.float32)

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """[different words + 1, WORD_DIM + CHAR_DIM], the last row for padding;
        the words' entries, and ``known_grams``."""
        n = len(words.hash)
        entry, grams = _entries(self.vocabulary, words.hash), self.known_grams(words)
        out = np.zeros((n + 1, WORD_DIM + CHAR_DIM), np.float32)
        out[:n, :WORD_DIM] = self.p["word"][entry]
        out[:n, WORD_DIM:] = _add_rows(n, grams[1], self.p["char"][grams[0]]) * grams[2][:, None]
        return out, entry, grams

    def _run(self, projected: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """Hidden states [windows, time, HIDDEN] of one direction."""
        h_size, u = HIDDEN, self.p[f"u{way}"]
        n, width = mask.shape
        h = np.zeros((n, h_size), np.float32)
        states = np.empty((width, n, h_size), np.float32)
        for t in (range(width) if way == "f" else reversed(range(width))):
            x, on = projected[:, t], mask[:, t, None]
            gates = _sigmoid(x[:, :2 * h_size] + h @ u[:, :2 * h_size])
            z, r = gates[:, :h_size], gates[:, h_size:]
            c = np.tanh(x[:, 2 * h_size:] + (r * h) @ u[:, 2 * h_size:])
            new = h + on * z * (c - h)
            if keep is not None:
                keep.append((t, h, z, r, c))
            h = new
            states[t] = h
        return states

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``x`` from ``inputs``."""
        mask = (windows >= 0).astype(np.float32)
        both, logs = [], {}
        for way in "fb":
            projected = (x @ self.p[f"w{way}"] + self.p[f"c{way}"])[windows]
            log = logs.setdefault(way, []) if keep is not None else None
            both.append(self._run(projected, mask, way, log))
        states = np.concatenate(both, axis=2)  # [time, windows, 2 HIDDEN]
        score = states @ self.p["att"] - 1e9 * (1 - mask.T)
        e = np.exp(score - score.max(0))
        a = e / e.sum(0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        if keep is not None:
            keep |= {"mask": mask, "logs": logs, "states": states, "a": a, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, words: Words, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Weighted cross entropy and its gradients, by hand."""
        x, entry, (known, owner, scale) = self.inputs(words)
        keep: dict = {}
        logit = self.forward(x, windows, keep)
        prob = _sigmoid(logit)
        total = max(float(weight.sum()), 1e-9)
        loss = float(-(weight * (target * np.log(prob + 1e-7) + (1 - target) * np.log(1 - prob + 1e-7))).sum() / total)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_logit = ((prob - target) * weight / total).astype(np.float32)
        g["out"], g["bias"] = keep["pooled"].T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * self.p["out"]
        a, states = keep["a"], keep["states"]
        d_a = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = a * (d_a - (a * d_a).sum(0))
        d_states = a[:, :, None] * d_pooled[None] + d_score[:, :, None] * self.p["att"]
        g["att"] = np.einsum("tn,tnh->h", d_score, states)
        h_size, dx = HIDDEN, np.zeros_like(x)
        for k, way in enumerate("fb"):
            u, du = self.p[f"u{way}"], g[f"u{way}"]
            d_h = np.zeros((len(windows), h_size), np.float32)
            d_proj = np.zeros((*windows.shape, 3 * h_size), np.float32)
            for t, h, z, r, c in reversed(keep["logs"][way]):
                on = keep["mask"][:, t, None]
                d_h = d_h + d_states[t, :, k * h_size:(k + 1) * h_size]
                d_z, d_c = d_h * on * (c - h), d_h * on * z
                d_pre_c = d_c * (1 - c * c)
                d_rh = d_pre_c @ u[:, 2 * h_size:].T
                d_gates = np.concatenate([d_z * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
                du[:, 2 * h_size:] += (r * h).T @ d_pre_c
                du[:, :2 * h_size] += h.T @ d_gates
                d_proj[:, t] = np.concatenate([d_gates, d_pre_c], axis=1)
                d_h = d_h * (1 - on * z) + d_rh * r + d_gates @ u[:, :2 * h_size].T
            flat, at = d_proj.reshape(-1, 3 * h_size), windows.ravel()
            real = at >= 0
            by_word = _add_rows(len(x), at[real], flat[real])
            g[f"c{way}"] = by_word.sum(0)
            g[f"w{way}"] = x.T @ by_word
            dx += by_word @ self.p[f"w{way}"].T
        g["word"] = _add_rows(len(self.p["word"]), entry, dx[:-1, :WORD_DIM])
        share = dx[:-1, WORD_DIM:] * scale[:, None]
        g["char"] = _add_rows(len(self.p["char"]), known, share[owner])
        return loss, g

    # -- documents --------------------------------------------------------------

    def window_logits(self, words: Words, windows: Windows, most: int = 8_192) -> np.ndarray:
        """``most`` windows at a time, so memory does not grow with the texts."""
        parts = []
        for i in range(0, len(windows.at), most):
            part, rows = _part(words, windows.at[i:i + most])
            parts.append(self.forward(self.inputs(part)[0], rows))
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """P(toxic) of each text: its worst window's; without words, the base rate."""
        words = read_words(texts)
        windows = word_windows(words)
        logit = np.full(words.n_docs, -np.inf)
        np.maximum.at(logit, windows.doc, self.window_logits(words, windows))
        return np.where(np.isneginf(logit), self.base_rate, _sigmoid(logit)).clip(0, 1)


def _part(words: Words, rows: np.ndarray) -> tuple[Words, np.ndarray]:
    """The different words numbered in ``rows`` (windows, -1 allowed) alone, and
    ``rows`` in that numbering."""
    inside = np.zeros(len(words.hash) + 1, dtype=bool)
    inside[rows] = True  # -1 marks the last place
    place = np.cumsum(inside) - 1
    return words.only(np.flatnonzero(inside[:-1])), np.where(rows >= 0, place[rows], -1)


def _odds(number: np.ndarray, n: int, doc: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, their toxic share by chance, and log odds of toxic ones, of
    things 0 to n - 1 that are found in documents (each pair once)."""
    n_all = np.bincount(number, minlength=n)
    n_toxic = np.bincount(number, labels[doc], n)
    share = float(labels.mean())  # what PRIOR documents that nobody has seen count as
    odds = np.log((n_toxic + PRIOR * share) / (n_all - n_toxic + PRIOR * (1 - share))) - np.log(share / (1 - share))
    return n_all, _tail(n_toxic, n_all, share), odds


def _telling(words: Words, labels: np.ndarray, min_docs: int, parts: int = 16) -> tuple[tuple, tuple]:
    """(hashes, log odds), sorted, of the words and of the character sequences in
    at least ``min_docs`` documents, and in toxic ones more than chance explains.
    Sequences are counted in ``parts``, to bound the memory."""
    pairs = np.unique(words.of.astype(np.int64) * words.n_docs + words.doc)
    word, doc = pairs // words.n_docs, pairs % words.n_docs
    found = [(words.hash, *_odds(word, len(words.hash), doc, labels))]
    part = (_mix(words.grams) >> np.uint64(58)).astype(np.int64) % parts
    owners = words.owners()
    for i in range(parts):
        mine = np.flatnonzero(part == i)
        known, number = np.unique(words.grams[mine], return_inverse=True)
        size = np.bincount(owners[mine], minlength=len(words.hash))
        first = np.cumsum(size) - size
        many = size[word]
        met = np.unique(number[_ranges(first[word], many)] * words.n_docs + np.repeat(doc, many))
        found.append((known, *_odds(met // words.n_docs, len(known), met % words.n_docs, labels)))

    def chosen(rows):
        hashes, n_all, chance, odds = map(np.concatenate, zip(*rows))
        often = n_all >= min_docs
        keep = often & (chance * often.sum() <= CHANCE)
        order = np.argsort(hashes[keep])
        return hashes[keep][order], odds[keep][order]

    return chosen(found[:1]), chosen(found[1:])


def _tail(hits: np.ndarray, tries: np.ndarray, share: float) -> np.ndarray:
    """An upper bound of the probability of at least ``hits`` of ``tries`` by
    chance (Chernoff); 1 where hits are no more than the share's."""
    rate = hits / np.maximum(tries, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(hits > 0, rate * np.log(rate / share), 0) + np.where(
            hits < tries, (1 - rate) * np.log((1 - rate) / (1 - share)), 0)
    return np.where(rate > share, np.exp(-tries * gain), 1.0)


def fit(texts: list[bytes], labels: np.ndarray, steps: int = 240, batch: int = 128, rate: float = 0.01,
        min_docs: int = MIN_DOCS, drawn: int = 1, sure: float = 1.0, seed: int = 0) -> BiGru:
    """Multiple-instance training.  In each round a toxic document teaches its
    currently worst window (and others that look as bad) as toxic; a clean one
    teaches its worst and ``drawn`` random windows as clean; rounds go on for at
    least ``steps`` batches.  Words and character sequences in fewer than
    ``min_docs`` documents are unknown."""
    words = read_words(texts)
    windows = word_windows(words)
    rate_toxic = float(labels.mean()) if len(labels) else 0.5
    if len(np.unique(labels)) < 2 or not len(words.hash):
        net = BiGru(np.zeros(0, np.uint64), np.zeros(0, np.uint64), seed)
        net.base_rate = rate_toxic
        net.p["out"][:] = 0
        net.p["bias"][:] = np.log(max(rate_toxic, 1e-3) / max(1 - rate_toxic, 1e-3))
        return net
    rounds = max(5, -(-steps * batch // max(1, (1 + drawn) * len(texts))))
    (vocabulary, word_odds), (sequences, char_odds) = _telling(words, labels, min_docs)
    net = BiGru(vocabulary, sequences, seed)
    net.base_rate = rate_toxic
    # an entry's first coordinate starts as its log odds
    net.p["word"][:, 0], net.p["char"][:, 0] = np.append(0, word_odds), np.append(0, char_odds)
    random = np.random.default_rng(seed)
    m = {k: np.zeros_like(w) for k, w in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    positive = labels[windows.doc] == 1
    best = net.p["word"][_entries(vocabulary, words.hash), 0]
    entry, owner, _ = net.known_grams(words)
    np.maximum.at(best, owner, net.p["char"][entry, 0])
    best = np.append(best, np.float32(-9))
    rank, level = best[windows.at].max(1), 3.0
    step = 0
    for turn in range(rounds):
        if turn:
            rank, level = net.window_logits(words, windows), sure
        order = np.lexsort((-rank, windows.doc))
        first = np.concatenate([[True], windows.doc[order][1:] != windows.doc[order][:-1]])
        worst = order[first]
        clean = np.flatnonzero(~positive)
        chosen = np.unique(np.concatenate([
            worst, np.flatnonzero(positive & (rank > level)),
            random.choice(clean, min(len(clean), drawn * len(worst)), replace=False)]))
        random.shuffle(chosen)
        for i in range(0, len(chosen), batch):
            some = chosen[i:i + batch]
            part, rows = _part(words, windows.at[some])
            _, g = net.gradients(part, rows, positive[some].astype(np.float32), np.ones(len(some), np.float32))
            step += 1
            lr = rate * (1 - turn / rounds) + 0.001
            for k, w in net.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return net
