"""Word BPE encoding and decoding, exactly as the tokenizers library does it.

Short texts are encoded whole.  A long text is cut into leaves that Spark
encodes in parallel; neighbouring results are then concatenated up a binary
tree.  Around each join a window of text is encoded again and grown until it
agrees with the left side and with the right side, and is spliced in between.

Why agreement proves equality: a token sequence is the BPE encoding of a text
when every two neighbouring tokens are the encoding of their own text, and
after the splice each neighbouring pair stems from one of the three
encodings.  Two agreeing tokens are asked for on each side, so that the word
split, too, is in step.

ASCII white space always splits words, so a text's ids are the ids of its
white-space-separated chunks in a row.  The different chunks of many texts are
encoded once: those of common Latin letters through a byte-pair merger, all at
once; any other chunk, and every chunk that may hold a special token, by the
tokenizers library itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.common import id_text

#: code points of a leaf; longer texts are cut
LEAF = 32_768
#: bytes of texts that are encoded together; their different chunks are encoded once
TOGETHER = 2 << 20
#: chunks of other letters whose ids a Python worker remembers, at about 300 bytes each
ODD_CHUNKS = 50_000
#: code points on either side of a join in the first window
WINDOW = 32

END = "</w>"
#: characters whose lower-casing and normal form no neighbour changes
_PLAIN_CHUNK = "[!-~À-ÖØ-öø-įĲ-ňŊ-ž]"
#: those of them that are letters after lower-casing; fixed value: the
#: tokenizer's word split, for these characters
_LETTERS = "a-zß-öø-ž"
_ASCII = re.compile("[\\x00-\\x7f]")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ {_LETTERS}0-9]+| ")


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter of each byte, inverted: printable Latin-1 bytes
    stand for themselves, the others for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_table(spec: dict) -> list[str]:
    """Token strings by id, special ones too."""
    vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (1 + max(vocab.values()))
    for token, i in vocab.items():
        tokens[i] = token
    return tokens


def decode(tokens: list[str], ids: np.ndarray) -> str:
    """As the library decodes without a decoder: tokens, one space between."""
    return " ".join(map(tokens.__getitem__, ids.tolist()))


class WordBpe:
    """Encoder and decoder over a tokenizers file with word-end tokens."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.path = path
        self.specials = [t["content"].encode() for t in spec["added_tokens"]]
        self.tokens = token_table(spec)
        #: bytes of text that a token stands for
        self.surface = np.zeros(len(self.tokens), dtype=np.int64)
        ranks = {}
        for token, i in vocab.items():
            body = bytes(letters[c] for c in token.removesuffix(END))
            self.surface[i] = len(body)
            if 0 not in body or token == chr(256):  # a zero byte marks the word's end here
                ranks[body + b"\0" * token.endswith(END)] = i
        for t in spec["added_tokens"]:
            self.surface[t["id"]] = len(t["content"].encode())
        self.merger = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
        self.gap = vocab["Ġ" + END]  # a word of one space: none comes from a text
        self.odd: dict[str, np.ndarray] = {}

    @cached_property
    def exact(self):
        """The tokenizers library's own encoder; loaded when first needed."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def _merge(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids, in a row, of chunks of common Latin letters."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), " ")[0].as_py()
        words = _WORDS.findall(joined.lower())
        ids = np.array(self.merger.encode_ordinary("\0".join(words) + "\0") if words else [], np.uint32)
        gaps = ids == self.gap  # one between two chunks
        ends = np.append(np.flatnonzero(gaps), len(ids))
        return np.diff(ends, prepend=-1) - 1, ids[~gaps]

    def _exact_ids(self, chunk: str) -> np.ndarray:
        """Ids of any chunk, by the library; a bounded number is remembered."""
        if (known := self.odd.get(chunk)) is None:
            if len(self.odd) >= ODD_CHUNKS:
                self.odd.clear()
            known = self.odd[chunk] = np.array(self.exact.encode(chunk, add_special_tokens=False).ids, np.uint32)
        return known

    def _chunk_ids(self, chunks: pa.Array) -> pa.ListArray:
        """The ids of every chunk."""
        plain = pc.and_not(pc.match_substring_regex(chunks, f"^{_PLAIN_CHUNK}*$"), pc.match_substring(chunks, "<|"))
        if not len(chunks) or pc.all(plain).as_py():
            sizes, flat = self._merge(chunks) if len(chunks) else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
        else:
            is_plain = plain.to_numpy(zero_copy_only=False)
            others = list(map(self._exact_ids, chunks.filter(pc.invert(plain)).to_pylist()))
            some, ids = self._merge(chunks.filter(plain)) if is_plain.any() else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
            sizes = np.zeros(len(chunks), np.int64)
            sizes[is_plain], sizes[~is_plain] = some, [len(i) for i in others]
            of_plain = np.repeat(is_plain, sizes)
            flat = np.empty(len(of_plain), np.uint32)
            flat[of_plain], flat[~of_plain] = ids, np.concatenate(others)
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat)

    def encode_many(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text (UTF-8).

        The chunks of all texts are numbered at once, every different chunk is
        encoded once, and the ids are gathered by number."""
        if not texts:
            return []
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string(), safe=False))
        coded = split.values.dictionary_encode()
        of_chunk, places = self._chunk_ids(coded.dictionary), coded.indices
        flat = of_chunk.take(places).flatten().to_numpy()
        sizes = np.diff(of_chunk.offsets.to_numpy())[places.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy()]
        return [flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text.encode()])[0]

    def decode(self, ids: np.ndarray) -> str:
        return decode(self.tokens, ids)

    # -- tree concatenation ---------------------------------------------------

    def leaves(self, text: str, size: int = LEAF) -> list[str]:
        """Parts of about ``size`` code points.  Cuts are made only before an
        ASCII character, which no normal form joins to what stands before,
        and never inside a special token."""
        cuts, at = [0], size
        marks = [(m.start(), m.end()) for s in self.specials
                 for m in re.finditer(re.escape(s.decode()), text)]
        while at < len(text):
            if (m := _ASCII.search(text, at)) is None:
                break
            at = m.start()
            if inside := [e for s, e in marks if s < at < e]:
                at = inside[0]
                continue
            cuts.append(at)
            at += size
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]

    def _spans(self, ids: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(self.surface[ids]) - cut
        return ends - self.surface[ids], ends

    def _agreement(self, a: np.ndarray, a_cut: int, b: np.ndarray, b_cut: int, last: bool) -> tuple[int, int] | None:
        """Places (i, j) where a[i:i+2] and b[j:j+2] are the same tokens of the
        same text; the last such pair, or the first."""
        (a0, a1), (b0, b1) = self._spans(a, a_cut), self._spans(b, b_cut)
        key = lambda ids, s, e: list(zip(s.tolist(), e.tolist(), ids.tolist(), strict=True))
        ka, kb = key(a, a0, a1), key(b, b0, b1)
        at = {k: i for i, k in enumerate(ka)}
        hits = [(at[kb[j]], j) for j in range(len(kb) - 1)
                if kb[j] in at and at[kb[j]] + 1 < len(ka) and ka[at[kb[j]] + 1] == kb[j + 1]]
        return hits[-1 if last else 0] if hits else None

    def join(self, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
        """The encoding of left's text + right's text from those of both."""
        (lt, li), (rt, ri) = left, right
        whole, width = lt + rt, WINDOW
        while width < max(len(lt), len(rt)):
            near_l, near_r = lt[-width:], rt[:width]
            width *= 2
            if not near_l[0].isascii() or any(s.decode()[:2] in near_l + near_r for s in self.specials):
                continue  # not a place where a window may begin
            end = len(near_r)
            while end > 0 and end < len(rt) and not rt[end].isascii():
                end -= 1
            near_r = near_r[:end]
            mid = self.encode(near_l + near_r)
            cut = int(self.surface[self.encode(near_l)].sum())
            tail = li[max(0, len(li) - 2 * width):]
            head = ri[:2 * width]
            a = self._agreement(tail, int(self.surface[tail].sum()), mid, cut, last=False)
            b = self._agreement(head, 0, mid, cut, last=True)
            if a and b and a[1] + 1 <= b[1]:
                return whole, np.concatenate(
                    [li[:len(li) - len(tail) + a[0]], mid[a[1]:b[1]], ri[b[0]:]])
        return whole, self.encode(whole)

    def concatenate(self, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
        """Joins neighbours pairwise, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0][1] if parts else np.zeros(0, np.uint32)


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One encoder for a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows of at most about ``most`` bytes together."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def text_slices(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[slice, list[bytes]]]:
    """A batch's texts as UTF-8 bytes, about ``most`` bytes at a time."""
    texts = column.cast(pa.binary())
    if len(texts):
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        for s in slices(np.diff(bounds), most):
            yield s, texts.slice(s.start, s.stop - s.start).to_pylist()


#: makes columns of texts' ids
Finish = Callable[[list[np.ndarray]], dict[str, pa.Array]]


def raw_ids(ids: list[np.ndarray]) -> dict[str, pa.Array]:
    """``ids`` binary: little-endian unsigned 32-bit."""
    return {"ids": pa.array([i.tobytes() for i in ids], pa.binary())}


def encode_documents(docs: DataFrame, path: str, leaf: int = LEAF, finish: Finish = raw_ids,
                     columns: str = "ids binary") -> DataFrame:
    """(row, doc_id, ...) of every row; ``finish`` turns ids into ``columns``.

    Null and empty texts have no ids.  Texts over ``leaf`` code points are cut
    into leaves spread over tasks, and concatenated by row.  ``row`` numbers
    the rows uniquely, so repeated rows stay apart.
    """
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    short = rows.where(F.char_length("text") <= leaf)
    long = rows.where(F.char_length("text") > leaf)

    def whole(batches):
        bpe = load(path)
        for b in batches:
            for s, texts in text_slices(b.column("text"), TOGETHER):
                yield pa.RecordBatch.from_pydict(
                    {c: b.column(c).slice(s.start, len(texts)) for c in ("row", "doc_id")} | finish(bpe.encode_many(texts)))

    def cut(batches):
        bpe = load(path)
        for b in batches:
            for row, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                parts = bpe.leaves(text, leaf)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row] * len(parts), pa.int64()), "doc_id": pa.array([doc_id] * len(parts), pa.int64()),
                    "part": pa.array(range(len(parts)), pa.int32()), "text": pa.array(parts, pa.string())})

    def encode_parts(batches):
        bpe = load(path)
        for b in batches:
            for s, texts in text_slices(b.column("text"), TOGETHER):
                yield pa.RecordBatch.from_pydict(
                    {c: b.column(c).slice(s.start, len(texts)) for c in ("row", "doc_id", "part", "text")} | raw_ids(bpe.encode_many(texts)))

    def concatenate(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        ids = load(path).concatenate([(t, np.frombuffer(i, np.uint32)) for t, i in zip(part.text, part.ids, strict=True)])
        made = {c: a.to_pandas() for c, a in finish([ids]).items()}
        return pd.DataFrame({"row": part.row.iloc[:1].to_numpy(), "doc_id": part.doc_id.iloc[:1].astype("Int64").array} | made)

    out = f"row long, doc_id long, {columns}"
    leaves = long.mapInArrow(cut, "row long, doc_id long, part int, text string") \
        .repartition("row", "part") \
        .mapInArrow(encode_parts, "row long, doc_id long, part int, text string, ids binary")
    return short.mapInArrow(whole, out).unionByName(leaves.groupBy("row").applyInPandas(concatenate, out))


def round_trip(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """(row, doc_id, ids array, decoded text): texts encoded and decoded again."""

    def both(ids: list[np.ndarray]) -> dict[str, pa.Array]:
        tokens, sizes = load(path).tokens, [len(i) for i in ids]
        return {"ids": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                                                np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)),
                "decoded": pa.array([decode(tokens, i) for i in ids], pa.string())}

    return encode_documents(docs, path, leaf, both, "ids array<int>, decoded string")
