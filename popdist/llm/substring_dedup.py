"""Substring dedup: words covered by windows that an earlier document has.

1. Each window of ``window`` words picks the k-word sequence with the least
   hash as its seed, so equal windows pick equal seeds.  A seed's segment is
   the words of all windows that hold it.
2. Only segments of seeds in two or more documents go on; equal segments
   collapse into one with its smallest document.
3. Segments are dealt to shards by seed.  A shard builds an FM-index over its
   segments and streams the documents' segments through it by backward search;
   every window gets the smallest document that holds it.
4. A seed with very many different segments (a common passage in ever other
   contexts) would fill one shard: its windows are grouped by content instead.
5. Documents collect the intervals of windows found in earlier documents.

Words are compared by 64-bit hashes; a segment's name has 128 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import text_slices
from popdist.llm.common import bucket, staged

WINDOW = 50
SEED_WORDS = 10
#: different segments of a seed beyond which its windows are grouped by
#: content instead; bounds what one seed adds to an index to about 3 million
#: words, or 300 MB while it is built
WIDE = 32_768
#: segments of a shard's index, about
SHARD_SEGMENTS = 3_000
#: stands for a null doc_id: never earlier than another document
LAST_ID = 2 ** 63 - 1
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def split_words(text: bytes) -> list[bytes]:
    return text.split()  # bytes.split(): space, tab, \n, \v, \f, \r


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _powers(m: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, m)]), dtype=np.uint64)


class SpanHash:
    """128-bit hashes of any spans of a row of words, modulo 2 ** 64 twice."""

    def __init__(self, h: np.ndarray):
        self.sums, self.inverse = [], []
        for m in _M:
            p = _powers(m, len(h))
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(h * p[:-1], dtype=np.uint64)]))
            self.inverse.append(_powers(np.uint64(pow(int(m), -1, 2 ** 64)), len(h)))

    def of(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        size = (b - a).astype(np.uint64)
        return [(s[b] - s[a]) * i[a] + size for s, i in zip(self.sums, self.inverse, strict=True)]


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over each run of ``width`` values."""
    out, done = x, 1
    while 2 * done <= width:
        out, done = op(out[:-done], out[done:]), 2 * done
    rest = width - done
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def seeds(h: np.ndarray, doc: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, seed hashes) of the seeds of all windows inside one document;
    ``h``: word hashes of documents in a row, ``doc``: their document."""
    if len(h) < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, np.uint64)
    grams = SpanHash(h).of(np.arange(len(h) - k + 1), np.arange(k, len(h) + 1))[0]
    grams = (grams ^ (grams >> np.uint64(32))) * _M[1]
    grams = (grams ^ (grams >> np.uint64(29))) | np.uint64(1)
    span = window - k + 1
    least = sliding(np.minimum, grams, span)
    least[doc[window - 1:] != doc[:len(doc) - window + 1]] = 0  # windows over a border choose nothing
    pad = np.zeros(span - 1, np.uint64)
    chosen = sliding(np.maximum, np.concatenate([pad, least, pad]), span) == grams
    at = np.flatnonzero(chosen)
    return at, grams[at]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k, th): k and th name a document, also where ids repeat
    or are missing; th is 128 bits of the text, so that different texts of the
    many rows without doc_id do not meet."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("k"),
                       F.unhex(F.md5(text)).alias("th"))


def _squeezed(docs: DataFrame, others: str = "doc_id long, k long, th binary") -> DataFrame:
    """The columns ``others``, and z: the texts compressed before they are shuffled."""
    names = [c.split()[0] for c in others.split(", ")]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            for s, texts in text_slices(b.column("text")):
                yield pa.RecordBatch.from_pydict(
                    {c: b.column(c).slice(s.start, len(texts)) for c in names}
                    | {"z": pa.array([pack(t) for t in texts], pa.binary())})

    return docs.select(*names, "text").mapInArrow(run, f"{others}, z binary")


def _rows_of(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their document's place, and where documents begin."""
    count = np.array([len(w) for w in words], dtype=np.int64)
    return word_hashes([x for w in words for x in w]), np.repeat(np.arange(len(words)), count), np.cumsum(count) - count


def occurrences(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(k, th, pos, size, seed, d) of every seed: ``pos`` its segment's start,
    ``d`` the segment's hash; seed and d together name a segment."""

    def run(batches):
        for b in batches:
            for s, texts in text_slices(b.column("text")):
                h, doc, first = _rows_of([split_words(t) for t in texts])
                at, seed = seeds(h, doc, window, k)
                if not len(at):
                    continue
                owner = doc[at]
                last = np.append(first[1:], len(h))[owner]
                a, e = np.maximum(first[owner], at - (window - k)), np.minimum(last, at + window)
                d = SpanHash(h).of(a, e)[1]
                pick = pa.array(owner + s.start)
                yield pa.RecordBatch.from_pydict({
                    "k": b.column("k").take(pick), "th": b.column("th").take(pick),
                    "pos": pa.array((a - first[owner]).astype(np.int32)), "seed": pa.array(seed.view(np.int64)),
                    "d": pa.array(d.view(np.int64)), "size": pa.array((e - a).astype(np.int32))})

    return docs.select("k", "th", "text").mapInArrow(run, "k long, th binary, pos int, seed long, d long, size int")


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of one copy of each wanted segment: (seed, d, least, wide, alone, words)."""
    names = ("seed", "d", "least", "wide", "alone")
    by_doc = wanted.groupBy("rep.k", "rep.th").agg(F.collect_list(F.struct(
        F.col("rep.pos").alias("pos"), "size", *names)).alias("parts"))  # of one document
    schema = pa.schema([*((n, pa.bool_() if n in ("wide", "alone") else pa.int64()) for n in names), ("words", pa.binary())])

    def run(batches):
        for b in batches:
            for z, parts in zip(b.column("z"), b.column("parts"), strict=True):
                h = word_hashes(split_words(zstandard.decompress(z.as_py())))
                parts = parts.values.flatten()
                pos, size = parts[0].to_pylist(), parts[1].to_pylist()
                words = [h[p:p + n].tobytes() for p, n in zip(pos, size, strict=True)]
                yield pa.RecordBatch.from_arrays([*parts[2:], pa.array(words, pa.binary())], schema=schema)

    joined = _squeezed(docs).drop("doc_id").join(by_doc, ["k", "th"]).select("z", "parts")
    return joined.mapInArrow(run, "seed long, d long, least long, wide boolean, alone boolean, words binary")


def _runs(row: np.ndarray) -> list[dict]:
    """[{a, b, m}]: windows a..b of a segment, whose smallest document is m."""
    cut = np.flatnonzero(np.diff(row)) + 1
    return [{"a": int(a), "b": int(b) - 1, "m": int(row[a])}
            for a, b in zip([0, *cut], [*cut, len(row)], strict=True)] if len(row) else []


RUNS = "array<struct<a:int,b:int,m:long>>"


def search_shards(segments: DataFrame, shards: int, window: int) -> DataFrame:
    """(seed, d, least, runs, windows): runs by an FM-index per shard; for wide
    seeds, whose segments are dealt one by one, the hashes of their windows
    (equal windows have equal seeds, so seed and hash together name one)."""
    from popdist.llm.fmindex import FmIndex

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["seed", "d"]).reset_index(drop=True)
        rows = [np.frombuffer(w, np.uint64) for w in part.words]
        out = part[["seed", "d", "least"]].copy()
        if part.wide.iloc[0]:
            out["runs"] = None
            out["windows"] = [SpanHash(h).of(np.arange(len(h) - window + 1), np.arange(window, len(h) + 1))[0].view(np.int64) for h in rows]
        else:
            lengths, words = np.array([len(r) for r in rows]), np.concatenate(rows)
            least, mask = FmIndex(words, lengths, part.least.to_numpy(), window).least_owner(words, lengths)
            out["runs"] = [_runs(r[m]) for r, m in zip(least, mask, strict=True)]
            out["windows"] = None
        return out

    # a seed that fills a shard has one of its own, so no shard holds two of them
    shard = F.when(F.col("wide"), shards + bucket(shards, "seed", "d")).otherwise(bucket(shards, "seed"))
    own = F.when(F.col("alone") & ~F.col("wide"), F.col("seed"))
    return segments.withColumn("shard", shard).withColumn("own", own).groupBy("shard", "own").applyInPandas(
        search, f"seed long, d long, least long, runs {RUNS}, windows array<long>")


def group_windows(wide: DataFrame) -> DataFrame:
    """(seed, d, runs) from the window hashes of ``wide`` segments."""
    windows = staged(wide.select("seed", "d", "least", F.posexplode("windows").alias("a", "w")), "substring-windows")
    least = staged(windows.groupBy("seed", "w").agg(F.min("least").alias("m")), "substring-window-least")
    return windows.join(least, ["seed", "w"]).groupBy("seed", "d").agg(
        F.collect_list(F.struct("a", F.col("a").alias("b"), "m")).alias("runs"))  # one segment's windows


def repeated_intervals(docs: DataFrame, window: int = WINDOW, k: int = SEED_WORDS, wide: int = WIDE) -> DataFrame:
    """(k, th, spans array<struct<a,b>>): word intervals to remove, by document."""
    found = staged(occurrences(docs, window, k), "substring-seeds")
    shared = staged(found.groupBy("seed").agg(F.min("k").alias("x"), F.max("k").alias("y")).where("x < y").select("seed"), "substring-shared")
    found = staged(found.join(shared, "seed"), "substring-found")
    segments = staged(
        found.groupBy("seed", "d", "size").agg(F.min("k").alias("least"), F.min(F.struct("k", "th", "pos")).alias("rep")), "substring-segments")
    width = staged(segments.groupBy("seed").agg(F.count("*").alias("n")), "substring-width")
    segments = staged(segments.join(width, "seed"), "substring-wanted")
    several = segments.where("n > 1").withColumn("wide", F.col("n") > wide).withColumn("alone", F.col("n") > SHARD_SEGMENTS)
    n = several.where("not wide").count()
    searched = staged(search_shards(fetch(docs, several), max(64, -(-n // SHARD_SEGMENTS)), window), "substring-searched")
    # a seed with one segment needs no search: all its windows start in that segment's documents
    alone = segments.where("n = 1").select("seed", "d", F.array(F.struct(
        F.lit(0).alias("a"), (F.col("size") - window).alias("b"), F.col("least").alias("m"))).alias("runs"))
    results = alone.unionByName(searched.where("windows is null").select("seed", "d", "runs")) \
        .unionByName(group_windows(searched.where("windows is not null")))
    hits = found.join(staged(results, "substring-results"), ["seed", "d"]).select(
        "k", "th", F.transform(
            F.filter("runs", lambda r: r["m"] < F.col("k")),
            lambda r: F.struct((F.col("pos") + r["a"]).alias("a"), (F.col("pos") + r["b"] + window).alias("b"))).alias("s")) \
        .where(F.size("s") > 0)
    return hits.groupBy("k", "th").agg(F.flatten(F.collect_list("s")).alias("spans"))  # of one document


def dedup_substrings(docs: DataFrame, window: int = WINDOW, k: int = SEED_WORDS, wide: int = WIDE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row.

    Words: ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes when a window of
    ``window`` words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input.  Null texts have no words; a null
    doc_id counts as larger than all others; rows that repeat a doc_id are not
    earlier than each other.  ``kept``: the words left, one space between.
    """
    keyed = _keyed(docs)
    spans = staged(repeated_intervals(keyed, window, k, wide), "substring-spans")

    def run(batches):
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for z, found in zip(b.column("z"), b.column("spans"), strict=True):
                words = split_words(zstandard.decompress(z.as_py()))
                n_words.append(len(words))
                if found.is_valid:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, found.values.field("a").to_numpy(), 1)
                    np.add.at(edge, found.values.field("b").to_numpy(), -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [w for w, x in zip(words, stay.tolist(), strict=True) if x]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return _squeezed(keyed).join(spans, ["k", "th"], "left").select("doc_id", "z", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")
