"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to ``OWNERS`` owners by document frequency,
rarest first.  Items travel in bundles.  A bundle meets each block of
documents once per owner: a cogroup brings the bundle, its sparse accumulators
for that block, and the owner's postings of the block together, adds whole
numbers, and hands the accumulators on to the next owner.  The last owner
returns the block's best rows of every item, and a ranking per item picks the
final ones.

No term's postings meet in one place: a frequent term is cut by block, and
blocks hold about the same number of postings.  An accumulator is given up
only when the postings still to come cannot lift it to the score of the k-th
document of its own block, so the result is exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popdist.llm.common import bucket, buckets_for, running, staged

#: terms of lower-cased UTF-8 text: digits, a-z and every non-ASCII character
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: slots of the filter over the items' terms: 4 MB for any number of terms
SLOTS = 1 << 22
#: owner of a term: the first whose share of the documents reaches the term's
SHARES = (256, 32, 4)
OWNERS = len(SHARES) + 1
BUNDLE = 256
POSTINGS_PER_BLOCK = 400_000

_POSTING = np.dtype([("owner", "<i4"), ("term", "<i4"), ("doc", "<i4"), ("impact", "<i4")])
_WEIGHT = np.dtype([("owner", "<i4"), ("item", "<i4"), ("term", "<i4"), ("weight", "<i8"), ("most", "<i8")])
_SUM = np.dtype([("item", "<i4"), ("doc", "<i4"), ("score", "<i8")])


def _slots(items: DataFrame) -> bytes:
    """One byte per slot, 1 where some item's term has its checksum."""
    taken = items.select(F.explode("terms").alias("t")).select(
        F.pmod(F.crc32(F.encode("t", "utf-8")), F.lit(SLOTS)).cast("int").alias("s")).distinct()
    out = np.zeros(SLOTS, np.uint8)
    out[taken.toArrow().column("s").to_numpy()] = 1  # at most SLOTS numbers
    return out.tobytes()


def _forward(batches: Iterator[pa.RecordBatch], slots: bytes):
    """Length of every text, and its terms that may belong to an item."""
    mask = SLOTS - 1
    for b in batches:
        sizes, terms, counts, ends = [], [], [], [0]
        for text in b.column("text").cast(pa.binary()):
            found = Counter(_TERM.findall((text.as_py() or b"").lower()))  # bytes.lower(): A-Z only
            sizes.append(sum(found.values()))
            for t, n in found.items():
                if slots[zlib.crc32(t) & mask]:
                    terms.append(t)
                    counts.append(n)
            ends.append(len(terms))
        cut = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_pydict({
            "row": b.column("row"), "doc_id": b.column("doc_id"), "n": pa.array(sizes, pa.int64()),
            "terms": pa.ListArray.from_arrays(cut, pa.array(terms, pa.binary()).cast(pa.string())),
            "counts": pa.ListArray.from_arrays(cut, pa.array(counts, pa.int64()))})


def _pack_block(table: pa.Table) -> pa.Table:
    """One row per owner of a block: its postings, over document places that
    follow (doc_id, row), so that places break ties like ids do."""
    col = lambda c: table.column(c).combine_chunks()
    rows = col("row").to_numpy()
    ids = col("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy()
    first, place = np.unique(rows, return_index=True)
    order = np.lexsort((first, number[place], ~known[place]))
    rank = np.empty(len(first), np.int32)
    rank[order] = np.arange(len(first), dtype=np.int32)
    postings = np.empty(len(rows), _POSTING)
    postings["owner"], postings["term"] = col("owner").to_numpy(), col("term").to_numpy()
    postings["impact"] = col("impact").to_numpy()
    postings["doc"] = rank[np.searchsorted(first, rows)]
    postings = postings[np.lexsort((postings["doc"], postings["term"], postings["owner"]))]
    at = np.searchsorted(postings["owner"], np.arange(OWNERS + 1))
    docs = pa.array(number[place][order], mask=~known[place][order]).to_pylist()
    block = col("block")[0].as_py()
    rest = [None] * (OWNERS - 1)  # only the last owner names documents
    return pa.table({
        "block": pa.array([block] * OWNERS, pa.int32()), "owner": pa.array(range(OWNERS), pa.int32()),
        "postings": pa.array([postings[at[o]:at[o + 1]].tobytes() for o in range(OWNERS)], pa.binary()),
        "n_docs": pa.array([len(first)] * OWNERS, pa.int32()),
        "docs": pa.array([*rest, docs], pa.list_(pa.int64())),
        "rows": pa.array([*rest, first[order].tolist()], pa.list_(pa.int64()))})


def _pack_bundle(table: pa.Table) -> pa.Table:
    """A bundle's terms with weights in one row, by owner, item and term."""
    out = np.empty(table.num_rows, _WEIGHT)
    for c in _WEIGHT.names:
        out[c] = table.column(c).combine_chunks().to_numpy()
    out = out[np.lexsort((out["term"], out["item"], out["owner"]))]
    return pa.table({"bundle": table.column("bundle").slice(0, 1), "weights": pa.array([out.tobytes()], pa.binary())})


def _add(left: pa.Table, right: pa.Table, owner: int, k: int):
    """The accumulators of one bundle over one block after ``owner``, as
    (item, doc, score) records; the block's row; None where it has nothing."""
    weights = np.frombuffer(left.column("weights")[0].as_py(), _WEIGHT)
    sums = np.frombuffer(zlib.decompress(left.column("sums")[0].as_py()), _SUM)
    if not right.num_rows:
        return sums, None
    block = right.slice(0, 1)
    n_docs = block.column("n_docs")[0].as_py()
    postings = np.frombuffer(block.column("postings")[0].as_py(), _POSTING)
    term, doc, impact = postings["term"].copy(), postings["doc"].copy(), postings["impact"].astype(np.int64)
    mine = weights[weights["owner"] == owner]
    lo, hi = np.searchsorted(term, mine["term"], "left"), np.searchsorted(term, mine["term"], "right")
    left_over = weights[weights["owner"] > owner]
    items = np.unique(weights["item"])
    more = np.zeros(len(items), np.int64)
    np.add.at(more, np.searchsorted(items, left_over["item"]), left_over["most"])
    kept = []
    for item, rest in zip(items.tolist(), more.tolist()):
        score = np.zeros(n_docs, np.int64)
        old = sums[np.searchsorted(sums["item"], item, "left"):np.searchsorted(sums["item"], item, "right")]
        score[old["doc"]] = old["score"]
        for i in range(*np.searchsorted(mine["item"], [item, item + 1])):
            at = slice(lo[i], hi[i])
            score[doc[at]] += mine["weight"][i] * impact[at]  # a term has a document once
        alive = np.flatnonzero(score)
        if len(alive) > k:
            worst = np.partition(score[alive], -k)[-k]
            alive = alive[score[alive] + rest >= worst]
        part = np.empty(len(alive), _SUM)
        part["item"], part["doc"], part["score"] = item, alive, score[alive]
        kept.append(part)
    return (np.concatenate(kept) if kept else sums[:0]), block


def _pass_on(owner: int, k: int):
    """Cogroup function of every owner but the last."""
    def stage(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        sums, _ = _add(left, right, owner, k)
        return left.set_column(left.schema.get_field_index("sums"), "sums",
                               pa.array([zlib.compress(sums.tobytes(), 1)], pa.binary()))
    return stage


def _choose(owner: int, k: int):
    """Cogroup function of the last owner: the block's k best of every item."""
    def stage(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows:
            sums, block = _add(left, right, owner, k)
        if not left.num_rows or block is None or not len(sums):
            none = np.empty(0, np.int64)
            return pa.table({c: pa.array(none) for c in ("item", "doc_id", "row", "score")})
        sums = sums[np.lexsort((sums["doc"], -sums["score"], sums["item"]))]
        place = np.arange(len(sums)) - np.searchsorted(sums["item"], sums["item"])
        sums = sums[place < k]
        take = pa.array(sums["doc"].astype(np.int64))
        base = left.column("bundle")[0].as_py() * BUNDLE
        return pa.table({
            "item": pa.array(sums["item"].astype(np.int64) + base),
            "doc_id": block.column("docs")[0].values.take(take), "row": block.column("rows")[0].values.take(take),
            "score": pa.array(sums["score"].astype(np.int64))})
    return stage


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): items numbered without gaps, terms once each."""
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = staged(items.select(
        F.monotonically_increasing_id().alias("u"), F.col("item_id").cast("long").alias("item_id"),
        F.array_distinct(F.regexp_extract_all(low, F.lit(TERM_PATTERN), 0)).alias("terms")), "search-items")
    return staged(running(rows, [], "u", buckets_for(rows.count(), least=1), F.lit(1), "item").drop("u"),
                  "search-numbered")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item.

    Null texts have no terms, documents without terms no score.  Every row is
    a document and every row of ``items`` an item, repeated ids included;
    equal scores go by ascending doc_id, null ids last.  Empty tables give
    no rows.  Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    found = "item_id long, rank int, doc_id long, score long"
    asked = item_terms(items)
    slots = spark.sparkContext.broadcast(_slots(asked))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    forward = staged(texts.mapInArrow(
        lambda it: _forward(it, slots.value),
        "row long, doc_id long, n long, terms array<string>, counts array<long>"), "search-forward")
    n_docs, length = forward.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    wanted = asked.select("item", F.explode("terms").alias("word"))
    if not n_docs or wanted.isEmpty():
        return spark.createDataFrame([], found)

    # the words are a table of their own, so Spark sees its size and broadcasts it only when it is small
    words = staged(wanted.select("word").distinct(), "search-words")
    words = staged(running(words, [], "word", buckets_for(words.count(), least=1), F.lit(1), "term")
                   .withColumn("term", F.col("term").cast("int")), "search-terms")
    postings = forward.select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("p")).select(
        "row", "doc_id", F.col("p.terms").alias("word"), F.col("p.counts").alias("tf"),
        F.expr(f"50L + ((50L * n * {n_docs}L) div {length}L)").alias("m")).join(words, "word").select(
        "row", "doc_id", "term", F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)").alias("impact"))
    stats = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("top"))
    owner = F.lit(OWNERS - 1)
    for o in range(OWNERS - 2, -1, -1):
        owner = F.when(F.col("df") * SHARES[o] <= F.lit(n_docs), F.lit(o)).otherwise(owner)
    terms = staged(stats.select(
        "term", owner.alias("owner"), "top", "df",
        F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight")),
        "search-weights")

    total = terms.agg(F.sum("df")).first()[0]
    if not total:
        return spark.createDataFrame([], found)
    n_blocks = max(1, -(-total // POSTINGS_PER_BLOCK))
    blocks = staged(
        postings.join(terms.select("term", "owner"), "term").select(
            bucket(n_blocks, "row").alias("block"), "row", "doc_id", "owner", "term", F.col("impact").cast("int").alias("impact"))
        .groupBy("block").applyInArrow(
            _pack_block, "block int, owner int, postings binary, n_docs int, docs array<long>, rows array<long>"), "search-blocks")
    bundles = wanted.join(words, "word").join(terms, "term").select(
        F.expr(f"cast(item div {BUNDLE} as int)").alias("bundle"), F.expr(f"cast(item % {BUNDLE} as int)").alias("item"),
        "owner", "term", "weight", (F.col("weight") * F.col("top")).alias("most"))
    bundles = staged(bundles.groupBy("bundle").applyInArrow(_pack_bundle, "bundle int, weights binary"), "search-bundles")

    last_bundle = bundles.agg(F.max("bundle")).first()[0]

    # every bundle visits every block, one owner after the other
    state = bundles.select("bundle", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "weights",
                           F.lit(zlib.compress(b"")).alias("sums"))
    for o in range(OWNERS):
        owned = blocks.where(F.col("owner") == o).drop("owner")
        visits = owned.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(last_bundle))))
        told = state.groupBy("bundle", "block").cogroup(visits.groupBy("bundle", "block"))
        last = o == OWNERS - 1
        state = told.applyInArrow(
            (_choose if last else _pass_on)(o, k),
            "item long, doc_id long, row long, score long" if last else "bundle int, block int, weights binary, sums binary")
        if not last:
            state = staged(state, "search-sums")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = state.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
