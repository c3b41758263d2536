import hashlib

import numpy as np
import pytest

from popdist.llm.exact_dedup import dedup, keep_first_copies
from popdist.llm.fuse import BinaryFuse

SMALL = "/root/testdata/sf0.001"


def low(text):
    return (text or "").encode().lower()


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    return {(i, low(t)): (max((x for x in groups[low(t)] if x is not None), default=None), len(groups[low(t)]),
                          hashlib.sha256(low(t)).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300, 20_000])
def test_fuse_filter_has_no_false_negative_and_few_false_positives(n):
    r = np.random.default_rng(n)
    keys = r.integers(0, 2 ** 63, n).astype(np.uint64)
    f = BinaryFuse.from_row(*BinaryFuse.build(keys).to_row())
    assert f.might_contain(keys).all()
    assert f.might_contain(r.integers(0, 2 ** 63, 20_000).astype(np.uint64)).mean() < 0.01


def check(spark, docs, **more):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    got = dedup(docs, **more).collect()
    assert len(got) == len(rows)
    by_sha = {v[2]: v for v in want.values()}
    for g in got:
        assert (g.keep_id, g.group_size, g.text_sha256) == by_sha[g.text_sha256]
    assert sum(g.kept for g in got) == len({low(t) for _, t in rows})


def test_odd_rows(spark, odd_docs):
    check(spark, odd_docs)


def test_colliding_digests_are_told_apart_by_their_bytes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    check(spark, docs, digest_bytes=1)


def test_split_into_snapshot_and_batch_does_not_matter(spark, odd_docs):
    from pyspark.sql import functions as F

    for split in (F.lit(True), F.lit(False), F.col("k") > 2):
        check(spark, odd_docs, in_snapshot=split)


def test_empty(no_docs):
    assert dedup(no_docs).count() == 0


def test_stage_keeps_columns_and_one_row_of_each_text(odd_docs):
    kept = keep_first_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [low(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({low(r.text) for r in odd_docs.collect()})


def test_stage_keeps_one_row_of_each_text_without_id(spark):
    rows = [(None, f"text {i % 4}") for i in range(12)] + [(None, "alone"), (None, "Text 0"), (None, None), (None, "")]
    rows += [(i, f"both {i % 2}") for i in range(6)] + [(None, "both 0"), (None, "BOTH 1")]
    kept = keep_first_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(low(r.text) for r in kept) == sorted({low(t) for _, t in rows})
    assert {(r.doc_id, r.text) for r in kept if r.doc_id is not None} == {(4, "both 0"), (5, "both 1")}


def test_stage_with_a_hot_null_id(spark):
    from pyspark.sql import functions as F

    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.concat(F.lit("t"), (F.col("id") / 6).cast("long").cast("string")).alias("text"))
    kept = keep_first_copies(docs).collect()
    assert len(kept) == len({r.text for r in kept}) == 5_000
    assert all(r.doc_id is not None for r in kept)
