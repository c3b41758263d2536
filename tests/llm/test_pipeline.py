"""The pipeline against a plain chain over the same rows."""

from collections import Counter

import corpus_pipeline
import pytest
from popdist.llm import common, quality
from popdist.llm.crf import line_features
from popdist.llm.secret_scan import scan
from tests_llm_helpers import check_pieces, linked_classes, low

SMALL = "/root/testdata/sf0.001"


def chain(spark, docs, path):
    """Rows that stay after each of the first three stages, and the texts."""
    model = quality.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scores = model.score(line_features([(t or "").encode() for _, t in rows]))
    good = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    last = {}
    for i, t in good:
        last[low(t)] = max(i, last.get(low(t), -1))
    unique = [(i, t) for i, t in good if last[low(t)] == i]
    classes = linked_classes(unique)
    return good, unique, [(i, t) for i, t in unique if classes[i] == i]


def test_stages_and_run(spark, path):
    from popdist.llm.bpe import load

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    wanted = chain(spark, docs, path)
    now = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], wanted):
        now = corpus_pipeline.staged(stage(spark, now, SMALL), name)
        assert now.columns == docs.columns
        assert Counter((r.doc_id, r.text) for r in now.collect()) == Counter(want), name
    clean = corpus_pipeline.staged(corpus_pipeline.secrets(spark, now, SMALL), "secrets")
    assert clean.columns == docs.columns and clean.count() == now.count()
    assert all(not [s for s in r.spans if s.kind in ("assign", "access", "hex")] for r in scan(clean).collect())
    coder = load(path)
    ids = {r.doc_id: [*coder.exact.encode(r.text or "", add_special_tokens=False).ids, 2] for r in clean.collect()}
    assert check_pieces(corpus_pipeline.run(spark, SMALL).collect(), ids, 4096) == 0


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for some in (docs, docs.where("false")):
        assert corpus_pipeline.quality(spark, some, SMALL).columns == docs.columns
        assert corpus_pipeline.quality(spark, some, SMALL).count() <= some.count()
        now = some  # the classifier may reject them all, so the others start anew
        for name, stage in corpus_pipeline.STAGES[1:]:
            now = corpus_pipeline.staged(stage(spark, now, SMALL), name)
            if name != "packing":
                assert now.columns == docs.columns
        assert (now.count() > 0) == (some is docs)


@pytest.mark.parametrize("broadcast", [10, 0])
def test_columns_of_any_name_keep_their_values(spark, monkeypatch, broadcast):
    """Columns that are called like the operators' own, with rows dropped by a
    broadcast and by a shuffle."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rows = [(i, text, "en", "s", 5, 77 + i, f"m{i}", f"x{i}") for i, text in enumerate(
        ["one text here", "ONE text here", None, "", 'token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"', "é 中文 text", "another text"])]
    names = "doc_id long, text string, lang string, source string, n_chars long, _row long, _masked string, _row1 string"
    docs = spark.createDataFrame(rows, names)
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup, corpus_pipeline.secrets, corpus_pipeline.quality):
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        kept = {r.doc_id: r for r in got.collect()}
        assert all((r._row, r._masked, r._row1) == rows[i][5:] for i, r in kept.items())
        if stage in (corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup):
            assert {i: r.text for i, r in kept.items()} == {
                r[0]: r[1] for r in rows if r[0] != (0 if stage is corpus_pipeline.exact_dedup else 1)
                and not (r[0] == 2 and stage is corpus_pipeline.exact_dedup)}


def test_staged_tables_are_freed(spark, tmp_path):
    with common.freed(spark) as keep:
        a = common.staged(spark.range(5), "freed-a")
        b = keep(common.staged(a.where("id > 2"), "freed-b"))
    assert sorted(r.id for r in b.collect()) == [3, 4]
    with pytest.raises(Exception):
        spark.read.parquet(a.staged_path).count()
    with common.freed(spark) as keep:
        with common.freed(spark) as inner:
            c = inner(common.staged(spark.range(3), "freed-c"))
        assert c.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(c.staged_path).count()
    assert common.unused(["_ROW", "_row1"], "_row") == "_row2"
