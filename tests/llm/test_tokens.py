from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from popdist.llm import bpe
from popdist.llm.packing import combinations, make_plan, nnls, pack
from tests_llm_helpers import check_pieces

ALPHABET = ["a", "b", "the", "ing", "'s", "'", "S", "!", "?", " ", "\n", "é", "É", "ß", "1", "22", "İ", "Σ", "中", "́",
            "<|endoftext|>", "<|", " ", "\x00", "\x1c", "e", "한", "😀", "×", "²", "ª", "µ"]
texts = st.lists(st.sampled_from(ALPHABET), max_size=60).map("".join)


@pytest.fixture(scope="module")
def coder(path):
    return bpe.load(path)


@settings(max_examples=300, deadline=None)
@given(text=texts)
def test_encode_and_decode_as_the_library(coder, text):
    ids = coder.exact.encode(text, add_special_tokens=False).ids
    assert coder.encode(text).tolist() == ids
    assert coder.decode(np.array(ids, np.uint32)) == coder.exact.decode(ids, skip_special_tokens=False)


@settings(max_examples=120, deadline=None)
@given(text=st.one_of(texts, st.text("abcdethinorsu", max_size=250), st.text("aab!'s", max_size=250)), leaf=st.integers(5, 60))
def test_tree_concatenation_is_exact(coder, text, leaf):
    parts = coder.leaves(text, leaf)
    assert "".join(parts) == text
    ids = coder.concatenate([(p, coder.encode(p)) for p in parts])
    assert ids.tolist() == coder.exact.encode(text, add_special_tokens=False).ids


def test_join_splices_and_does_not_encode_all_again(coder):
    text = "thisisoneverylongwordwithoutanyspace" * 400
    parts, asked = coder.leaves(text, 4000), []
    done = [(p, coder.encode(p)) for p in parts]
    encode = coder.encode
    coder.encode = lambda t: asked.append(len(t)) or encode(t)
    try:
        ids = coder.concatenate(done)
    finally:
        del coder.encode
    assert ids.tolist() == coder.exact.encode(text, add_special_tokens=False).ids
    assert max(asked) < 1000


@pytest.mark.parametrize("leaf", [50, 100_000])
def test_documents_with_leaves_over_tasks(spark, path, coder, odd_docs, leaf):
    got = bpe.round_trip(odd_docs, path, leaf=leaf).collect()
    want = defaultdict(list)
    for r in odd_docs.collect():
        ids = coder.exact.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id].append((ids, coder.exact.decode(ids, skip_special_tokens=False)))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((list(r.ids), r.decoded))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("window", [64, 4096])
def test_packing(spark, path, coder, window):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: [*coder.exact.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    assert check_pieces(pack(docs, path, window=window).collect(), want, window) == 0


def test_packing_odd_rows(path, odd_docs, no_docs, coder):
    rows = pack(odd_docs, path).collect()
    total = sum(len(coder.exact.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in rows) == total
    assert pack(no_docs, path).count() == 0


def test_least_squares_finds_an_exact_filling():
    combos = combinations(64)
    assert all(sum(a * m for a, m in c) == 64 for c in combos)
    histogram = np.zeros(65)
    histogram[[40, 24, 10]] = 30, 30, 12
    x = nnls(combos, histogram, steps=2000)
    fitted = np.zeros(65)
    for n, c in zip(x, combos):
        for a, m in c:
            fitted[a] += n * m
    assert (x >= 0).all() and abs(fitted[[40, 24]] - 30).max() < 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 40), max_size=12))
def test_plan_places_every_remainder_once(histogram):
    plan = make_plan(histogram, 5, 32)
    spots = defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            for seq, offset, size in plan.place(length, rank):
                spots[seq].append((offset, size))
    for pieces in spots.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == 32 or at & (at - 1) == 0
    assert sum(s for p in spots.values() for _, s in p) == sum(a * n for a, n in histogram.items())
