import heapq
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from popdist.llm.sharding import deal_equal, shard_documents

SMALL = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=8), st.integers(1, 9), st.integers(0, 90))
def test_bulk_dealing_equals_one_by_one(loads, weight, count):
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    single, given_to = list(heap), dict.fromkeys(range(len(loads)), 0)
    for _ in range(count):
        x, s = single[0]
        heapq.heapreplace(single, (x + weight, s))
        given_to[s] += 1
    assert deal_equal(heap, weight, count) == given_to and sorted(heap) == sorted(single)


def check(docs, shards):
    rows = shard_documents(docs, shards).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    assert len(rows) == sum(map(len, texts.values()))
    slots, shard_of, load = defaultdict(list), {}, [0] * shards
    for r in rows:
        crcs = {zlib.crc32(t.encode()): t for t in texts[r.doc_id]}
        assert r.size == len(crcs[r.text_crc32].encode()) + 16 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault(crcs[r.text_crc32], r.shard) == r.shard
        load[r.shard] += r.size
    for got in slots.values():
        assert sorted(got) == list(range(len(got)))
    return load


def test_documents(spark):
    load = check(spark.read.parquet(f"{SMALL}/documents.parquet"), 10)
    assert max(load) <= 1.001 * sum(load) / len(load)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, 4)
    assert shard_documents(no_docs, 4).count() == 0
