from collections import Counter, defaultdict

import numpy as np
import pytest

from popdist.llm import common
from popdist.llm import jaccard_join as J
from popdist.llm.components import components
from popdist.llm.fmindex import FmIndex, WaveletMatrix, suffix_order
from popdist.llm.substring_dedup import LAST_ID, dedup_substrings, seeds, sliding
from popdist.llm.vptree import VPTree, nearest
from tests_llm_helpers import linked_classes, low

SMALL = "/root/testdata/sf0.001"


# -- substring dedup ---------------------------------------------------------------


def removed(rows, window):
    """Brute force over (doc_id, text)."""
    first = {}
    split = [(LAST_ID if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            first[key] = min(i, first.get(key, i))
    out = Counter()
    for (doc_id, _), (i, w) in zip(rows, split):
        stay = [True] * len(w)
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                stay[a:a + window] = [False] * window
        kept = [x for x, s in zip(w, stay) if s]
        out[doc_id, len(w), len(w) - len(kept), b" ".join(kept).decode()] += 1
    return out


@pytest.mark.parametrize("wide", [512, 1])
def test_substrings_of_documents(spark, wide):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = Counter(map(tuple, dedup_substrings(docs, wide=wide).collect()))
    want = removed([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert got == want and any(n[2] for n in want)


def test_substrings_with_short_windows_and_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter(map(tuple, dedup_substrings(odd_docs, window=6, k=3).collect()))
    assert got == removed(rows, 6)
    assert dedup_substrings(no_docs).count() == 0


def test_one_word_repeated(spark):
    rows = [(1, "a " * 200), (2, "b " + "a " * 120), (3, "a a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, dedup_substrings(docs).collect())) == removed(rows, 50)


def test_wavelet_rank_and_suffix_order():
    r = np.random.default_rng(3)
    s = r.integers(0, 37, 500)
    w = WaveletMatrix(s, 37)
    c, i = r.integers(0, 37, 300), r.integers(0, 501, 300)
    assert w.rank(c, i).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, i)]
    order, _, _ = suffix_order(s, 4)
    assert order.tolist() == sorted(range(500), key=lambda k: s[k:].tolist())


def test_index_reports_the_smallest_owner():
    r = np.random.default_rng(4)
    rows = [r.integers(0, 3, n).astype(np.uint64) for n in r.integers(5, 30, 60)]
    owner, lengths = r.integers(0, 1000, 60), np.array([len(x) for x in rows])
    least, mask = FmIndex(np.concatenate(rows), lengths, owner, 5).least_owner(np.concatenate(rows), lengths)
    want = defaultdict(lambda: 10 ** 9)
    for x, o in zip(rows, owner):
        for a in range(len(x) - 4):
            want[tuple(x[a:a + 5])] = min(o, want[tuple(x[a:a + 5])])
    for x, got, m in zip(rows, least, mask):
        assert got[m].tolist() == [want[tuple(x[a:a + 5])] for a in range(len(x) - 4)]


def test_equal_windows_choose_equal_seeds():
    r = np.random.default_rng(5)
    h = r.integers(0, 2 ** 63, 90).astype(np.uint64)
    both = np.concatenate([r.integers(0, 2 ** 63, 40).astype(np.uint64), h, r.integers(0, 2 ** 63, 9).astype(np.uint64)])
    alone = set(seeds(h, np.zeros(90, int), 50, 10)[1].tolist())
    assert alone <= set(seeds(both, np.zeros(len(both), int), 50, 10)[1].tolist())
    assert sliding(np.minimum, np.arange(9)[::-1], 4).tolist() == [5, 4, 3, 2, 1, 0]


# -- n-gram Jaccard join -------------------------------------------------------------


def linked(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                links[i].add(j)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in links:
        for j in links[i]:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)].append(d)
    return Counter((d, min(ids[find(i)], default=None), len(links[i])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("block", [1024, 3])
def test_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    r = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(14):
        text = r.choice(words, 60 + 10 * g).tolist()
        for _ in range(3 + 2 * (g % 7)):
            copy = list(text)
            for _ in range(r.integers(0, 5)):
                copy[r.integers(len(copy))] = r.choice(words)
            rows.append((int(r.integers(10 ** 9)), " ".join(copy)))
    rows += [(5, "a b c"), (6, "A b  c"), (7, "a b d"), (8, ""), (9, None), (10, " "), (11, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, J.join(docs).collect())) == linked(rows)


def test_join_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter(map(tuple, J.join(odd_docs).collect()))
    # two rows without doc_id: the one with words is alone in its class
    assert sum(got.values()) == len(rows)
    assert Counter({k: n for k, n in got.items() if k[0] is not None}) == Counter({k: n for k, n in linked(rows).items() if k[0] is not None})
    assert J.join(no_docs).count() == 0
    kept = J.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 7, 8, 9]


def test_rows_without_id_belong_to_their_class(spark):
    text = [" ".join(f"{g}{i}" for i in range(60)) for g in "abcd"]
    near = lambda t, i: f"{t} end{i}"
    rows = [(None, near(text[0], 0)), *((10 + i, near(text[0], i)) for i in range(6)), (None, near(text[0], 9))]
    rows += [(None, near(t, i % 3)) for t in text[1:3] for i in range(5)]  # two classes without any doc_id
    rows += [(11, text[3]), (30, near(text[3], 1)), (None, "")]  # a repeated doc_id in another class
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = defaultdict(Counter)
    for r in J.join(docs).collect():
        classes[r.class_id][r.doc_id] += 1
    named = {c: n for c, n in classes.items() if c >= 0}
    assert named == {10: Counter([None, None, *range(10, 16)]), 11: Counter([11, 30])}
    assert sorted(n[None] for c, n in classes.items() if c < 0) == [1, 5, 5]
    kept = J.keep_one(docs).collect()
    assert sorted(r.text[:2] for r in kept) == ["", "a0", "b0", "c0", "d0"]
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [10, 11]


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_join_stages_no_texts(spark, monkeypatch, broadcast):
    """The documents are not copied; texts are found again by doc_id and text,
    also where rows, doc_ids or texts repeat and where ids are missing."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    seen = {}

    def spy(df, name):
        seen[name] = df.columns
        return staged(df, name)

    staged = common.staged
    monkeypatch.setattr(common, "staged", spy)
    monkeypatch.setattr(J, "staged", spy)
    text = [" ".join(f"{g}{i}" for i in range(60)) for g in "abcd"]
    rows = [(1, f"{text[0]} end0"), (1, f"{text[0]} end0"), (1, f"{text[0]} end1"), (1, text[1]), (2, f"{text[0].upper()} end0")]
    rows += [(None, text[1]), (None, f"{text[1]} end2"), (None, f"{text[1]} end2"), (None, f"1 {text[1]}"), (3, f"3 {text[1]}")]
    rows += [(None, text[2]), (None, f"{text[2]} end3"), (4, text[3]), (5, f"{text[3]} end4"), (5, None), (None, " ")]
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, None if r.class_id < 0 else r.class_id, r.n_links) for r in got) == linked(rows)
    assert "jaccard-sets" in seen and not any("text" in c for c in seen.values())


def test_different_texts_without_id_have_different_names(spark):
    from popdist.llm.substring_dedup import _keyed

    n = 200_000  # 32 bits would meet here
    docs = spark.range(n).selectExpr("cast(null as long) doc_id", "concat('text ', id) text")
    assert _keyed(docs).select("k", "th").distinct().count() == n


def test_shortest_prefix_reaches_the_recall_at_the_threshold():
    k = J.shortest_prefix()
    assert 1 - (1 - 0.8 ** k) ** J.TREES >= J.RECALL > 1 - (1 - 0.8 ** (k + 1)) ** J.TREES


def test_recall_is_measured_from_the_links():
    assert J.measured_recall({}, 3) == 0
    assert abs(J.measured_recall({0: 10}, 5) - J.chance(0.8, 5)) < 1e-12
    assert J.measured_recall({J.BINS - 1: 10}, 5) > 1 - 1e-12
    assert J.measured_recall({0: 1, J.BINS - 1: 10 ** 6}, 5) > J.RECALL > J.measured_recall({0: 10_000, J.BINS - 1: 10 ** 6}, 5)


def test_prefixes_shorten_only_as_far_as_the_links_ask_for(spark):
    from pyspark.sql import functions as F

    text = lambda g: [f"{g}w{i}" for i in range(200)]
    near = [(g * 10 + i, " ".join([*text(g), f"end{i}"])) for g in range(40) for i in range(3)]  # all at 0.99
    far = [(10_000 + i, " ".join([*text("f")[:180 + i], *(f"x{i}{j}" for j in range(20 - i))])) for i in range(4)]  # near 0.8
    for rows, last in ((near, [J.DEPTH]), (near + far, range(J.shortest_prefix(), J.DEPTH)), (near[::3], [J.shortest_prefix()])):
        levels = []
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.monotonically_increasing_id())
        got = J._classed(J.staged(docs, "forest-docs"), "_row", levels).collect()
        assert levels[-1][0] in last and [k for k, _ in levels] == list(range(J.DEPTH, levels[-1][0] - 1, -1))
        assert all(recall < J.RECALL for _, recall in levels[:-1])
        classes = linked_classes(rows)
        assert {r.doc_id: r.top.doc_id for r in got} == classes


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_links_of_whole_tables(spark, sf):
    """All links of the documents by brute force over shared shingles."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    sets, holders = {}, defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        w = low(r.text).split()
        n = min(5, len(w))
        sets[r.doc_id] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for s in sets[r.doc_id]:
            holders[s].append(r.doc_id)
    shared = Counter()
    for ids in holders.values():
        shared.update((a, b) for i, a in enumerate(ids) for b in ids[:i])
    links = Counter()
    for (a, b), n in shared.items():
        if 9 * n >= 4 * (len(sets[a]) + len(sets[b])):
            links.update((a, b))
    got = {r.doc_id: r.n_links for r in J.join(docs).collect()}
    assert got == {i: links[i] for i in sets} and sum(links.values()) > 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7), (300, 300)] + [(500, i) for i in range(600, 640)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[200] == got[150] == 100
    assert {got[i] for i in range(600, 640)} == {500} == {got[500]}


# -- nearest neighbours ---------------------------------------------------------------


def brute(points, ids, own, query, k):
    d = np.sqrt(((points - query) ** 2).sum(1))
    return sorted((x, i) for x, i in zip(d.tolist(), ids.tolist()) if i != own)[:k]


def test_tree_is_exact_at_factor_one_and_loses_recall_beyond():
    r = np.random.default_rng(7)
    points = r.normal(size=(3000, 6))
    points[100:400] = points[100]  # ties
    ids = r.permutation(3000)
    tree, asked = VPTree(points, ids), np.arange(60, 160)
    d, i = tree.search(points[asked], ids[asked], 10)
    for row, q in enumerate(asked):
        want = brute(points, ids, ids[q], points[q], 10)
        assert i[row].tolist() == [w for _, w in want] and np.allclose(d[row], [x for x, _ in want])
    _, loose = tree.search(points[asked], ids[asked], 10, relax=1.5)
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(i.tolist(), loose.tolist())])
    assert 0.5 < recall <= 1


def test_nearest_odd_rows(spark):
    rows = [(0, [0.0, 1.0]), (100, [0.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [3.0, 1.0]), (6, [3.0, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (200, [1.0, 1.0, 2.0]), (300, None)]
    v = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in nearest(v, v.where("vec_id % 100 = 0"), k=3, shard_rows=2, block_queries=1).collect()]
    assert sorted(got) == [(0, 1, 100, 0.0), (0, 2, 6, 3.0), (100, 1, 0, 0.0), (100, 2, 6, 3.0), (200, 1, 8, 1.0)]
    assert nearest(v.where("false"), v.where("false")).count() == 0


def test_registered_search_equals_brute_force(spark):
    from popdist.llm.queries import op8_nearest

    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = defaultdict(list)
    for r in op8_nearest(spark, SMALL).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    for q, found in got.items():
        want = brute(points, ids, q, points[ids == q][0], 10)
        assert [i for _, i in found] == [i for _, i in want]
        assert np.allclose([x for x, _ in found], [x for x, _ in want], rtol=1e-14)
