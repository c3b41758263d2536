"""Ranked lexical search against a brute force over all documents."""

import math
import re
from collections import Counter

import pytest

from popdist.llm import lexical_search as ls

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    full = [b for _, b in bags if b]
    n, length = len(full), sum(sum(b.values()) for b in full)
    df = Counter(t for b in full for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * n) // length if b else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def made(n):
    words = [f"w{i}" for i in range(40)] + ["the", "The", "of", "İx", "日本", "a_b", "é", "x1"]
    rows = [(i, " ".join(words[(i * j * 7 + j) % len(words)] for j in range(1, 4 + i % 17))) for i in range(n)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, None), (n + 5, ""), (n + 6, "!!! --"), (n + 7, None)]
    rows += [(n + 10 + i, rows[5][1]) for i in range(70)]  # ties beyond k
    rows.append((n + 200, " ".join(words * 900)))
    return rows


@pytest.mark.parametrize("per_block", [60, 100_000])
def test_equals_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(ls, "POSTINGS_PER_BLOCK", per_block)
    rows = made(120)
    items = [(i, rows[i % 100][1] + " THE w1 zzz") for i in range(300)] + [(3, rows[9][1]), (None, "w2 of"), (400, None), (401, "none here"), (402, "")]
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows],
                                 "doc_id long, text string, row int, term string, score int, rank int")
    asked = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, item int, terms string, u int")
    got = ls.search(docs, asked, k=50)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute(rows, items, 50)


def test_fewer_than_k_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta"), (3, "gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta"), (2, "gamma gamma")], "item_id long, text string")
    got = Counter(map(tuple, ls.search(docs, items, k=50).collect()))
    assert got == brute([(1, "alpha beta"), (2, "beta"), (3, "gamma")], [(1, "beta"), (2, "gamma gamma")], 50)
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("doc_id = 3"), items.where("item_id = 1"))):
        assert ls.search(d, i).collect() == []


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "hello text"), (2, "é 中文 w5 w6")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(map(tuple, ls.search(odd_docs, items, k=5).collect())) == brute(rows, [(1, "hello text"), (2, "é 中文 w5 w6")], 5)


def test_no_sum_is_given_up_too_early(spark, monkeypatch):
    """Documents that only frequent words lift above the others."""
    monkeypatch.setattr(ls, "SHARES", (64, 16, 2))
    rows = [(i, "rare" + str(i % 40) + " " + " ".join(f"c{j}" for j in range(12) if (i >> (j % 6)) & 1)) for i in range(400)]
    items = [(1, "rare1 rare2 " + " ".join(f"c{j}" for j in range(12))), (2, "c0 c1 c2 rare39")]
    got = ls.search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=10)
    assert Counter(map(tuple, got.collect())) == brute(rows, items, 10)
