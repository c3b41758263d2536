"""Typed walks as an automaton, against a search in plain Python."""

import random

import pytest

from popdist.operators import graph

PATHS = (("IN", ("a", "b"), "X"), ("IN", ("a",), "Y"), ("IN", ("a", "b", "c"), "X"), ("IN", ("d", "b"), "Z"),
         ("MIN", ("a",), "X"), ("MIN", ("a", "b", "b", "c"), "Y"))


def tables(spark, nodes, edges):
    return (spark.createDataFrame(nodes, "rxcui string, sab string, tty string, str string"),
            spark.createDataFrame(edges, "rxcui1 string, rela string, rxcui2 string"))


def search(nodes, edges, paths):
    out = set()
    for root, relas, final in paths:
        for rx, sab, tty, name in nodes:
            if sab == "RXNORM" and tty == root:
                at = {rx}
                for rela in relas:
                    at = {a for a, r, b in edges if r == rela and b in at}
                out |= {(rx, name, tty, n[0], n[3], n[2]) for n in nodes if n[0] in at and n[1] == "RXNORM" and n[2] == final}
    return out


def test_paths_share_their_prefixes():
    trie = graph.PathTrie(PATHS)
    assert len(trie.moves) == 2 + 5 + 4 and trie.depth == 4
    full = graph.PathTrie(graph.CROSSWALK_PATHS)
    assert len(full.moves) == 12 and full.depth == 4


@pytest.mark.parametrize("hub", [3, 1000])
def test_walks_equal_a_search(spark, hub):
    rnd = random.Random(hub)
    ttys = ["IN", "MIN", "X", "Y", "Z", "Q"]
    nodes = [(f"n{i}", "RXNORM" if i % 7 else "OTHER", rnd.choice(ttys), f"name {i}") for i in range(80)]
    nodes += [("n3", "RXNORM", "X", "second type"), ("n3", "RXNORM", "X", "second name")]
    edges = [(f"n{rnd.randrange(80)}", rnd.choice("abcd"), f"n{rnd.randrange(80)}") for _ in range(600)]
    edges += edges[:50] + [(f"n{i}", "a", "n1") for i in range(80)] + [(f"n{i}", "b", "n2") for i in range(80)]  # repeats, hubs
    edges += [(None, "a", "n1"), ("n1", "a", None), ("n4", None, "n5")]
    got = graph.walk(*tables(spark, nodes, edges), PATHS, hub=hub).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == search(nodes, [e for e in edges if None not in e], PATHS)


def test_empty_graphs(spark):
    nodes, edges = tables(spark, [("r", "RXNORM", "IN", "root")], [])
    assert graph.walk(nodes, edges, PATHS).collect() == []
    assert graph.walk(nodes.where("false"), edges, PATHS).collect() == []


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_shuffles_of_the_crosswalk(spark):
    from inputs import SMALL
    from popdist.plans.context import Context

    assert exchanges(Context(spark, SMALL).built_crosswalk) <= 12
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(Context(spark, SMALL).built_crosswalk) <= 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
