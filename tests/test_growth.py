"""Work that must not grow with the rows of a join: aggregates, staged bytes, names in shuffles."""

import glob
import os

from popdist.operators import graph, survey
from popdist.operators.distribution import Distribution
from popdist.operators.profiles import ProfiledDistribution, profile_table
from popdist.session import checkpoint_dir, scratch_path
from popdist.settings import ModuleSettings
from popdist.sources import fixed_width as fw

PEOPLE = "DUPERSID string, PERWTF long, SEX string, AGELAST int, REGION int"


def top(df):
    return df._jdf.queryExecution().optimizedPlan().nodeName()


def inputs(spark):
    """Person 1 has a row twice, person 2 two rows that differ in age only, person 3 one."""
    people = spark.createDataFrame([("1", 5, "1", 30, 1)] * 2 + [("2", 7, "2", 40, 1), ("2", 7, "2", 41, 1), ("3", 9, None, 70, 2)], PEOPLE)
    fills = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("3", "b"), (None, "a"), ("4", "a")],
                                  "DUPERSID string, RXNDC string")
    rows = [("m", "Ing", "I", "Prod A", "PA", "a"), ("m", "Ing", "I", "Prod B", "PB", "b")]
    ndc = spark.createDataFrame(rows, "cohort string, medication_ingredient_name string, medication_ingredient_rxcui string, "
                                      "medication_product_name string, medication_product_rxcui string, medication_ndc string")
    return fills, people, ndc, spark.createDataFrame([(1, "S1"), (1, "S2")], "region_value int, state string")


def test_reference_is_distinct_without_an_aggregate_of_its_rows(spark):
    fills, people, _, _ = inputs(spark)
    got = survey.survey_reference(fills, people)
    assert top(got) != "Aggregate"
    assert sorted((r.DUPERSID, r.RXNDC, r.AGELAST) for r in got.collect()) == [
        ("1", "a", 30), ("1", "b", 30), ("2", "a", 40), ("2", "a", 41), ("3", "b", 70)]


def test_person_counts_of_repeated_persons(spark):
    d = Distribution(*inputs(spark), age=False, gender=False, state=False, product_level=False)
    assert d.ingredient_persons._jdf.queryExecution().optimizedPlan().nodeName() != "Aggregate"
    got = {(r.person_weight, r.patient_count) for r in d.weighted_person_count().collect()}
    assert got == {(5, 1), (7, 1), (9, 1)}


def test_profiles_add_up_repeated_persons_by_the_demographics_used(spark):
    modules = {"ages": ({"age": True, "gender": False, "state": False}, ("0-35", "36-40", "41-80")),
               "none": ({"age": False, "gender": False, "state": False}, None),
               "states": ({"age": False, "gender": True, "state": True}, None)}
    fills, people, ndc, states = inputs(spark)
    for name, (flags, bands) in modules.items():
        m = ModuleSettings(module_name="m", rxcui_include=("I",), flags=flags, **({"age_ranges": bands} if bands else {}))
        d = ProfiledDistribution(fills, people, ndc, states, profile_table(spark, [m]))
        assert not [c for c in d.person_things.columns if c.endswith("_name")]
        got = {(r.level, r.medication_product_name, r.age, r.gender, r.region_num): r.weighted for r in d.weights.collect()}
        a, b = "Prod_A", "Prod_B"
        want = {
            "none": {(0, None, None, None, None): 21, (1, a, None, None, None): 12, (1, b, None, None, None): 14},
            "states": {(0, None, None, "M", 1): 5, (0, None, None, "F", 1): 7, (1, a, None, "M", 1): 5, (1, b, None, "M", 1): 5,
                       (1, a, None, "F", 1): 7},
            "ages": {(0, None, "0-35", None, None): 5, (0, None, "36-40", None, None): 7, (0, None, "41-80", None, None): 16,
                     (1, a, "0-35", None, None): 5, (1, b, "0-35", None, None): 5, (1, a, "36-40", None, None): 7,
                     (1, a, "41-80", None, None): 7, (1, b, "41-80", None, None): 9}}[name]
        assert got == want


def test_crosswalk_is_distinct_without_an_aggregate_of_its_rows(spark):
    sab = "RXNORM"
    nodes = spark.createDataFrame([("R", sab, "IN", "r"), ("C", sab, "SCD", "c"), ("C", sab, "SCD", "c"), ("D", sab, "DF", "d"),
                                   ("D", sab, "DF", "d")], "rxcui string, sab string, tty string, str string")
    edges = spark.createDataFrame([("N", "ingredient_of", "R"), ("X", "ingredient_of", "R"), ("C", "constitutes", "N"),
                                   ("C", "constitutes", "X"), ("D", "has_dose_form", "C")], "rxcui1 string, rela string, rxcui2 string")
    codes = spark.createDataFrame([("C", sab, "NDC", "1"), ("C", sab, "NDC", "1")], "rxcui string, sab string, atn string, atv string")
    got = graph.build_crosswalk(nodes, edges, codes)
    assert top(got) != "Aggregate"
    assert [tuple(r) for r in got.collect()] == [("R", "r", "IN", "C", "c", "SCD", "D", "d", "DF", "1")]


def test_hops_read_only_the_edges_they_can_follow():
    trie = graph.PathTrie(graph.CROSSWALK_PATHS)
    assert trie.types_at(0) == ["has_tradename", "ingredient_of", "ingredients_of"]
    assert trie.types_at(3) == ["has_tradename"] and trie.types_at(4) == []


def test_staged_fixed_width_lines_take_little_disk(spark):
    path = scratch_path(spark, "fixed")
    rows = spark.range(2000).selectExpr("cast(id as string) DUPERSID", "cast(id % 7 as string) RXNDC")
    fw.write_fixed_width(rows, fw.PRESCRIPTION_SPECS, path, 610)
    assert sum(os.path.getsize(f) for f in glob.glob(f"{path.removeprefix('file:')}/part-*")) < 2000 * 61
    back = fw.read_fixed_width(spark, path, fw.PRESCRIPTION_SPECS, ("DUPERSID", "RXNDC"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_exact_dedup_moves_no_texts_for_few_rows(spark, monkeypatch):
    from popdist.llm import exact_dedup

    asked = []
    real = exact_dedup.by_rows
    monkeypatch.setattr(exact_dedup, "by_rows", lambda docs, rows, row, how: asked.append(row) or real(docs, rows, row, how))
    docs = spark.createDataFrame([(1, "a b"), (2, "A b"), (3, "c"), (None, "c"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.dedup(docs).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 2), None: (3, 2), 4: (4, 1)} and asked == ["k"]


def test_near_join_frees_the_tables_of_a_level(spark):
    from popdist.llm import jaccard_join

    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "other words")], "doc_id long, text string")
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{base}/jaccard-members-*"))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert set(glob.glob(f"{base}/jaccard-members-*")) == before
