"""Readers that set broken lines aside, encodings, stored tables, nested answers."""

import json
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inputs import SMALL
from popdist import functions as fn
from popdist.operators import survey
from popdist.operators.json_search import key_values
from popdist.plans.context import COHORTS, Context
from popdist.plans.module_build import BuildInputs
from popdist.settings import ClassQuery, ModuleSettings
from popdist.sources import class_members as cm
from popdist.sources import delimited, profile, sinks, stored

NAMES = ("A", "B", "C", "test")


def folder(lines, encoding="utf-8"):
    path = tempfile.mkdtemp(prefix="lines-")
    with open(f"{path}/part", "wb") as f:
        f.write(lines if isinstance(lines, bytes) else lines.encode(encoding))
    return path


# -- broken lines ------------------------------------------------------------------

def test_broken_lines_are_counted_and_set_aside(spark):
    path, away = folder('1|x "y|NA|\n2|z||\n\nshort|\n3|é|c|\nlong|a|b|c|\n'), tempfile.mkdtemp(prefix="away-")
    rows, counts = delimited.read_pipe_checked(spark, path, NAMES, away, most_bad=0.4)
    assert [tuple(r) for r in rows.collect()] == [("1", 'x "y', None), ("2", "z", None), ("3", "é", "c")]
    assert counts == {"whole": 3, "broken": 2}
    kept = spark.read.parquet(away).collect()
    assert {r.line for r in kept} == {"short|", "long|a|b|c|"} and all(r.file.endswith("/part") for r in kept)
    one, _ = delimited.read_pipe_checked(spark, path, NAMES, away, most_bad=0.4, columns=["C", "A"])
    assert [tuple(r) for r in one.collect()] == [(None, "1"), (None, "2"), ("c", "3")]


def test_too_many_broken_lines_stop_the_read(spark):
    path, away = folder("1|x|y|\nshort|\n"), tempfile.mkdtemp(prefix="away-")
    with pytest.raises(delimited.TooManyBadLines, match="1 of 2 lines"):
        delimited.read_pipe_checked(spark, path, NAMES, away, most_bad=0.25)
    assert spark.read.parquet(away).count() == 1
    empty, counts = delimited.read_pipe_checked(spark, folder(""), NAMES, away)
    assert empty.collect() == [] and counts == {"whole": 0, "broken": 0}


# -- Windows-1252 --------------------------------------------------------------------

def test_windows_1252_without_a_session_option(spark):
    before = dict(spark.conf.getAll)
    path = folder("näme €\tvalue\nž™–\t“x” ÿ\n".encode("cp1252"))
    rows = delimited.read_tsv(spark, path)
    assert rows.columns == ["näme €", "value"] and [tuple(r) for r in rows.collect()] == [("ž™–", "“x” ÿ")]
    every = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    assert delimited.read_tsv(spark, folder(b"h\n" + every + b"\n")).first()[0] == every.decode("cp1252")
    out = tempfile.mkdtemp(prefix="tsv-")
    delimited.write_tsv(rows, out)
    assert [tuple(r) for r in delimited.read_tsv(spark, out).collect()] == [("ž™–", "“x” ÿ")]
    assert dict(spark.conf.getAll) == before


def test_undefined_bytes_short_lines_and_other_characters(spark):
    bad = folder(b"a\tb\nok\t\x81x\n")
    with pytest.raises(Exception, match="undefined Windows-1252 byte"):
        delimited.read_tsv(spark, bad).collect()
    assert delimited.read_tsv(spark, bad, undefined="replace").first()[1] == "�x"
    for line in (b"only\n", b"1\t2\t3\n"):
        with pytest.raises(Exception):
            delimited.read_tsv(spark, folder(b"a\tb\n" + line)).collect()
    with pytest.raises(Exception, match="not in Windows-1252"):
        delimited.write_tsv(spark.createDataFrame([("日本",)], "a string"), tempfile.mkdtemp())


def test_csv_read_back_is_strict(spark):
    path = tempfile.mkdtemp(prefix="csv-")
    sinks.write_csv(spark.createDataFrame([("a", 1.5)], "x string, y double"), path)
    schema = spark.createDataFrame([], "x string, y double").schema
    assert [tuple(r) for r in sinks.read_csv(spark, path, schema).collect()] == [("a", 1.5)]
    with open(f"{path}/part-more.csv", "w") as f:
        f.write("x,y\nshort\n")
    with pytest.raises(Exception):
        sinks.read_csv(spark, path, schema).collect()


# -- stored tables -------------------------------------------------------------------

def test_a_new_version_appears_at_once_or_not_at_all(spark):
    name = "popdist_test_stored"
    for v in stored.versions(spark, name):
        spark.sql(f"DROP TABLE {v}")
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    first = stored.store(spark.range(10).withColumn("v", F.lit(1)), name, "id", 4)
    assert first.count() == 10
    broken = spark.range(10).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row")).cast("int")).otherwise(2))
    with pytest.raises(Exception, match="broken row"):
        stored.store(broken, name, "id", 4)
    assert {r.v for r in spark.table(name).collect()} == {1} and len(stored.versions(spark, name)) == 1
    for v in (2, 3, 4):
        stored.store(spark.range(5).withColumn("v", F.lit(v)), name, "id", 4)
    assert {r.v for r in spark.table(name).collect()} == {4} and len(stored.versions(spark, name)) == 2
    calls = []
    assert stored.stored_once(spark, name, lambda: calls.append(1), "id").count() == 5 and not calls


def test_stored_sides_join_without_a_shuffle(spark):
    c = Context(spark, SMALL)
    inputs = BuildInputs(c.fx.prescription, c.fx.demographics, c.fx.crosswalk, c.dose_form_map, c.fx.region_states, c.fx.class_members)
    kept = stored.stored_inputs(spark, inputs, "popdist_test_inputs", buckets=8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        joined = kept.prescription.join(kept.demographics, "DUPERSID")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        # the package side too: only the prescriptions, bucketed by person, move
        assert plan(kept.prescription.join(kept.crosswalk, F.col("RXNDC") == F.col("medication_ndc"))).count("Exchange hash") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = lambda i: Counter(map(tuple, survey.survey_reference(i.prescription, i.demographics).collect()))
    assert rows(kept) == rows(inputs)


def test_counts_come_from_the_footers(spark):
    before = dict(spark.conf.getAll)
    plan = profile.footer_count(spark, f"{SMALL}/lineitem.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    rows = profile.stored_row_counts(spark, {t: f"{SMALL}/{t}.parquet" for t in ("region", "lineitem")}).collect()
    assert {r.table_name: r.row_count for r in rows} == {
        "region": 5, "lineitem": spark.read.parquet(f"{SMALL}/lineitem.parquet").count()}
    assert dict(spark.conf.getAll) == before


def test_match_counts_run_every_step_once(spark):
    calls = []

    def step(name, rows):
        calls.append(name)
        return rows

    start = spark.createDataFrame([("a", "1"), ("a", None), ("b", "2"), ("b", "2")], "cohort string, medication_ndc string")
    got = profile.match_counts({"one": lambda _: step("one", start), "two": lambda r: step("two", r.distinct()),
                                "none": lambda r: step("none", r.where("false"))})
    assert {(r.cohort, r.stage): r.ndc_count for r in got.collect()} == {
        ("a", "one"): 1, ("b", "one"): 2, ("a", "two"): 1, ("b", "two"): 1}
    assert calls == ["one", "two", "none"]


# -- nested answers --------------------------------------------------------------------

def python_values(doc, key):
    """(value as text) of every scalar under ``key``, by walking the document."""
    out = []
    if isinstance(doc, dict):
        for k, v in doc.items():
            if isinstance(v, (dict, list)):
                out += python_values(v, key)
            elif k == key:
                out.append(None if v is None else str(v).lower() if isinstance(v, bool) else str(v))
    elif isinstance(doc, list):
        for v in doc:
            out += python_values(v, key)
    return out


def test_key_search_at_any_depth(spark):
    deep = {"k": "bottom"}
    for i in range(30):
        deep = {"x": [1, {"k": i, "y": deep}]} if i % 2 else [{"other": "k", "z": deep}]
    texts = [
        '{"k": "a\\"b\\\\c \\u00e9", "n": {"k": 12345678901234567890123456789012345678}}', '{"k": null, "j": [{"k": true}, {"k": [1, {"k": false}]}]}',
        '[{"k": -0.5}, {"k": 1.50}, {"k": 1e2}, [[{"k": ""}]]]', '{"K": 1, "k.k": 2, "kk": {"k ": 3}}', '"k"', "3", "null",
        json.dumps(deep), '{"say": "\\"k\\": 7"}', '{"k": {"k": {"k": "x"}}}']
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate([*texts, None, "{broken", ""])],
                                 "id int, j string, key string, value int")
    got = Counter(tuple(r) for r in key_values(docs, ["id"], "j", ["k"]).collect())
    assert got == Counter((i, "k", v) for i, t in enumerate(texts) for v in python_values(json.loads(t), "k"))
    assert key_values(docs.where("false"), ["id"], "j", ["k"]).collect() == []
    two = key_values(docs, ["id"], "j", ["k", "other"]).where("key = 'other'")
    assert {r.value for r in two.collect()} == {"k"}


def test_members_are_of_the_term_types_that_are_asked_for(spark):
    member = lambda rx, tty: {"minConcept": {"rxcui": rx, "name": "n", "tty": tty}, "nodeAttr": [{"rxcui": "no member"}]}
    answer = json.dumps({"drugMemberGroup": {"drugMember": [member("1", "IN"), member("2", "MIN"), member("3", "SCD"), member("4", "BN"), member(None, "IN")]}})
    responses = spark.createDataFrame(
        [("c", cm.RELATION_SOURCE[r], None if r in cm.SINGLE_RELATION_SOURCES else r, answer) for r in cm.RELATION_SOURCE]
        + [("e", "ATC", None, "{}"), ("e", "ATC", None, '{"drugMemberGroup": null}')], "class_id string, rela_source string, rela string, response string")
    members = cm.members_of_responses(responses)
    queries = cm.class_query_table(spark, [("m", "c", r) for r in cm.RELATION_SOURCE] + [("m", "e", "ATC")])
    got = {}
    for r in cm.resolve_class_members(queries, members).collect():
        got.setdefault(r.relationship, set()).add(r.rxcui)
    products = {"has_schedule", "has_VAClass", "has_VAClass_extended"}
    assert got == {r: {"1", "2", "3"} if r in products else {"1", "2"} for r in cm.RELATION_SOURCE}
    with pytest.raises(Exception):
        cm.members_of_responses(responses.limit(1).withColumn("response", F.lit("{broken"))).collect()


def test_codes_with_zeros_and_letters(spark):
    df = spark.createDataFrame([("007",), (" 7 ",), ("0",), ("000",), ("A07",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(fn.code_key("c")).collect()] == ["7", "7", "0", "0", "A07", "", None]


def test_an_unknown_relationship_and_an_empty_module_are_errors(spark):
    with pytest.raises(ValueError, match="no class relationship"):
        cm.class_query_table(spark, [("m", "c", "nonsense")])
    with pytest.raises(ValueError, match="neither a class nor an id"):
        ModuleSettings(module_name="m")
    assert ClassQuery("c", "ATC") and COHORTS and os.path.isdir(SMALL)
