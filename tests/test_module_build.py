"""The multi-module build: every output, any profiles, one plan."""

import csv
import json
import os
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inputs import SMALL
from popdist.operators import cohort as co
from popdist.operators import lookup, states
from popdist.operators.distribution import Distribution
from popdist.operators.profiles import ProfiledDistribution, profile_table
from popdist.plans.context import COHORTS, PROFILED, Context
from popdist.plans.module_build import BuildInputs, build_modules
from popdist.settings import ModuleSettings
from popdist.sources.module_files import read_module_files, write_module_files
from popdist.sources.wide_lookup import write_wide


@pytest.fixture(scope="module")
def ctx(spark):
    return Context(spark, SMALL)


@pytest.fixture(scope="module")
def built(spark, ctx):
    odd = ModuleSettings(
        module_name='odd "names"', name="Odd, Names", rxcui_include=("I-Brand#5",), refills=3, as_needed=None, chronic=True,
        reason='a "reason"\\', assign_to_attribute="My Attribute", flags={"age": True, "gender": False, "state": False},
        age_ranges=("0-17", "18-103"))
    modules = [*PROFILED, odd]
    inputs = BuildInputs(ctx.fx.prescription, ctx.fx.demographics, ctx.fx.crosswalk, ctx.dose_form_map,
                         ctx.fx.region_states, ctx.fx.class_members)
    return modules, build_modules(spark, inputs, modules, tempfile.mkdtemp(prefix="popdist-build-"))


def documents(paths):
    """The module documents, parsed from their files."""
    out = {}
    for module in os.listdir(paths["modules"]):
        (file,) = os.listdir(f"{paths['modules']}/{module}")
        with open(f"{paths['modules']}/{module}/{file}", encoding="utf-8") as f:
            out[module] = json.load(f)
    return out


def test_every_output_reads_back(spark, built):
    modules, paths = built
    names = {m.module_name for m in modules}
    long = spark.read.option("header", True).csv(paths["lookup_tables"])
    assert {r.cohort for r in long.select("cohort").distinct().collect()} == names
    assert long.where("cohort = 'only_age'").where("gender IS NOT NULL OR state IS NOT NULL").count() == 0
    for path in ("validation", "ndc_rows", "survey_rows", "remarks"):
        assert spark.read.option("header", True).csv(paths[path]).count() > 0
    assert set(os.listdir(paths["remarks_log"])) == names == set(os.listdir(paths["modules"]))


def test_documents_name_files_that_exist_with_their_columns(built):
    _, paths = built
    for module, doc in documents(paths).items():
        named = defaultdict(list)
        for state in doc["states"].values():
            for t in state.get("lookup_table_transition", ()):
                named[t["lookup_table_name"]].append(t["transition"])
        assert set(named) == set(os.listdir(f"{paths['wide_tables']}/{module}"))
        for file, transitions in named.items():
            with open(f"{paths['wide_tables']}/{module}/{file}", encoding="utf-8", newline="") as f:
                header = next(csv.reader(f))
            assert [c for c in header if c not in ("age", "gender", "state")] == sorted(transitions)


def test_wide_files_hold_the_long_cells(spark, built):
    _, paths = built
    want = Counter()
    for r in spark.read.option("header", True).csv(paths["lookup_tables"]).collect():
        want[(r.cohort, r.lookup_table, r.age, r.gender, r.state, r.transition, float(r.probability))] += 1
    got, filled = Counter(), 0
    for module in os.listdir(paths["wide_tables"]):
        for file in os.listdir(f"{paths['wide_tables']}/{module}"):
            with open(f"{paths['wide_tables']}/{module}/{file}", encoding="utf-8", newline="") as f:
                for row in csv.DictReader(f):
                    key = [row.pop(c, None) for c in ("age", "gender", "state")]
                    for name, value in row.items():
                        got[(module, file, *key, name, float(value))] += 1
    assert not want - got
    assert all(k[-1] == 0.0 for k in got - want)


def test_document_files_hold_the_state_rows(spark, built, ctx):
    modules, paths = built
    dist = ctx.profiled(modules)
    pairs = states.prescribed_pairs(dist.ndc_rows, ctx.fx.prescription, ctx.fx.demographics)
    rows = states.module_documents(states.document_pieces(dist, pairs, modules)).collect()
    want = defaultdict(dict)
    for r in rows:
        want[r.cohort].update(json.loads("{" + r.entry + "}"))
    docs = documents(paths)
    assert {m: d["states"] for m, d in docs.items()} == want
    for m in modules:
        doc, st = docs[m.module_name], docs[m.module_name]["states"]
        assert doc["gmf_version"] == 2 and st["Terminal"] == {"type": "Terminal"}
        assert json.loads("\n".join(doc["remarks"][doc["remarks"].index("{"):])) == json.loads(json.dumps(m.as_dict(), default=str))
        assert st["Initial"]["conditional_transition"][0]["transition"] == "Prescribe_Ingredient"
        first = [t["default_probability"] for t in st["Prescribe_Ingredient"]["lookup_table_transition"]]
        assert first[0] == "1" and set(first[1:]) <= {"0"}
        orders = [s for s in st.values() if s["type"] == "MedicationOrder"]
        assert orders and sum("remarks" in s for s in orders) <= 1
        assert all(s["direct_transition"] == "Terminal" and s["codes"][0]["system"] == "RxNorm" for s in orders)
    odd = [s for s in docs['odd "names"']["states"].values() if s["type"] == "MedicationOrder"]
    assert {(s["assign_to_attribute"], s["prescription"]["refills"], "as_needed" in s["prescription"], s["chronic"], s["reason"])
            for s in odd} == {("my_attribute", 3, False, True, 'a "reason"\\')}


def test_text_log_is_the_documents_remarks(built):
    _, paths = built
    for module, doc in documents(paths).items():
        with open(f"{paths['remarks_log']}/{module}/remarks.txt", encoding="utf-8") as f:
            log = f.read().split("\n")[:-1]
        tables = [s for s in doc["states"].values() if s["type"] == "Simple"]
        assert log[:len(doc["remarks"])] == doc["remarks"]
        assert Counter(log) == Counter(doc["remarks"]) + Counter(x for s in tables for x in s["remarks"])


def test_one_plan_equals_a_plan_per_profile(ctx):
    dist = ctx.profiled()
    for level in ("ingredient", "product", "validation"):
        got = defaultdict(Counter)
        for r in getattr(dist, level)().collect():
            got[r.cohort][tuple(r.asDict().values())] += 1
        for m in PROFILED:
            one = Distribution(ctx.fx.prescription, ctx.fx.demographics, dist.ndc_rows.where(F.col("cohort") == m.module_name),
                               ctx.fx.region_states, age=m.flag("age"), gender=m.flag("gender"), state=m.flag("state"), bands=m.bands())
            rows = getattr(one, level)()
            columns = getattr(dist, level)().columns
            full = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns])
            assert got[m.module_name] == Counter(map(tuple, full.collect())), (level, m.module_name)


def many(n):
    flags = [{"age": a, "gender": g, "state": s} for a in (True, False) for g in (True, False) for s in (True, False)]
    return [ModuleSettings(module_name=f"m{i}", rxcui_include=(f"I-Brand#{i % 25 + 1}", f"M-{i % 3}"), flags=flags[i % 8],
                           dose_form_filter=("STANDARD", "SMALL", "PROMO") if i % 2 else None,
                           ingredient_tty_filter=("IN", "MIN", None)[i % 3], age_ranges=(f"0-{i % 90 + 5}", "20-103"))
            for i in range(n)]


def test_two_thousand_modules_are_one_plan(spark, ctx):
    def dist(modules):
        return ProfiledDistribution(ctx.fx.prescription, ctx.fx.demographics, ctx.module_ndc_rows(modules),
                                    ctx.fx.region_states, profile_table(spark, modules))

    size = lambda modules: dist(modules).joined._jdf.queryExecution().optimizedPlan().treeString().count("\n")
    modules = many(2000)
    assert size(modules) == size(many(6))
    got = defaultdict(Counter)
    for r in dist(modules).ingredient().collect():
        got[r.cohort][tuple(r)[1:]] += 1
    few = [modules[i] for i in (0, 7, 500, 1203, 1999)]
    alone = defaultdict(Counter)
    for r in dist(few).ingredient().collect():
        alone[r.cohort][tuple(r)[1:]] += 1
    assert alone and all(got[m] == rows for m, rows in alone.items())


# -- the file sink -----------------------------------------------------------------

KIND = "cohort string, lookup_table string, age string, gender string, state string, transition string, probability double"


def test_a_failed_write_leaves_the_old_files(spark):
    path = tempfile.mkdtemp(prefix="wide-")
    profiles = profile_table(spark, [ModuleSettings(module_name="m", rxcui_include=("x",)),
                                     ModuleSettings(module_name="n", rxcui_include=("x",), flags={"age": False, "gender": False, "state": False})])
    rows = [("m", "t.csv", "0-3", "F", "Here, there", "A", 0.25), ("m", "t.csv", "0-3", "F", "Here, there", "B", 0.75),
            ("m", "t.csv", "4-7", "M", None, "B", 1.0), ("m", "u.csv", "4-7", "M", "X", "C", 1.0), ("n", "v.csv", None, None, None, "Z", 1.0)]
    write_wide(spark.createDataFrame(rows, KIND), profiles, path)
    read = lambda: {(r.module, r.file, r.line_no): r.line for r in read_module_files(spark, path).collect()}
    first = read()
    assert first == {
        ("m", "t.csv", 0): "age,gender,state,A,B", ("m", "t.csv", 1): '0-3,F,"Here, there",0.25,0.75', ("m", "t.csv", 2): "4-7,M,,0.0,1.0",
        ("m", "u.csv", 0): "age,gender,state,C", ("m", "u.csv", 1): "4-7,M,X,1.0", ("n", "v.csv", 0): "Z", ("n", "v.csv", 1): "1.0"}
    with pytest.raises(Exception, match="two cells for A"):
        write_wide(spark.createDataFrame([*rows, rows[0]], KIND), profiles, path)
    assert read() == first and sorted(os.listdir(path)) == ["m", "n"]
    # a later build of one module replaces that module alone, tables that it lost included
    write_wide(spark.createDataFrame([("m", "u.csv", "4-7", "M", "X", "D", 0.5)], KIND), profiles, path)
    assert read() == {("m", "u.csv", 0): "age,gender,state,D", ("m", "u.csv", 1): "4-7,M,X,0.5",
                      ("n", "v.csv", 0): "Z", ("n", "v.csv", 1): "1.0"}
    write_wide(spark.createDataFrame([], KIND), profiles, path)
    assert len(read()) == 4


def test_files_of_two_tasks_or_with_odd_names_are_errors(spark):
    path = tempfile.mkdtemp(prefix="files-")
    lines = spark.createDataFrame([("m", "f", str(i)) for i in range(20)], "module string, file string, line string")
    with pytest.raises(Exception, match="two tasks wrote m/f"):
        write_module_files(lines.repartition(3), path)
    for name in ("a/b", "..", ""):
        with pytest.raises(Exception, match="not a file name"):
            write_module_files(lines.limit(1).withColumn("file", F.lit(name)), path)
    assert read_module_files(spark, path).collect() == []


def test_a_module_without_rows_still_has_a_document(spark, ctx):
    nothing = ModuleSettings(module_name="nothing", rxcui_include=("no such id",))
    dist = ctx.profiled([nothing, COHORTS[0]])
    pairs = states.prescribed_pairs(dist.ndc_rows, ctx.fx.prescription, ctx.fx.demographics)
    rows = states.module_documents(states.document_pieces(dist, pairs, [nothing, COHORTS[0]]))
    assert [r.state_name for r in rows.where("cohort = 'nothing'").orderBy("place").collect()] == ["Initial", "Terminal"]
    assert lookup.lookup_long(dist).where("cohort = 'nothing'").count() == 0
    assert co.distinct_products(dist.ndc_rows).where("cohort = 'nothing'").count() == 0
