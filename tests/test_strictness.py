"""Values that do not fit, headers in another order, colliding cells, small p-values."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from popdist import functions as fn
from popdist.operators.lookup import lookup_wide
from popdist.operators.validation import chi2_survival, chi_square
from popdist.sources import delimited, fixed_width
from popdist.streaming.incremental import run_order_ingest


def test_a_value_wider_than_its_span_is_an_error(spark):
    df = spark.createDataFrame([("10", 104)], "a string, b int")
    specs = (("a", 0, 3), ("b", 3, 5))
    with pytest.raises(Exception, match="b is wider than 2: 104"):
        fixed_width.format_fixed_width(df, specs).collect()
    fits = fixed_width.format_fixed_width(df.withColumn("b", F.lit(99)), specs).collect()
    assert fits[0].value == "10 99"


def test_pipe_lines_with_other_fields_are_errors(spark):
    folder = tempfile.mkdtemp(prefix="pipe-")
    for name, line, good in (("a", "1|x|", True), ("b", "1|", False), ("c", "1|x|y|z|", False)):
        with open(f"{folder}/{name}", "w") as f:
            f.write(line + "\n")
        rows = delimited.read_pipe(spark, f"{folder}/{name}", ("n", "v", "test"))
        if good:
            assert [tuple(r) for r in rows.collect()] == [("1", "x")]
        else:
            with pytest.raises(Exception):
                rows.collect()


ORDERS = "START,STOP,PATIENT,PAYER,CODE,BASE_COST\n2020-01-02,2020-02-03,p1,i,77,1.5\n2021-01-02,,p2,i,78,2.5\n"


def test_order_columns_are_found_by_name(spark):
    folder = tempfile.mkdtemp(prefix="orders-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write(ORDERS)
    from popdist.streaming.incremental import ORDER_SCHEMA

    rows = delimited.read_csv_columns(spark, folder, ORDER_SCHEMA, ["CODE", "PATIENT", "START"]).collect()
    assert [(r.CODE, r.PATIENT, str(r.START)) for r in rows] == [("77", "p1", "2020-01-02"), ("78", "p2", "2021-01-02")]
    chosen = spark.createDataFrame([("A", 77)], "medication_product_name string, code long")
    out, mark = tempfile.mkdtemp(prefix="out-"), tempfile.mkdtemp(prefix="mark-")
    got = run_order_ingest(spark, folder, chosen, out, mark).collect()
    assert [(r.PATIENT, r.CODE, str(r.START), r.medication_product_name) for r in got] == [("p1", "77", "2020-01-02", "A")]


def test_json_strings_are_decoded(spark):
    docs = ['{"k": "a\\"b", "j": {"k": "\\u00e9\\n"}}', '{"k": null}', '{"x\\"k": 1}', '{"k": true, "l": {"k": -1.5e3}}']
    df = spark.createDataFrame([(d,) for d in docs], "v string")
    got = [r[0] for r in df.select(fn.json_key_values("v", "k")).collect()]
    assert got == [['a"b', "é\n"], [None], [], ["true", "-1.5e3"]] or got == [['a"b', "é\n"], [None], [], ["true", "-1500.0"]]


def test_colliding_cells_are_an_error(spark):
    df = spark.createDataFrame([("g", "A", 0.583), ("g", "A", 0.417)], "d string, transition string, probability double")
    with pytest.raises(Exception, match="two cells for A"):
        lookup_wide(df, ["d"], transitions=["A", "B"]).collect()
    one = lookup_wide(df.where("probability > 0.5"), ["d"], transitions=["A", "B"]).collect()
    assert [tuple(r) for r in one] == [("g", 0.583, 0.0)]
    with pytest.raises(Exception, match="no such transition: A"):
        lookup_wide(df, ["d"], transitions=["B"]).collect()


def upper(stat, dof):
    """Finite upper-tail sum; even dof."""
    x = stat / 2
    return sum(math.exp(k * math.log(x) - x - math.lgamma(k + 1)) for k in range(dof // 2))


def test_survival_of_small_and_large_statistics(spark):
    cases = [(60.0, 6), (0.5, 2), (7.0, 6), (9.9, 8), (250.0, 200), (150.0, 200), (3e9, 400), (1200.0, 1000), (1.0, 1), (3.841458820694124, 1), (30.0, 3)]
    df = spark.createDataFrame(cases, "s double, d long")
    got = [r[0] for r in df.select(chi2_survival(F.col("s"), F.col("d"))).collect()]
    for (s, d), p in zip(cases, got):
        if d % 2 == 0:
            want = upper(s, d)
        elif d == 1:
            want = math.erfc(math.sqrt(s / 2))
        else:
            want = math.erfc(math.sqrt(s / 2)) + math.sqrt(2 * s / math.pi) * math.exp(-s / 2)
        assert math.isclose(p, want, rel_tol=1e-8, abs_tol=1e-300), (s, d, p, want)


def test_products_of_one_population_count(spark):
    obs = spark.createDataFrame([("c", "A", 30), ("c", "B", 10), ("c", "only here", 1)], "cohort string, medication_product_name string, patient_count long")
    exp = spark.createDataFrame([("c", "A", 25.0), ("c", "B", 15.0), ("c", "only there", 4.0)], "cohort string, medication_product_name string, patient_count double")
    table = [(30, 25), (10, 15), (1, 0), (0, 4)]
    n, co, ce = 85, 41, 44
    want = sum((o - (o + e) * co / n) ** 2 / ((o + e) * co / n) + (e - (o + e) * ce / n) ** 2 / ((o + e) * ce / n) for o, e in table)
    r = chi_square(obs, exp).first()
    assert r.dof == 3 and math.isclose(r.chi2, want)
