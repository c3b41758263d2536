"""Invariants of the distribution results."""

from pyspark.sql import functions as F

from inputs import SMALL
from popdist.plans.context import Context


def ctx(spark):
    return Context(spark, SMALL)


def test_shares_sum_to_one(spark):
    c = ctx(spark)
    ing = c.distribution(product_level=False).ingredient()
    sums = ing.where("total > 0").groupBy("age", "gender", "state").agg(
        F.sum("percent").alias("s"), F.count(F.lit(1)).alias("k"))
    bad = sums.where(F.abs(F.col("s") - 1.0) > F.col("k") * 0.0005 + 1e-9).count()
    assert bad == 0


def test_rollup_in_unit_interval(spark):
    r = ctx(spark).distribution().product_rollup()
    assert r.where((F.col("agg_percent_product_patients") < 0) | (F.col("agg_percent_product_patients") > 1)).count() == 0


def test_one_row_per_package(spark):
    rows = ctx(spark).module_ndc_rows()
    assert rows.groupBy("cohort", "medication_ndc").count().where("count > 1").count() == 0


def test_region_level_equals_fan_out_first(spark):
    """Aggregating per region and fanning out equals fanning out first."""
    c = ctx(spark)
    d = c.distribution(product_level=False)
    fast = d.ingredient().drop("cohort")
    states_ = c.fx.region_states.withColumnRenamed("region_value", "region_num")
    naive_rows = (d.joined.join(states_, "region_num")
                  .select("medication_ingredient_name", "medication_ingredient_rxcui", "person_weight",
                          "DUPERSID", "age", "gender", "state").distinct()
                  .groupBy("medication_ingredient_name", "age", "gender", "state")
                  .agg(F.sum("person_weight").alias("weighted")))
    a = sorted((r[0], r[1], r[2], r[3], r[4]) for r in fast.select(
        "medication_ingredient_name", "age", "gender", "state", "weighted").collect())
    b = sorted((r[0], r[1], r[2], r[3], r[4]) for r in naive_rows.collect())
    assert a == b


def test_fractional_text_weights_sum_exactly(spark):
    """Survey weights read as text become decimals and sum without loss."""
    from decimal import Decimal

    from popdist.operators.distribution import Distribution

    demo = spark.createDataFrame(
        [("p1", "1234.567891", "1", 30, 1), ("p2", "0.000001", "2", 31, 1), ("p3", "10.5", "9", 40, 1)],
        "DUPERSID string, PERWTF string, SEX string, AGELAST int, REGION int")
    rx = spark.createDataFrame([("p1", "n1"), ("p1", "n1"), ("p2", "n1"), ("p3", "n2")], "DUPERSID string, RXNDC string")
    ndc = spark.createDataFrame(
        [("c", "n1", "A", "I-A", "P1", "P-1"), ("c", "n2", "A", "I-A", "P2", "P-2")],
        "cohort string, medication_ndc string, medication_ingredient_name string, medication_ingredient_rxcui string, "
        "medication_product_name string, medication_product_rxcui string")
    states_ = spark.createDataFrame([(1, "S1"), (1, "S2")], "region_value int, state string")
    d = Distribution(rx, demo, ndc, states_, age=False, gender=False, state=True)
    rows = {(r.state): r for r in d.ingredient().collect()}
    assert rows["S1"].weighted == Decimal("1234.567891") + Decimal("0.000001") + Decimal("10.5")
    assert rows["S1"].percent == 1.0
    prod = {(r.medication_product_name, r.state): r.weighted for r in d.product().collect()}
    assert prod[("P1", "S2")] == Decimal("1234.567892")


def test_hot_person_matches_brute_force(spark):
    """One person holds most prescription rows.  With broadcasts off and
    low skew thresholds (sort-merge joins, AQE skew handling), the weighted
    shares equal a plain computation from the definition: no row lost,
    no person counted twice for an item."""
    from decimal import ROUND_HALF_EVEN, Decimal

    from popdist.operators.distribution import Distribution
    from popdist.sources.dimensions import band_bounds

    bands = ("0-17", "18-64", "60-99")  # 60-64 lies in two bands
    people = [(f"p{i}", str(10 + 7 * i), ("1", "2", "9")[i % 3], (5 * i) % 90, 1 + i % 3) for i in range(40)]
    ndcs = [(f"n{k}", ("Alpha", "Beta", "Gamma", "Delta")[k % 4]) for k in range(8)]
    rx = [("p0", f"n{k % 8}") for k in range(400)]  # the hot person: 400 of 560 rows
    rx += [(f"p{i}", f"n{(i * j) % 9}") for i in range(1, 40) for j in range(4)] + [("p7", "n3")] * 4
    region_states = [(1, "S1"), (2, "S2"), (2, "S3")]  # region 3 has no state

    demo = spark.createDataFrame(people, "DUPERSID string, PERWTF string, SEX string, AGELAST int, REGION int")
    pres = spark.createDataFrame(rx, "DUPERSID string, RXNDC string")
    ndc = spark.createDataFrame(
        [("c", n, ing, "I-" + ing, "P-" + n, "P-" + n) for n, ing in ndcs],
        "cohort string, medication_ndc string, medication_ingredient_name string, "
        "medication_ingredient_rxcui string, medication_product_name string, medication_product_rxcui string")
    states = spark.createDataFrame(region_states, "region_value int, state string")

    # brute force from the definition
    ing_of = dict(ndcs)
    person = {p: (Decimal(w), {"1": "M", "2": "F"}.get(s, "None"), a, r) for p, w, s, a, r in people}
    x: dict = {}
    for p, i in {(p, ing_of[n]) for p, n in rx if n in ing_of}:
        w, g, a, r = person[p]
        for name, lo, hi in band_bounds(bands):
            if lo <= a <= hi:
                for rv, st in region_states:
                    if rv == r:
                        x[(i, name, g, st)] = x.get((i, name, g, st), 0) + w
    total: dict = {}
    for (i, b, g, st), v in x.items():
        total[(b, g, st)] = total.get((b, g, st), 0) + v

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        d = Distribution(pres, demo, ndc, states, bands=bands, product_level=False)
        got = {(r.medication_ingredient_name, r.age, r.gender, r.state): r for r in d.ingredient().collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

    assert set(got) == set(x)
    for key, v in x.items():
        r = got[key]
        t = total[key[1:]]
        assert Decimal(r.weighted) == v and Decimal(r.total) == t
        expect = (v / t).quantize(Decimal("0.001"), rounding=ROUND_HALF_EVEN) if t else Decimal(0)
        assert abs(Decimal(repr(r.percent)) - expect) <= Decimal("0.001")


def test_hot_patient_observed_counts_match_brute_force(spark):
    """Observed order counts with one patient and one product code holding
    most orders, under sort-merge joins and AQE skew handling."""
    import datetime as dt

    from popdist.operators.validation import PEDIATRIC_AGE_DAYS, observed_distribution

    born = {f"a{i}": dt.date(2020, 1, 1) + dt.timedelta(days=97 * i) for i in range(30)}
    meds = [(dt.date(2021, 1, 1) + dt.timedelta(days=k % 50), "a0", 100) for k in range(300)]
    meds += [(dt.date(2020, 6, 1) + dt.timedelta(days=211 * i + j), f"a{i}", 100 + (i + j) % 5)
             for i in range(1, 30) for j in range(5)]
    meds += [(dt.date(2022, 1, 1), "ghost", 100)]  # no patient row
    chosen = [("c", "Prod A", 100), ("c", "Prod B", 101), ("c", "Prod B", 101), ("d", "Prod A", 100),
              ("d", "Prod C", 103)]

    expect: dict = {}
    for start, pat, code in meds:
        if pat not in born or (start - born[pat]).days >= PEDIATRIC_AGE_DAYS:
            continue
        for cohort, prod, c in set(chosen):
            if c == code:
                expect[(cohort, prod)] = expect.get((cohort, prod), 0) + 1

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = observed_distribution(
            spark.createDataFrame(meds, "START date, PATIENT string, CODE bigint"),
            spark.createDataFrame(list(born.items()), "Id string, BIRTHDATE date"),
            spark.createDataFrame(chosen, "cohort string, medication_product_name string, code bigint"))
        got = {(r.cohort, r.medication_product_name): r for r in out.collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

    assert {k: r.patient_count for k, r in got.items()} == expect
    for (cohort, prod), r in got.items():
        total = sum(v for (c, _), v in expect.items() if c == cohort)
        assert abs(r.percent - expect[(cohort, prod)] / total) < 1e-12
