"""Comparing a second population with the expected distribution.

Observed: orders of chosen products by young patients, counted per
product.  Expected: validation share x observed total, rounded half-even.
Goodness of fit: chi-square test of independence on the k x 2 table
(observed, expected), with the p-value from the regularised incomplete
gamma function written as a Spark expression (no driver round trip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import code_key
from ..session import staged

PEDIATRIC_AGE_DAYS = 2191  # under six years, in days


def observed_distribution(medications: DataFrame, patients: DataFrame, chosen: DataFrame,
                          max_age_days: int = PEDIATRIC_AGE_DAYS) -> DataFrame:
    """(cohort, medication_product_name, patient_count, percent).

    ``chosen`` has (cohort, medication_product_name, code), the code a product
    id.  Orders are joined to chosen products on the code and to patients on
    the patient id; the age at the order start must be below ``max_age_days``.
    The count is of orders (named patient_count, as in the reference).  The
    counts, one row per product, are staged; the totals are an aggregate of them."""
    chosen = chosen.select("cohort", "medication_product_name", code_key("code").alias("_code")).distinct()
    meds = medications.withColumn("_code", code_key("CODE")).join(chosen, "_code")
    pats = patients.select(F.col("Id").alias("PATIENT"), "BIRTHDATE")
    young = meds.join(pats, "PATIENT").where(
        F.datediff(F.col("START"), F.col("BIRTHDATE")) < F.lit(max_age_days))
    counts = staged(young.groupBy("cohort", "medication_product_name").agg(
        F.count(F.lit(1)).alias("patient_count")), "observed-counts")
    totals = counts.groupBy("cohort").agg(F.sum("patient_count").alias("total_patients"))
    return counts.join(totals, "cohort").select(
        "cohort", "medication_product_name", "patient_count",
        (F.col("patient_count").cast("double") / F.col("total_patients").cast("double")).alias("percent"))


def expected_counts(validation: DataFrame, observed: DataFrame, band: str = "0-5") -> DataFrame:
    """(cohort, medication_product_name, medication_ingredient_name,
    validation_percent_product_patients, patient_count): expected orders
    of each product in the band, given the observed total."""
    totals = observed.groupBy("cohort").agg(F.sum("patient_count").alias("total_patients"))
    rows = validation.where(F.col("age") == F.lit(band)).select(
        "cohort", "medication_product_name", "medication_ingredient_name",
        "validation_percent_product_patients")
    out = rows.join(totals, "cohort")
    return out.select(
        "cohort", "medication_product_name", "medication_ingredient_name",
        "validation_percent_product_patients",
        F.bround(F.col("validation_percent_product_patients") * F.col("total_patients"), 0)
        .alias("patient_count"))


def chi2_survival(stat: Column, dof: Column) -> Column:
    """P(X > stat) for X ~ chi-square(dof), by the regularised incomplete gamma
    function with s = dof/2 and x = stat/2.

    Up to x = s + 1: 1 - the power series sum_n exp(log t_n), log t_0 = s ln x -
    x - ln Gamma(s+1) and log t_n = log t_(n-1) + ln x - ln(s+n).  Beyond: the
    continued fraction of the upper tail (modified Lentz), times
    exp(s ln x - x - ln Gamma(s)), so small values keep their digits.  Both
    take a number of steps that follows the square root of dof, never stat."""
    x = (stat / 2).cast("double")
    s = (dof / 2).cast("double")
    # ln Gamma(s + 1) for integer or half-integer s
    k = F.ceil(s)
    ln_gamma = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.greatest(k - 1, F.lit(-1)).cast("long")),
        F.lit(0.0), lambda acc, j: acc + F.log(s - j))
    ln_gamma = ln_gamma + F.when(s != F.floor(s), F.lit(0.5) * F.log(F.lit(3.141592653589793))).otherwise(F.lit(0.0))
    log_t0 = s * F.log(x) - x - ln_gamma
    n_terms = (F.ceil(F.sqrt(s) * 15) + 200).cast("long")
    series = F.aggregate(
        F.sequence(F.lit(1).cast("long"), n_terms),
        F.struct(log_t0.alias("lt"), F.exp(log_t0).alias("acc")),
        lambda a, n: F.struct((a["lt"] + F.log(x) - F.log(s + n)).alias("lt"),
                              (a["acc"] + F.exp(a["lt"] + F.log(x) - F.log(s + n))).alias("acc")),
        lambda a: a["acc"])
    first = x + 1 - s

    def lentz(a: Column, i: Column) -> Column:
        an, b = -i * (i - s), a["b"] + 2
        d, c = an * a["d"] + b, b + an / a["c"]
        d = F.when(F.abs(d) < 1e-300, F.lit(1e-300)).otherwise(d)
        c = F.when(F.abs(c) < 1e-300, F.lit(1e-300)).otherwise(c)
        return F.struct(b.alias("b"), c.alias("c"), (1 / d).alias("d"), (a["h"] * c / d).alias("h"))

    fraction = F.aggregate(
        F.sequence(F.lit(1).cast("long"), n_terms),
        F.struct(first.alias("b"), F.lit(1e300).alias("c"), (1 / first).alias("d"), (1 / first).alias("h")),
        lentz, lambda a: a["h"])
    upper = F.exp(log_t0 + F.log(s)) * fraction
    return (F.when(x <= 0, F.lit(1.0)).when(x > s + 1, upper)
            .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - series)))


def contingency(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """The k x 2 table of the test, staged, with the counts that independence
    predicts: (cohort, medication_product_name, o_count, e_count, o_expected,
    e_expected, k).

    A product of one population only counts 0 in the other; products whose
    counts are both 0 are left out (their expected cell is 0)."""
    exp = expected.select("cohort", "medication_product_name", F.lit(0).cast("long").alias("o_count"),
                          F.col("patient_count").cast("double").alias("e_count"))
    obs = observed.select("cohort", "medication_product_name", F.col("patient_count").alias("o_count"),
                          F.lit(0.0).alias("e_count"))
    t = staged(obs.unionByName(exp).groupBy("cohort", "medication_product_name").agg(
        F.sum("o_count").alias("o_count"), F.sum("e_count").alias("e_count")
    ).where("o_count + e_count > 0"), "contingency")
    sums = t.groupBy("cohort").agg(
        F.sum("o_count").cast("double").alias("c_o"), F.sum("e_count").alias("c_e"), F.count("*").alias("k"))
    row, n = F.col("o_count") + F.col("e_count"), F.col("c_o") + F.col("c_e")
    return t.join(sums, "cohort").select(
        "cohort", "medication_product_name", "o_count", "e_count",
        (row * F.col("c_o") / n).alias("o_expected"), (row * F.col("c_e") / n).alias("e_expected"), "k")


def chi_square(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """(cohort, chi2, dof, p_value): test of independence on the ``contingency``
    table; with one degree of freedom the continuity correction is applied."""
    def cell(count: str, predicted: str) -> Column:
        diff = F.abs(F.col(count).cast("double") - F.col(predicted))
        corrected = F.when(F.col("k") == 2, F.greatest(diff - 0.5, F.lit(0.0))).otherwise(diff)
        return corrected * corrected / F.col(predicted)

    stat = contingency(observed, expected).groupBy("cohort").agg(
        F.sum(cell("o_count", "o_expected") + cell("e_count", "e_expected")).alias("chi2"), F.first("k").alias("k"))
    dof = (F.col("k") - 1).cast("long")
    return stat.select("cohort", "chi2", dof.alias("dof"), chi2_survival(F.col("chi2"), dof).alias("p_value"))
