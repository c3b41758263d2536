"""Cohorts: which packages (NDCs) a module covers.

Every frame here carries a ``cohort`` column so one job can build many
modules.  Settings lists become small keyed tables; membership tests are
semi / anti joins, never driver-side loops over data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import small_table, staged
from ..settings import INGREDIENT_TTYS, ModuleSettings
from ..sources.class_members import class_query_table, resolve_class_members

CROSSWALK_KEYS = ("medication_ingredient_rxcui", "medication_product_rxcui")


def id_table(spark: SparkSession, pairs: Sequence[tuple[str, str]], col: str = "rxcui") -> DataFrame:
    """(cohort, id) rows from settings lists."""
    return small_table(spark, list(pairs), f"cohort string, {col} string")


def cohort_ingredient_ids(spark: SparkSession, cohorts: Sequence[ModuleSettings],
                          class_members: DataFrame | None = None) -> DataFrame:
    """(cohort, rxcui): class members and listed ids to include, minus the
    class members and listed ids to exclude."""

    def side(which: str) -> DataFrame:
        listed = [(m.module_name, str(r)) for m in cohorts
                  for r in (getattr(m, f"rxcui_{which}") or ())]
        out = id_table(spark, listed)
        queries = [(m.module_name, q.class_id, q.relationship) for m in cohorts
                   for q in (getattr(m, f"rxclass_{which}") or ())]
        if queries:
            if class_members is None:
                raise ValueError("class queries need a class membership table")
            members = resolve_class_members(class_query_table(spark, queries), class_members)
            out = out.unionByName(members.select("cohort", "rxcui"))
        return out.distinct()

    include, exclude = side("include"), side("exclude")
    return include.join(exclude, ["cohort", "rxcui"], "left_anti")


def match_either_key(crosswalk: DataFrame, ids: DataFrame,
                     keys: Sequence[str] = CROSSWALK_KEYS) -> DataFrame:
    """Crosswalk rows whose ingredient id OR product id is in the cohort's
    list, tagged with the cohort.

    ``a IN L OR b IN L`` is written as equi-joins (a disjunctive join
    condition would plan as a nested loop): rows matched on the first key,
    plus rows matched on the second key and not on the first.  Each row
    comes once per cohort, as with a membership filter.
    """
    ids = ids.select("cohort", F.col("rxcui").alias("_id"))
    first, second = keys
    on_first = crosswalk.join(ids, crosswalk[first] == ids["_id"]).drop("_id")
    on_second = (crosswalk.join(ids, crosswalk[second] == ids["_id"]).drop("_id")
                 .join(ids.withColumnRenamed("_id", first), ["cohort", first], "left_anti"))
    return on_first.unionByName(on_second)


def distinct_products(rows: DataFrame) -> DataFrame:
    """(cohort, medication_product_rxcui) of matched rows."""
    return rows.select("cohort", "medication_product_rxcui").distinct()


def expand_by_product(crosswalk: DataFrame, matched: DataFrame) -> DataFrame:
    """All crosswalk rows that share a product with the matched rows.  This
    brings combination (MIN) rows in, and may bring excluded ingredients
    back through shared products (kept, as in the reference)."""
    products = distinct_products(matched).withColumnRenamed("medication_product_rxcui", "rxcui")
    return match_either_key(crosswalk, products)


# Total order for "one row per package": MIN before IN, then ids and names.
def resolve_order() -> list[Column]:
    return [
        F.col("medication_ingredient_tty").desc(),
        F.col("medication_ingredient_rxcui").asc(),
        F.col("medication_product_rxcui").asc(),
        F.col("medication_ingredient_name").asc(),
        F.col("medication_product_name").asc(),
        F.col("dose_form_name").asc_nulls_first(),
    ]


def resolve_one_per_ndc(rows: DataFrame, key: Sequence[str] = ("cohort", "medication_ndc")) -> DataFrame:
    """Keep one row per (cohort, NDC): the highest ingredient term type
    (MIN before IN), ties broken by ids and names.  A package has few
    crosswalk rows, so the window partitions stay small."""
    w = Window.partitionBy(*key).orderBy(*resolve_order())
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def filter_by_ingredient_tty(rows: DataFrame, cohorts: Sequence[ModuleSettings]) -> DataFrame:
    """Keep rows of the chosen ingredient term type; a filter value other
    than IN / MIN leaves the cohort unfiltered.  The filters are a keyed table,
    so the plan is the same for any number of cohorts."""
    wanted = id_table(rows.sparkSession, [(m.module_name, m.ingredient_tty_filter) for m in cohorts
                                          if m.ingredient_tty_filter in INGREDIENT_TTYS], "_wanted")
    kept = rows.join(wanted, "cohort", "left")
    return kept.where(F.col("_wanted").isNull() | (F.col("medication_ingredient_tty") == F.col("_wanted"))).select(*rows.columns)


def filter_by_dose_form(rows: DataFrame, cohorts: Sequence[ModuleSettings], dose_form_map: DataFrame,
                        method: str = "include") -> DataFrame:
    """Dose form filter.  A cohort's list names dose forms or dose form
    groups; the map (df, dfg) turns it into dose forms.  ``include`` keeps
    rows whose dose form is listed (an empty list keeps nothing);
    ``exclude`` drops them and keeps rows without a dose form; any other
    method, or a cohort without a list, is left unfiltered."""
    if method not in ("include", "exclude"):
        return rows
    listed = [m for m in cohorts if isinstance(m.dose_form_filter, (list, tuple))]
    if not listed:
        return rows
    spark = rows.sparkSession
    values = id_table(spark, [(m.module_name, v) for m in listed for v in m.dose_form_filter], "value")
    dmap = dose_form_map.select("df", "dfg")
    by_group = values.join(dmap, values["value"] == dmap["dfg"]).select("cohort", "df")
    by_form = values.join(dmap, values["value"] == dmap["df"]).select("cohort", "df")
    forms = (by_group.unionByName(by_form).distinct().withColumnRenamed("df", "dose_form_name")
             .withColumn("_listed", F.lit(True)))
    # Left joins against distinct keys never duplicate a row; a null form
    # matches nothing, as in a semi/anti join.
    names = small_table(spark, [(m.module_name, True) for m in listed], "cohort string, _filtered boolean")
    hit = F.col("_listed").isNotNull() if method == "include" else F.col("_listed").isNull()
    return (rows.join(forms, ["cohort", "dose_form_name"], "left").join(names, "cohort", "left")
            .where(F.col("_filtered").isNull() | hit)
            .select(*rows.columns))


def resolve_then_filter(rows: DataFrame, cohorts: Sequence[ModuleSettings],
                        dose_form_map: DataFrame) -> DataFrame:
    """One row per package, then the dose form and term-type filters --
    in that order, so a term-type filter of IN means "has no MIN row"."""
    one = resolve_one_per_ndc(rows)
    one = filter_by_dose_form(one, cohorts, dose_form_map)
    return filter_by_ingredient_tty(one, cohorts)


def cohort_ndc_rows(spark: SparkSession, crosswalk: DataFrame, cohorts: Sequence[ModuleSettings],
                    dose_form_map: DataFrame, class_members: DataFrame | None = None) -> DataFrame:
    """The chain of the module build: ids -> matched rows -> expanded by
    product -> one row per package -> filters.

    The two key lists, of ids and of products, are staged: each is joined three
    times, and Spark sees their sizes before it plans the joins."""
    ids = staged(cohort_ingredient_ids(spark, cohorts, class_members), "cohort-ids")
    products = staged(distinct_products(match_either_key(crosswalk, ids)), "cohort-products")
    expanded = match_either_key(crosswalk, products.withColumnRenamed("medication_product_rxcui", "rxcui"))
    return resolve_then_filter(expanded, cohorts, dose_form_map)


def whole_crosswalk(crosswalk: DataFrame, cohort: str) -> DataFrame:
    """Every crosswalk row as one cohort (the whole vocabulary)."""
    return crosswalk.withColumn("cohort", F.lit(cohort))
