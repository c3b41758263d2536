"""Lookup tables: the long form is the contract (one row per cell, written
partitioned by module and table); the wide form -- one column per
transition, missing cells 0 -- is produced per table on request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_name
from ..settings import AppSettings
from .distribution import ING, PROD, Distribution


def table_name(*parts: Column) -> Column:
    """``lower(normalize(concat(parts))) + '.csv'``."""
    return F.concat(normalize_name(F.concat(*parts), "lower"), F.lit(".csv"))


def transition_name(prefix: str, name: Column | str) -> Column:
    return normalize_name(F.concat(F.lit(prefix), F.col(name) if isinstance(name, str) else name))


def lookup_long(dist: Distribution, app: AppSettings = AppSettings()) -> DataFrame:
    """(cohort, lookup_table, demographics..., transition, probability)
    for the ingredient table and every product table of every module.
    Table and transition names are computed on the region-level rows,
    before the fan-out to states multiplies them."""
    ing = dist.ingredient_region.select(
        "cohort",
        table_name(F.col("cohort"), F.lit(app.ingredient_distribution_suffix)).alias("lookup_table"),
        *dist.rdemos,
        transition_name(app.state_prefix, ING).alias("transition"),
        F.col("percent").alias("probability"))
    prod = dist.product_region.select(
        "cohort",
        table_name(F.col("cohort"), F.lit("_"), F.col(ING),
                   F.lit(app.product_distribution_suffix)).alias("lookup_table"),
        *dist.rdemos,
        transition_name(app.state_prefix, PROD).alias("transition"),
        F.col("percent").alias("probability"))
    cols = ["cohort", "lookup_table", *dist.demos, "transition", "probability"]
    return dist.fan_out(ing).select(*cols).unionByName(dist.fan_out(prod).select(*cols))


def lookup_wide(long: DataFrame, demos: list[str], lookup_table: Column | None = None,
                transitions: list[str] | None = None) -> DataFrame:
    """Pivot one lookup table: a row per existing demographic group, one
    column per transition (name order), missing cells 0.

    The column list is the table's schema: either given (names that the table
    lacks are columns of 0, other names are an error), or left to Spark's
    pivot, which reads the distinct names of this one table first and fails
    beyond ``spark.sql.pivotMaxValues``.  Two cells of one group and one name
    are an error."""
    rows = long if lookup_table is None else long.where(lookup_table)
    if transitions is not None:
        other = F.raise_error(F.concat(F.lit("no such transition: "), F.col("transition"))).cast("string")
        rows = rows.withColumn("transition", F.when(F.col("transition").isin(transitions), F.col("transition")).otherwise(other))
    rows = rows.groupBy(*demos, "transition").agg(F.count("*").alias("_n"), F.first("probability").alias("probability"))
    twice = F.raise_error(F.concat(F.lit("two cells for "), F.col("transition"))).cast("double")
    rows = rows.withColumn("probability", F.when(F.col("_n") == 1, F.col("probability")).otherwise(twice))
    grouped = rows.groupBy(*demos)
    pivoted = grouped.pivot("transition", transitions) if transitions is not None else grouped.pivot("transition")
    wide = pivoted.agg(F.first("probability"))
    value_cols = [c for c in wide.columns if c not in demos]
    return wide.na.fill(0.0, subset=value_cols) if value_cols else wide
