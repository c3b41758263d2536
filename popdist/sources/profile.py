"""Row-count profile of loaded tables and match-count metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import small_table, staged


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count): one global count per table, in one plan."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def stored_row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, row_count) of Parquet tables, from the footers: the counts
    are pushed into the scans, no row group is read.  The reader that can do so
    is switched on in a session of its own; the caller's stays as it is."""
    rows = [(name, footer_count(spark, path).first().row_count) for name, path in paths.items()]
    return small_table(spark, rows, "table_name string, row_count long")


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``row_count``, planned with the aggregate in the scan."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


def match_counts(stages: Mapping[str, Callable[[DataFrame | None], DataFrame]], column: str = "medication_ndc") -> DataFrame:
    """(cohort, stage, ndc_count): non-null package codes after each step of a
    cohort chain, per cohort.

    ``stages`` are the steps in order, each a function of the rows that the step
    before left (None for the first).  Every step runs once: its rows are staged
    for the next step, and while they are written they are observed, so a step
    that leaves nothing is known without another read."""
    out, rows = None, None
    for stage, step in stages.items():
        seen = Observation(stage)
        rows = staged(step(rows).observe(seen, F.count(column).alias("n")), f"stage-{stage}")
        if not seen.get["n"] and out is not None:
            continue
        one = rows.groupBy("cohort").agg(F.count(column).alias("ndc_count")).select(
            "cohort", F.lit(stage).alias("stage"), "ndc_count")
        out = one if out is None else out.unionByName(one)
    return out
