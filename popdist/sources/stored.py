"""Stored tables: versioned, bucketed, switched at once.

``store`` writes a new version under a name of its own, bucketed and sorted by
the join key, and only then points the table's view at it.  Readers of the view
see the old version or the new one, never half of one; a failed write leaves
the view alone and its version is dropped.  Joins on the bucket key read the
buckets as they lie, without a shuffle on the stored side.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    from ..plans.module_build import BuildInputs

#: rows of a bucket that fit a task's memory when it is sorted and joined
ROWS_PER_BUCKET = 2_000_000


def versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of ``name``, whether the view shows them or not."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v"))


def store(df: DataFrame, name: str, key: str | Sequence[str], buckets: int | None = None, keep: int = 1) -> DataFrame:
    """Write ``df`` as the next version of the table ``name`` and switch to it.
    ``keep`` older versions stay for readers that still use them."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    if buckets is None:
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_BUCKET))
    numbers = [int(v.rsplit("_", 2)[-2]) for v in versions(spark, name)]
    version = f"{name}__v_{max(numbers, default=0) + 1:06d}_{uuid.uuid4().hex[:8]}"
    try:
        df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in versions(spark, name)[:-1 - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def stored_once(spark: SparkSession, name: str, build, key: str | Sequence[str], buckets: int | None = None) -> DataFrame:
    """The stored table ``name``; ``build`` makes it where there is none yet."""
    return spark.table(name) if spark.catalog.tableExists(name) else store(build(), name, key, buckets)


def stored_inputs(spark: SparkSession, inputs: "BuildInputs", prefix: str, buckets: int | None = None) -> "BuildInputs":
    """Build inputs that read stored tables: prescriptions and persons bucketed
    by person, the crosswalk by package code.  All have the same number of
    buckets, so a later build joins persons and packages where they lie."""
    once = lambda name, df, key: stored_once(spark, f"{prefix}_{name}", lambda: df, key, buckets)
    return replace(
        inputs, prescription=once("prescription", inputs.prescription, "DUPERSID"),
        demographics=once("demographics", inputs.demographics, "DUPERSID"),
        crosswalk=once("crosswalk", inputs.crosswalk, "medication_ndc"))
