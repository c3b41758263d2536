"""Writers.  Write errors raise (nothing is swallowed); every writer
replaces its target, like the reference's replace-on-write tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of ``write_csv``; names and fields are checked against ``schema``,
    except for partition folders, whose values end the rows."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
            .option("columnPruning", False).csv(path))


def write_lookup_long(long: DataFrame, path: str) -> None:
    """The long lookup table, one folder per module and lookup table (the
    reference writes one file per table after clearing old ones; a
    partitioned overwrite does both)."""
    (long.repartition("cohort", "lookup_table").write.mode("overwrite")
     .partitionBy("cohort", "lookup_table").option("header", True).csv(path))


def table_once(spark: SparkSession, name: str, build) -> DataFrame:
    """Load-if-absent: build and save the table only when the catalog does
    not have it yet, then read it (the existence check guards each load)."""
    if not spark.catalog.tableExists(name):
        build().write.mode("overwrite").format("parquet").saveAsTable(name)
    return spark.table(name)
