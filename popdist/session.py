"""Session helpers: a local session for tests and benchmarks, and the shared
scratch folder that jobs use to cut lineage or stage files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  AQE re-plans joins from the
# real shuffle sizes (broadcast conversion, skew splitting, partition
# coalescing); ANSI stays on, so the code uses try_* functions where a value
# may not parse.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "popdist") -> SparkSession:
    """A local session as used by tests and bench.py (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (it has to be visible to every
    executor); only a local session gets a folder of its own under the
    system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="popdist-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for staged files."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read back: a
    cut in the lineage that every executor sees, and a table whose size Spark
    knows when it plans the joins after it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` into the session's number of shuffle partitions.
    Adaptive execution leaves these as they are, where it would merge the
    partitions of a join up to its advisory size, which counts compressed bytes:
    the hash tables and sorts after the join hold many times that.  For keys that
    no skew join has to split."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows from settings as a local relation: one plan node of known size,
    however many rows."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema), ddl)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

