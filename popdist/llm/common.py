"""Helpers that the operators share: staged tables, ranks without hot tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain, count

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popdist.session import scratch_path

#: stands for a null id inside the operators: sorts before every real id
NO_ID = -(2 ** 63)


#: paths staged inside the open ``freed`` blocks, innermost last
_OPEN: list[list[str]] = []
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage in a place that every executor sees, so a lost executor
    costs only the tasks it ran; unlike an RDD checkpoint, later reads still
    prune columns and push filters down.  The shuffle files of the job go when
    it has ended: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    if _OPEN:
        _OPEN[-1].append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


@contextmanager
def freed(spark: SparkSession):
    """Tables staged inside the block are deleted at its end, but for those
    handed, as ``staged`` returned them, to the function that it yields.  For operators that reduce many
    staged tables to one that is staged as well: nothing that leaves the block
    may read the others.  After an error they stay."""
    paths: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.staged_path)
        return df

    _OPEN.append(paths)
    try:
        yield keep
    finally:
        _OPEN.remove(paths)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        if path in kept:
            if _OPEN:
                _OPEN[-1].append(path)
        else:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, or the first of ``name1``, ``name2``, ... that ``columns`` lack."""
    taken = {c.lower() for c in columns}
    return next(n for n in chain([name], (f"{name}{i}" for i in count(1))) if n.lower() not in taken)


def numbered(docs: DataFrame, name: str, row: str = "_row") -> DataFrame:
    """``docs`` with a unique long column ``row``, staged, so that every later
    read sees the same numbers; ids and texts may repeat, numbers never do."""
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), name)


#: row numbers of at most this many rows are broadcast: 8 bytes each, 16 MB
BROADCAST_ROWS = 2_000_000


def _packed(batches: Iterator[pa.RecordBatch], column: str):
    for b in batches:
        squeezed = pa.array([None if t is None else zstandard.compress(t, 1) for t in b.column(column).cast(pa.binary()).to_pylist()], pa.binary())
        yield b.set_column(b.schema.get_field_index(column), column, squeezed)


def _unpacked(batches: Iterator[pa.RecordBatch], column: str):
    for b in batches:
        plain = pa.array([None if t is None else zstandard.decompress(t) for t in b.column(column).to_pylist()], pa.binary())
        yield b.set_column(b.schema.get_field_index(column), column, plain.cast(pa.string()))


def by_rows(docs: DataFrame, rows: DataFrame, row: str, how: str) -> DataFrame:
    """Semi or anti join (``how``) of ``docs`` with the numbers ``rows``, a
    staged table with the one column ``row``.

    Few numbers are broadcast, after they have been counted.  More of them meet
    the documents in a shuffle, which moves the texts compressed."""
    if rows.count() <= BROADCAST_ROWS:
        return docs.join(F.broadcast(rows), row, how)
    kind = dict(docs.dtypes).get("text")
    if kind != "string":
        return docs.join(rows.hint("merge"), row, how)
    schema = docs.schema
    narrow = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in schema])
    moved = docs.mapInArrow(lambda it: _packed(it, "text"), narrow).join(rows.hint("merge"), row, how)
    return moved.select(*docs.columns).mapInArrow(lambda it: _unpacked(it, "text"), schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): extra columns dropped, a null text read as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))


def buckets_for(n_rows: int, per_bucket: int = 50_000, least: int = 64) -> int:
    """A bucket count that grows with the input, so buckets stay bounded."""
    return max(least, -(-int(n_rows) // per_bucket))


def bucket(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def running(df: DataFrame, cls: list[str], order: str, n_buckets: int,
            value: Column, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same class that come
    before, 0-based and gapless over the class (ranks when ``value`` is 1).

    Two levels, so a class with a third of all rows is never one task: a
    running sum inside (class, hash bucket), plus the buckets' offsets.
    ``order`` must be unique.
    """
    spread = df.withColumn("_b", bucket(n_buckets, order)).withColumn("_v", value.cast("long"))
    keys = [*cls, "_b"]
    inner = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("_l", F.coalesce(F.sum("_v").over(inner), F.lit(0)))
    sums = spread.groupBy(*keys).agg(F.sum("_v").alias("_s"))
    over = (Window.partitionBy(*cls) if cls else Window.partitionBy(F.lit(0))) \
        .orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_s").over(over), F.lit(0)).alias("_o"))
    return (local.join(offsets, keys)
            .withColumn(out, F.col("_l") + F.col("_o"))
            .drop("_b", "_v", "_l", "_o"))
