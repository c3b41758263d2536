"""Incremental ingest of order files.

The reference reads a large order file in chunks and joins each chunk to
the chosen products.  Here new files in a folder are a file-source stream;
each micro-batch is joined to the static product table (a stateless
stream-static inner join) and appended to a Parquet sink.  The checkpoint
folder makes the ingest restartable: files already processed are not read
again, and a lost executor only repeats the open micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import code_key

ORDER_SCHEMA = T.StructType([
    T.StructField("START", T.DateType(), True),
    T.StructField("PATIENT", T.StringType(), True),
    T.StructField("CODE", T.StringType(), True),
])


def start_order_ingest(spark: SparkSession, source_dir: str, chosen: DataFrame, sink_dir: str,
                       checkpoint: str, files_per_batch: int | None = None, available_now: bool = True):
    """Start the stream; returns the StreamingQuery.  ``chosen`` is a
    static DataFrame with (medication_product_name, code).  The columns of
    ``ORDER_SCHEMA`` are taken by name from the header; all files of the
    folder must have one header, and a file with another raises an error."""
    header = spark.read.option("header", True).csv(source_dir).schema
    reader = (spark.readStream.schema(header).option("header", True).option("enforceSchema", False)
              .option("mode", "FAILFAST").option("columnPruning", False))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    orders = reader.csv(source_dir).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_SCHEMA.fields])
    products = chosen.select("medication_product_name", code_key("code").alias("_product_code"))
    matched = orders.withColumn("_product_code", code_key("CODE")).join(products, "_product_code").drop("_product_code")
    writer = (matched.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", sink_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_order_ingest(spark: SparkSession, source_dir: str, chosen: DataFrame, sink_dir: str,
                     checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Process every file present now, then read the sink."""
    q = start_order_ingest(spark, source_dir, chosen, sink_dir, checkpoint, files_per_batch)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink_dir)
