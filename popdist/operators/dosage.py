"""Common quantity / days supply per product, and dosage instructions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dosage_frequency, dosage_period
from ..functions.text import text_greater, text_to_int_prefix


def rx_quantity_days(prescription: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Fill counts by (quantity, days supply, product name).

    The crosswalk is joined as is (a package with k ingredient rows counts
    k times).  Grouping is on the raw text of quantity and days, which are
    shown cast to integers -- two rows may therefore look equal.  The days
    filter compares text (``'00' > '0'``).  The product id is the smallest
    in the group.  Fills are counted per package code before the join, and the
    crosswalk's rows per (code, name), so neither a hot code nor a package
    with many rows multiplies fills."""
    rx = prescription.select("RXNDC", "RXQUANTY", "RXDAYSUP").where(text_greater("RXDAYSUP", "0"))
    fills = rx.groupBy("RXNDC", "RXQUANTY", "RXDAYSUP").agg(F.count(F.lit(1)).alias("_fills"))
    cw = crosswalk.groupBy("medication_ndc", "medication_product_name").agg(
        F.min("medication_product_rxcui").alias("medication_product_rxcui"), F.count(F.lit(1)).alias("_rows"))
    joined = fills.join(cw, fills["RXNDC"] == cw["medication_ndc"])
    grouped = joined.groupBy("RXQUANTY", "RXDAYSUP", "medication_product_name").agg(
        F.min("medication_product_rxcui").alias("medication_product_rxcui"),
        F.sum(F.col("_fills") * F.col("_rows")).alias("COUNT"))
    return grouped.select(
        text_to_int_prefix("RXQUANTY").alias("RXQUANTY"),
        text_to_int_prefix("RXDAYSUP").alias("RXDAYSUP"),
        "medication_product_rxcui", "medication_product_name", "COUNT")


def dosage_instructions(qty_days: DataFrame) -> DataFrame:
    """Per product id: the most common (quantity, days) -- ties broken by
    quantity, days and name -- turned into an instruction.  Products whose
    pick has quantity or days 0 get no instruction (left out)."""
    w = Window.partitionBy("medication_product_rxcui").orderBy(
        F.col("COUNT").desc(), F.col("RXQUANTY").asc(), F.col("RXDAYSUP").asc(),
        F.col("medication_product_name").asc())
    top = qty_days.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    top = top.where((F.col("RXQUANTY") != 0) & (F.col("RXDAYSUP") != 0))
    return top.select(
        "medication_product_rxcui", "medication_product_name", "RXQUANTY", "RXDAYSUP", "COUNT",
        F.lit(1).alias("amount"),
        dosage_frequency("RXQUANTY", "RXDAYSUP").alias("frequency"),
        dosage_period("RXQUANTY", "RXDAYSUP").alias("period"),
        F.lit("days").alias("unit"),
        F.col("RXDAYSUP").alias("duration_quantity"))
