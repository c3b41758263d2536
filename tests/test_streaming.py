"""The order ingest is incremental and restartable from its checkpoint."""

import tempfile

from pyspark.sql import functions as F

from inputs import SMALL
from popdist.plans.context import Context
from popdist.streaming.incremental import run_order_ingest


def test_restart_reads_only_new_files(spark):
    c = Context(spark, SMALL)
    meds = c.fx.medications
    chosen = c.all_ndc_rows().select("medication_product_name",
                                     F.col("medication_product_rxcui").alias("code")).distinct()
    src, sink, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ckpt-"))
    first = meds.where(F.col("START") < "1997-01-01")
    second = meds.where(F.col("START") >= "1997-01-01")
    first.repartition(3).write.mode("append").option("header", True).csv(src)
    out1 = run_order_ingest(spark, src, chosen, sink, ckpt, files_per_batch=1)
    n1 = out1.count()
    expected1 = first.join(chosen, first["CODE"] == chosen["code"]).count()
    assert n1 == expected1 > 0
    # new files arrive; the restarted query reads only those
    second.repartition(2).write.mode("append").option("header", True).csv(src)
    out2 = run_order_ingest(spark, src, chosen, sink, ckpt, files_per_batch=1)
    expected2 = expected1 + second.join(chosen, second["CODE"] == chosen["code"]).count()
    assert out2.count() == expected2
