"""Sharding by longest processing time (LPT).

Groups that must stay together are sorted by size, and each goes to the
least-loaded shard through a heap.  The heap runs over a *histogram* of group
sizes, whose row count is bounded by the size classes, not by the groups:
equal-sized groups are dealt in bulk to exactly the shards that a one-by-one
heap would have picked.  Spark then maps (size class, rank) to a shard.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.common import buckets_for, id_text, running, staged

#: group sizes under 2 ** (CLASS_BITS + 1) are classes of their own; larger
#: ones share a class within 2 ** -CLASS_BITS of their size.  At most about
#: 120 000 classes up to a terabyte.
CLASS_BITS = 12


def deal_equal(loads: list[tuple[int, int]], weight: int, count: int) -> dict[int, int]:
    """Give ``count`` items of equal ``weight`` to the least-loaded shards.

    ``loads`` is the heap of (load, shard), changed in place.  Same result as
    ``count`` single heap steps (ties to the smaller shard), in O(shards log).
    """
    given: dict[int, int] = dict.fromkeys((s for _, s in loads), 0)
    if count > 2 * len(loads):
        low, high = min(loads)[0], max(loads)[0] + weight * (count + 1)
        need = lambda level: sum(max(0, -(-(level - l) // weight)) for l, _ in loads)
        while low < high:  # the highest level that takes no more than count items
            mid = (low + high + 1) // 2
            low, high = (mid, high) if need(mid) <= count else (low, mid - 1)
        for i, (l, s) in enumerate(loads):
            given[s] = max(0, -(-(low - l) // weight))
            loads[i] = (l + given[s] * weight, s)
        heapq.heapify(loads)
        count -= sum(given.values())
    for _ in range(count):
        load, s = loads[0]
        heapq.heapreplace(loads, (load + weight, s))
        given[s] += 1
    return given


def plan_lpt(histogram: list[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    """From (class, groups, bytes): for each class the groups' ranks at which
    each next shard begins (cumulative counts by shard)."""
    loads = [(0, s) for s in range(shards)]
    plan = {}
    for cls, n, total in sorted(histogram, key=lambda h: -h[2] / h[1]):
        given = deal_equal(loads, max(1, round(total / n)), n)
        plan[cls] = np.cumsum([given[s] for s in range(shards)]).tolist()
    return plan


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every row of ``docs`` with its shard; law ``bytes`` (sizes near equal).

    Size: UTF-8 bytes of the text plus 16.  Rows with equal texts (null reads
    as empty) are one group and share a shard.  Repeated rows are rows of
    their own.  Null doc_ids are kept.  No rows in, no rows out.  ``slot``
    numbers a shard's rows from 0 without gaps.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null).
    """
    spark = docs.sparkSession
    rows = staged(
        id_text(docs).select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            (F.octet_length("text") + 16).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.unhex(F.sha2("text", 256)).alias("grp")),
        "shard-rows")
    bits = f"greatest(0, int(floor(log2(bytes))) - {CLASS_BITS})"
    groups = staged(
        rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .withColumn("cls", F.expr(f"shiftleft(shiftright(bytes, {bits}), {bits})")),
        "shard-groups")
    histogram = [tuple(r) for r in groups.groupBy("cls").agg(
        F.count("*"), F.sum("bytes")).collect()]  # bounded by the size classes
    n_groups = sum(n for _, n, _ in histogram)
    n_rows = rows.count()
    plan = plan_lpt(histogram, shards)
    steps = spark.createDataFrame(list(plan.items()), "cls long, ends array<long>")
    ranked = running(groups, ["cls"], "grp", buckets_for(n_groups), F.lit(1), "rank")
    assigned = staged(
        ranked.join(steps, "cls").select(
            "grp", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")),
        "shard-of-group")
    placed = rows.join(assigned, "grp")
    return running(placed, ["shard"], "row", buckets_for(n_rows), F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
