"""Exact dedup against immutable snapshots.

A snapshot is a table of digests (with the row that stays and the group's
size), split into exact buckets by digest, and one static binary-fuse filter
per bucket.  An incoming batch is grouped by digest on its own; the filters
then screen its distinct digests, and only the positives go on to the
snapshot's exact buckets.  Rows that share a digest are compared byte by byte.

Texts are equal when identical after lower-casing A-Z only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.common import NO_ID, bucket, buckets_for, by_rows, freed, id_text, numbered, staged, unused

@dataclass(frozen=True)
class Snapshot:
    """``groups``: one row per digest; ``filters``: one row per bucket."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def _id_text(docs: DataFrame, row: str | None) -> DataFrame:
    """(doc_id, text) as ``id_text``, and ``row`` where a column names the rows."""
    if row is None:
        return id_text(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"), F.col(row).alias("row"))


def _normalised(batches: Iterator[pa.RecordBatch], keep_text: bool):
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        low = [t.lower() for t in texts]  # bytes.lower() changes A-Z only
        cols = {c: b.column(c) for c in b.schema.names if c != "text"}
        cols |= {"sha": pa.array([hashlib.sha256(t).digest() for t in low], pa.binary())}
        if keep_text:
            cols |= {"body": pa.array(low, pa.binary())}
        yield pa.RecordBatch.from_pydict(cols)


def _numbered(rows: DataFrame, digest_bytes: int, *more: str) -> DataFrame:
    row = F.col("row") if "row" in rows.columns else F.monotonically_increasing_id()
    return rows.select(
        row.alias("row"), "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "sha",
        F.substring("sha", 1, digest_bytes).alias("digest"), *more)


def _kinds(row: str | None) -> str:
    return "doc_id long, sha binary" if row is None else "doc_id long, row long, sha binary"


def digests(docs: DataFrame, digest_bytes: int = 32, row: str | None = None) -> DataFrame:
    """(row, doc_id, k, sha, digest) of every row, staged; k is doc_id or
    NO_ID, digest the first ``digest_bytes`` of the text's SHA-256."""
    rows = _id_text(docs, row).mapInArrow(lambda it: _normalised(it, False), _kinds(row))
    return staged(_numbered(rows, digest_bytes), "dedup-digests")


def group_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """New duplicates grouped on their own: one row per digest of ``rows``."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("k", "row")).alias("top"), F.count("*").alias("n")
    ).withColumn("bucket", bucket(buckets, "digest"))


def _keys(digest: pd.Series) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(d, digest_size=8).digest(), "little")
                     for d in digest], dtype=np.uint64)


def build_snapshot(rows: DataFrame, buckets: int) -> Snapshot:
    """The snapshot of ``rows`` (see ``digests``); written once, never changed."""
    from popdist.llm.fuse import BinaryFuse

    def build(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(part.bucket.iloc[0], *BinaryFuse.build(_keys(part.digest)).to_row())],
                            columns=["bucket", "seed", "segment", "span", "cells"])

    groups = staged(group_digests(rows, buckets), "dedup-snapshot")
    filters = groups.select("bucket", "digest").groupBy("bucket").applyInPandas(
        build, "bucket int, seed long, segment long, span long, cells binary")
    return Snapshot(groups, staged(filters, "dedup-filters"), buckets)


def screen(snapshot: Snapshot, incoming: DataFrame) -> DataFrame:
    """``incoming`` (one row per digest) with ``maybe``: false where the
    bucket's filter proves that the snapshot lacks the digest."""
    from popdist.llm.fuse import BinaryFuse

    def test(filters: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        maybe = np.zeros(len(part), dtype=bool)
        if len(filters) and len(part):
            f = filters.iloc[0]
            maybe = BinaryFuse.from_row(f.seed, f.segment, f.span, f.cells).might_contain(_keys(part.digest))
        return pd.DataFrame({"digest": part.digest, "maybe": maybe})

    told = snapshot.filters.groupBy("bucket").cogroup(
        incoming.select("bucket", "digest").groupBy("bucket")
    ).applyInPandas(test, "digest binary, maybe boolean")
    return incoming.join(told, "digest")


def merge_batch(snapshot: Snapshot, incoming: DataFrame) -> DataFrame:
    """Groups (digest, top, n, bucket) of the snapshot and the batch together."""
    screened = staged(screen(snapshot, incoming), "dedup-screened")
    positives = screened.where("maybe").select(
        "digest", F.col("top").alias("b_top"), F.col("n").alias("b_n"))
    old = snapshot.groups.join(positives, "digest", "left").select(
        "digest", F.greatest("top", F.coalesce("b_top", "top")).alias("top"),
        (F.col("n") + F.coalesce("b_n", F.lit(0))).alias("n"), "bucket")
    false_positives = screened.where("maybe").join(
        snapshot.groups.select("digest"), "digest", "left_anti")
    new = screened.where("not maybe").unionByName(false_positives).drop("maybe")
    return old.unionByName(new.select(*old.columns))


def check_bytes(docs: DataFrame, rows: DataFrame, multi: DataFrame, digest_bytes: int, row: str | None = None) -> DataFrame:
    """The rows of digests in ``multi``, as (row, doc_id, k, digest, alt, sha).

    ``alt`` is null where the text equals its group's first text byte by byte;
    a colliding text carries itself, so (digest, alt) separates unequal texts.
    """
    members = rows.join(multi.select("digest"), "digest", "left_semi")
    if row is None:
        ids = staged(members.select("k").distinct(), "dedup-members")
        texts = by_rows(id_text(docs).withColumn("k", F.coalesce("doc_id", F.lit(NO_ID))), ids, "k", "left_semi").select("doc_id", "text")
    else:
        texts = by_rows(_id_text(docs, row), staged(members.select("row"), "dedup-members"), "row", "left_semi").select(
            "doc_id", "text", "row")
    bodies = staged(_numbered(
        texts.mapInArrow(lambda it: _normalised(it, True), f"{_kinds(row)}, body binary"),
        digest_bytes, "body"), "dedup-bodies")
    first = bodies.join(multi.select("digest", F.col("top.k").alias("k")), ["digest", "k"]) \
        .groupBy("digest").agg(F.min("body").alias("first_body"))
    # joined after staging, so that a hot group is split by the skew join
    return staged(
        bodies.join(staged(first, "dedup-first"), "digest").select(
            "row", "doc_id", "k", "digest",
            F.when(F.col("body") != F.col("first_body"), F.col("body")).alias("alt"), "sha"),
        "dedup-checked")


def dedup(docs: DataFrame, in_snapshot=None, digest_bytes: int = 32, row: str | None = None) -> DataFrame:
    """Which rows of ``docs`` stay.

    Rows where the column ``in_snapshot`` (default: half of the doc_ids, by
    hash) holds form the snapshot, the others the incoming batch; the result
    does not depend on that split.  Null texts count as empty.  Of equal texts
    the row with the largest doc_id stays; of rows that repeat that doc_id,
    one.  A null doc_id sorts below all others.
    Columns: doc_id, keep_id, group_size, kept, text_sha256; and ``row``, if
    ``row`` names a column of ``docs`` with unique, staged numbers.
    """
    own = () if row is None else ("row",)
    rows = digests(docs, digest_bytes, row)
    split = F.pmod(F.xxhash64("k"), F.lit(2)) == 0 if in_snapshot is None else in_snapshot
    buckets = buckets_for(rows.count(), per_bucket=16_384)
    snapshot = build_snapshot(rows.where(split), buckets)
    incoming = staged(group_digests(rows.where(~split), buckets), "dedup-incoming")
    groups = staged(merge_batch(snapshot, incoming), "dedup-groups")
    multi = groups.where("n > 1")

    single = rows.join(multi.select("digest"), "digest", "left_anti")
    checked = check_bytes(docs, rows, multi, digest_bytes, row)
    classes = staged(
        checked.groupBy("digest", "alt").agg(
            F.max(F.struct("k", "row")).alias("top"), F.count("*").alias("n")), "dedup-classes")
    plain = classes.where("alt is null").drop("alt")
    told = lambda d: d.select(
        "doc_id", F.when(F.col("top.k") != NO_ID, F.col("top.k")).alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("k") == F.col("top.k")) & (F.col("row") == F.col("top.row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *own)
    return (
        single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                      F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), *own)
        .unionByName(told(checked.where("alt is null").join(plain, "digest")))
        .unionByName(told(checked.where("alt is not null").join(classes, ["digest", "alt"]))))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``dedup`` drops; all columns kept."""
    row = unused(docs.columns, "_row")
    rows = numbered(docs, "dedup-rows", row)
    with freed(docs.sparkSession) as keep:
        gone = keep(staged(dedup(rows, row=row).where("not kept").select(F.col("row").alias(row)), "dedup-gone"))
    return by_rows(rows, gone, row, "left_anti").select(*docs.columns)
