"""The bounded sample of labelled documents that the classifiers learn from."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled rows to learn from, at most; and the code points learnt of one text
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 8_000
#: code points of a piece of a line of a longer text
PIECE_CHARS = 1_000


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learnt: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def some_lines(text: str, chars: int = SAMPLE_CHARS) -> str:
    """``text``, or of a longer one lines from all over it, chosen by a hash of
    place and content, in order, together at most ``chars`` code points; lines
    longer than ``PIECE_CHARS`` are cut into pieces."""
    if len(text) <= chars:
        return text
    size = min(PIECE_CHARS, chars)
    pieces = [line[i:i + size] for line in text.split("\n") for i in range(0, len(line) or 1, size)]
    dealt = sorted(range(len(pieces)), key=lambda i: (zlib.crc32(pieces[i].encode(), zlib.crc32(str(i).encode())), i))
    chosen, left = [], chars + 1
    for i in dealt:
        if len(pieces[i]) + 1 > left:
            break
        chosen.append(i)
        left -= len(pieces[i]) + 1
    return "\n".join(pieces[i] for i in sorted(chosen))


def labelled_lines(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS,
                   chars: int = SAMPLE_CHARS) -> pd.DataFrame:
    """(text, label) of at most ``rows`` rows that are not held out, chosen by
    a hash of doc_id among all labelled documents; of texts longer than
    ``chars`` code points, ``some_lines``.  A document with several labels has
    their largest."""
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([some_lines(t.as_py(), chars) for t in column], pa.string())

    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    # labels of documents that are not there take no place
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    some = known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(some), "doc_id")
    shorten = F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)
    return texts.select("doc_id", "label", shorten("text").alias("text")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).select("text", "label").toPandas()
