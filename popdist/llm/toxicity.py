"""Toxicity from a bidirectional gated recurrent network over word windows.

Trained in numpy on a bounded sample of labelled documents (see ``gru.fit``);
scoring reads all overlapping windows of every whole text, in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import text_slices
from popdist.llm.gru import BiGru, fit
from popdist.llm.labelled import held_out, labelled_lines

#: labelled rows to learn from, at most
SAMPLE_ROWS = 3_000
#: documents with at least this score are toxic
THRESHOLD = 0.3


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> BiGru:
    """Fitted on at most ``rows`` labelled documents, of long ones on lines from
    all over them.  With no labels, or one kind only, every text scores alike."""
    sample = labelled_lines(docs, labels, "toxic", rows)
    return fit([t.encode() for t in sample.text], sample.label.to_numpy())


def score(docs: DataFrame, net: BiGru) -> DataFrame:
    """(doc_id, score) of every row: the score of its worst window.

    A null text counts as empty; a text without words scores the base rate of
    the labels.  Repeated rows are scored each.
    """
    source = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            for s, texts in text_slices(b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.start, len(texts)), pa.array(np.asarray(net.score(texts), dtype=float))], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    return score(docs, train(docs, labels, rows)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
