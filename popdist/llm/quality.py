"""Document quality from a line-level conditional random field.

The field labels every line good or bad from its own and its neighbours'
features; a document's score is the length-weighted mean of the lines'
forward-backward marginals of "good".
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import slices, text_slices
from popdist.llm.crf import LineCrf, join_lines, line_features
from popdist.llm.labelled import SAMPLE_ROWS, held_out, labelled_lines

#: documents with a smaller score are rejected
THRESHOLD = 0.7
#: bytes of text whose lines are worked on at once
SLICE = 512 << 10


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> LineCrf:
    """Fitted on at most ``rows`` labelled documents (see ``labelled_lines``).
    With labels of one kind only, every text scores that label; with none, 0.5,
    and the model is not ``known``."""
    sample = labelled_lines(docs, labels, "quality", rows)
    texts = [t.encode() for t in sample.text]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    return LineCrf.fit(join_lines([line_features(texts[s]) for s in slices(sizes, SLICE)]), sample.label.to_numpy())


def scores(text: Column, model: LineCrf) -> Column:
    """The score of every whole text.  Only the text goes to Python, about
    ``SLICE`` bytes at a time are worked on; other columns stay in the JVM."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [model.score(line_features(texts)) for _, texts in text_slices(column, SLICE)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) of every row.

    One pass without shuffle.  A null text counts as empty; an empty text has
    one empty line, and so a score.  Repeated rows are scored each.
    """
    scored = docs.select("doc_id", scores(docs["text"], train(docs, labels, rows)).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged; all
    of them where there are no labels to learn from."""
    model = train(docs, labels, rows)
    return docs.where(scores(docs["text"], model) >= THRESHOLD) if model.known else docs
