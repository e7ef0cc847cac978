"""Quality classifier: supervised subword embeddings with a softmax output.

Learned hashed word and character n-gram vectors are averaged per document; the
softmax layer and the vectors are trained by numpy stochastic gradient descent on
a bounded sample of labelled rows (``max_train``, the rows of smallest id hash).
Only the text enters a score.  Scoring covers every whole text.

Cases: a null or empty text has no features and scores the share the softmax
gives to a zero vector (0.5); an id without a label, a null label or a null id
is not learned from; repeated rows and repeated labels are scored and learned as
often as they occur; with no label to learn from every score is 0.5; columns of
the input other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, give_back, held_out
from .subword import Features, bags, logits, softmax, train

SPEC = Features(ngrams=(3, 4), words=True, letters=False, bits=18, repeats=True)
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    table: np.ndarray
    spec: Features

    def scores(self, texts) -> np.ndarray:
        return softmax(logits(list(texts), self.table, self.spec))[:, 1]


def labelled_sample(docs: DataFrame, labelled: DataFrame, label: str, max_train: int) -> list[tuple[int, str | None]]:
    """(label, text) of at most ``max_train`` rows of the learning folds, in a fixed order.

    ``labelled``: (doc_id, label).  The ids are chosen from the labels alone, so
    the texts are read once and only the chosen ones leave the scan.
    """
    spark = docs.sparkSession
    ids = labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("_y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(max_train).collect()
    chosen = spark.createDataFrame(ids, "doc_id bigint, _y string") if ids else None
    if chosen is None:
        return []
    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")  # max_train rows at most
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_y", "text")
        .limit(max_train)
        .select("_y", "text")
        .collect()
    )
    return [(r[0], r[1]) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = 3000, spec: Features = SPEC, epochs: int = 5) -> QualityModel:
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").cast("string").alias("_l"))
    rows = labelled_sample(docs, labels, "_l", max_train)
    y = np.array([int(v) for v, _ in rows], int)
    found = bags([t for _, t in rows], spec)
    del rows
    table = train(found, y, 2, spec, epochs=epochs)
    del found
    give_back()
    return QualityModel(table, spec)


def score_column(model: QualityModel, text: Column) -> Column:
    """The score as a column; the model (1 M values of the folded table) goes out with the task."""
    table, spec = model.table, model.spec

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = QualityModel(table, spec)
        for texts in batches:
            parts = [fitted.scores(texts.slice(at, SLICE_ROWS).to_pylist()) for at in range(0, len(texts), SLICE_ROWS)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())
            give_back()

    return score(text)


def classify(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
