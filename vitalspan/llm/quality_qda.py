"""Quality by regularised quadratic discriminant analysis.

Each class of labelled documents is a normal distribution over transformed counts of the text. Its
covariance is shrunk towards a multiple of the pooled variances, and factored once; a score is the
difference of two log-densities, which are Mahalanobis distances under the cached factors, turned
into a probability. The sums behind means and covariances are one aggregate over labelled rows.

Only counts of the text are inputs. Null and empty texts have zero counts and are scored like any
other. Labels other than 0 and 1, null labels and labels of unknown documents are not used;
repeated ones count each time. With one class only, its prior decides; without labels every score
is one half. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import batch, documents, importable, written
from vitalspan.llm.statistics import text_statistics

FEATURES = [
    "log_words", "word_length", "symbols", "marks", "capitals", "repeats", "lines_again",
    "digits", "variety", "stops", "line_words",
]

#: Share of a class's covariance that comes from the diagonal target.
SHRINKAGE = 0.1

#: From this score on a document is taken for good.
THRESHOLD = 0.3


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """A row of transformed counts for each text. Square roots even out the spread of rates."""
    words = np.maximum(counts["n_words"], 1).astype(float)
    chars = np.maximum(counts["word_chars"], 1).astype(float)
    return np.stack(
        [
            np.log1p(counts["n_words"]),
            np.log1p(counts["word_chars"] / words),
            np.sqrt(counts["n_symbols"] / words),
            np.sqrt(counts["n_marks"] / words),
            np.sqrt(counts["n_upper"] / chars),
            np.sqrt(counts["n_repeat_words"] / words),
            np.sqrt(counts["n_dup_lines"] / words),
            np.sqrt(counts["n_digits"] / chars),
            np.log1p(counts["n_distinct_words"]) - np.log1p(counts["n_words"]),
            np.sqrt(counts["n_stops"] / words),
            np.log1p(words / np.maximum(counts["n_lines"], 1)),
        ],
        axis=1,
    )


@dataclass
class Model:
    """For each class: log prior and log-determinant term, mean, inverse Cholesky factor."""

    constants: np.ndarray
    means: list[np.ndarray]
    inverses: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        logs = [
            c - 0.5 * np.square((x - m) @ w.T).sum(axis=1)
            for c, m, w in zip(self.constants, self.means, self.inverses)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fitted(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Model:
    """The model from each class's rows, feature sums and sums of products."""
    size = sums.shape[1]
    total = max(counts.sum(), 1.0)
    means = sums / np.maximum(counts, 1)[:, None]
    spread = products.sum(axis=0) / total - np.outer(sums.sum(0), sums.sum(0)) / total**2
    target = np.diag(np.maximum(np.diag(spread), 1e-6))
    constants, inverses = [], []
    for k in range(2):
        own = products[k] / max(counts[k], 1) - np.outer(means[k], means[k])
        scale = np.trace(np.linalg.solve(target, own)) / size
        shrunk = (1 - SHRINKAGE) * own + SHRINKAGE * max(scale, 0.05) * target
        factor = np.linalg.cholesky(shrunk)
        inverses.append(np.linalg.inv(factor))
        constants.append(np.log((counts[k] + 1) / (total + 2)) - np.log(np.diag(factor)).sum())
    if counts.min() == 0:
        # a class without rows has no shape: the priors alone decide
        inverses = [np.zeros((size, size))] * 2
        constants = np.log((counts + 1) / (counts.sum() + 2))
    return Model(np.array(constants), list(means), inverses)


def held_out(doc_id: Column) -> Column:
    """A fifth of all documents, by a hash of their ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def with_features(docs: DataFrame) -> DataFrame:
    """Document ids and features, without the texts."""
    importable(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *[(f, pa.float64()) for f in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = features(text_statistics(rows.column(1)))
            yield batch(schema, [rows.column(0), *x.T])

    columns = ", ".join(f"{f} double" for f in FEATURES)
    return documents(docs).mapInArrow(run, f"doc_id long, {columns}")


def fit(table: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows of a feature table that are not held out.

    Only one row of sums for each class comes to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), "quality")
    rows = table.filter(~held_out(F.col("doc_id"))).join(
        known.filter(F.col("quality").isin(0, 1)), F.col("doc_id") == F.col("l_id")
    )
    n = len(FEATURES)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    sums = rows.groupBy("quality").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(f) for f in FEATURES]).alias("x"),
        F.array(*[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs]).alias("xx"),
    )
    counts, first, second = np.zeros(2), np.zeros((2, n)), np.zeros((2, n, n))
    for row in sums.collect():
        k = int(row["quality"])
        counts[k], first[k] = row["n"], row["x"]
        for (i, j), value in zip(pairs, row["xx"]):
            second[k, i, j] = second[k, j, i] = value
    return fitted(counts, first, second)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    table = written(with_features(docs), "quality-features")
    model = fit(table, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in rows.columns[1:]], axis=1)
            yield batch(schema, [rows.column(0), model.scores(x)])

    return table.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a model of the ``labelled`` documents takes for good."""
    model = fit(with_features(labelled), labels)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(features(text_statistics(texts))) >= THRESHOLD)

    good = F.arrow_udf(run, "boolean").asNondeterministic()
    judged = docs.select(F.struct("*").alias("row"), good(F.col("text")).alias("good"))
    return judged.filter("good").select("row.*")
