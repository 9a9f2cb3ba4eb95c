"""Labelled rows for fitting, and the rows held out."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.fitting import bounded, fit_in_task


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int,
                  per_class: int) -> DataFrame:
    """doc_id, text and label for fitting: of either label `per_class` rows and `MOST_CHARS` characters at most.

    Rows of fold `held_out` are never read.  The sample takes the smallest hashes of doc_id, so it is the same
    every time; labels other than 0 and 1 do not count, and of several labels of an id the larger one does.
    """
    usable = labels.where(F.col(column).isin(0, 1) & (remainder(F.col("doc_id"), folds) != held_out)).groupBy(
        "doc_id").agg(F.max(column).cast("int").alias("label"))
    order = F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")
    chosen = [usable.where(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    # At most 2 * per_class ids and labels, hence small enough to send to every task.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("place", F.xxhash64("text"))
    keys = texts.join(ids, "doc_id").select("doc_id", "place", "label", F.length("text").cast("long").alias("chars"))
    # An id may have any number of rows, so rows are chosen by their hashes and the texts are fetched once a hash.
    rows = bounded(keys, "label", [*order, F.col("place")], per_class).groupBy("doc_id", "place", "label").agg(
        F.count(F.lit(1)).alias("copies"))
    found = texts.join(F.broadcast(rows), ["doc_id", "place"]).groupBy("doc_id", "place", "label", "copies").agg(
        F.first("text").alias("text"))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "text", "label")


def in_order(rows) -> list[tuple[str, int]]:
    """Texts and labels of (doc_id, text, label), by id and text."""
    return [(text, label) for _, text, label in sorted(rows)]


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int,
                    per_class: int) -> list[tuple[str, int]]:
    """Texts and labels of :func:`labelled_rows` on the driver."""
    return in_order(tuple(r) for r in labelled_rows(docs, labels, column, folds, held_out, per_class).collect())


def fit_labelled(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, per_class: int, train):
    """`train` of texts and labels, in a task."""
    return fit_in_task(labelled_rows(docs, labels, column, folds, held_out, per_class), lambda rows: train(in_order(rows)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, steps: int = 50, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model with the intercept last; both labels weigh the same.

    Newton steps on standardised features, halved until they lower the loss.
    """
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([(features - mean) / spread, np.ones(len(features))])
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / len(labels)
    sign = np.where(labels == 1, 1.0, -1.0)

    def loss(w):
        return weight @ np.logaddexp(0, -sign * (x @ w)) + 0.5 * ridge * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w -= step
    plain = w[:-1] / spread
    return np.append(plain, w[-1] - plain @ mean)
