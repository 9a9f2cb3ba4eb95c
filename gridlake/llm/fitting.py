"""Bounded samples of a table, and models fitted on them in a task."""

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Characters of all texts of a group in a sample at most; a longer text is never in one.
MOST_CHARS = 50_000_000


def bounded(rows: DataFrame, group: str, order: list[Column | str], most_rows: int, most_chars: int = MOST_CHARS) -> DataFrame:
    """The first rows of each group, `most_rows` of them and `most_chars` of their column `chars` in sum at most.

    Tasks keep so many rows of a group before the shuffle, so `rows` should have keys and not texts.
    """
    place = Window.partitionBy(group).orderBy(*order)
    first = rows.where(F.col("chars") <= most_chars).withColumn("_rank", F.row_number().over(place)).where(
        F.col("_rank") <= most_rows)
    return first.withColumn("_sum", F.sum("chars").over(place.rowsBetween(Window.unboundedPreceding, 0))).where(
        F.col("_sum") <= most_chars).drop("_rank", "_sum")


def fit_in_task(rows: DataFrame, train):
    """`train(rows)` of a bounded sample, in one task; only the model comes to the driver."""
    names = rows.columns

    def run(batches):
        held = []
        for batch in batches:
            held += zip(*[batch[c].to_pylist() for c in names])
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(train(held))]})

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else train([])
