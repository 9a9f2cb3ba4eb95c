"""Quality by compression: a text is like those whose dictionary makes it smaller.

Good and bad labelled texts become two zstandard dictionaries.  A text is compressed block by block with either,
so that a long one does not outgrow the dictionaries; the difference of the sizes over their sum is its evidence.  A
logistic model turns the difference, the compressibility of the text itself and its length into a score; it is
fitted on labelled rows that are in neither dictionary.

Edge cases: a null text is an empty one; empty texts get the score of no evidence; very long ones are compressed
whole; equal texts get equal scores; repeated rows are scored as often as they occur; an empty table gives no rows;
without usable labels every score is 0; all columns are kept, and a clashing name is replaced by the score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches
from gridlake.llm.labels import fit_labelled, fit_logistic, remainder

FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7
#: Labelled rows of either class that are used at most; every third one calibrates.
PER_CLASS = 3000
#: Bytes of a dictionary, and of the piece that a text contributes to it.
DICTIONARY, PIECE = 400_000, 400
BLOCK, LEVEL = 1024, 7
#: Beyond this the compressibility of ordinary prose of any language is not told apart.
ORDINARY = -1.2


class Compressors:
    """Sizes of a text under the two dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        import zstandard

        self.each = []
        for content in (bad, good):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.each.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Normalised difference, positive if the good one fits better; log of the ratio, cut; shortness."""
        data = (text or "").encode("utf-8", "replace")
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]
        bad, good = (sum(len(c.compress(b)) for b in blocks) for c in self.each)
        ratio = np.log(min(bad, good) / (len(data) + 20))
        return (bad - good) / (bad + good), min(ratio, ORDINARY), 1 / (1 + len(data) / 100)


@dataclass
class Model:
    bad: bytes
    good: bytes
    weights: tuple[float, ...]

    def score(self, compressors: Compressors, text: str | None) -> float:
        z = float(np.dot(compressors.features(text), self.weights[:-1]) + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def dictionary(texts: list[str]) -> bytes:
    """Pieces of as many texts as fit, taken from a third of the way in where the text is long enough."""
    pieces, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "replace")
        at = len(data) // 3 if len(data) > 3 * PIECE else 0
        pieces.append(data[at:at + PIECE])
        size += len(pieces[-1]) + 1
        if size >= DICTIONARY:
            break
    return b"\n".join(pieces)


def train(sample: list[tuple[str, int]]) -> Model | None:
    """A model from texts and labels; None if a label has no text for its dictionary or for the calibration."""
    groups = {v: [t for t, y in sample if y == v] for v in (0, 1)}
    calibrating = [(t, v) for v in (0, 1) for t in groups[v][::3]]
    content = {v: dictionary([t for i, t in enumerate(groups[v]) if i % 3]) for v in (0, 1)}
    if min(len(groups[0]), len(groups[1])) < 2 or min(map(len, content.values())) < 8:
        return None
    compressors = Compressors(content[0], content[1])
    features = np.array([compressors.features(t) for t, _ in calibrating])
    weights = fit_logistic(features, np.array([y for _, y in calibrating]))
    return Model(content[0], content[1], tuple(weights.tolist()))


def score_column(model: Model | None, text: Column) -> Column:
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = Compressors(model.bad, model.good)
        for batch in batches:
            yield pd.Series([model.score(compressors, t) for t in batch], dtype="float64")

    return score(text)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    return fit_labelled(docs, labels, "quality", FOLDS, HELD_OUT, per_class, train)


def with_quality(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The documents with a column of scores between 0 and 1."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, score_column(model, F.col("text")))


def op9_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    scored = with_quality(docs.select("doc_id", "text"), fit_quality(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
