"""Benchmark decontamination by the q-gram lemma.

An item of m characters occurs in a text if some stretch of the text is within k edits of it, k being a share of m.
Such a stretch has at least m - q + 1 - k * q of the item's character q-grams in common with it, on diagonals (place
in the text minus place in the item) no further apart than k.  Shared q-grams are counted in bands of 2 (k + 1)
diagonals that start every k + 1, so each interval of k + 1 diagonals lies in one; bands with too few are dropped, the
others verified by alignment within the diagonals of the band.

Texts are compared in lower case with every blank as a space; places count code points of the text as it is.  k is
lowered for short items until the lemma asks for one common q-gram; items of fewer than q characters hold no evidence and
match nothing.  The items are held by every task, in blocks of `BLOCK_CHARS` characters, one pass each.

Edge cases: a null text or item is empty and matches nothing; very long texts are searched whole; equal items are
reported each; repeated rows are judged as often as they occur; an empty table, of either kind, gives no hits; all
columns of the documents are kept, and a clashing name is replaced by the hits.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches, stage

Q = 8
#: Edits per character of an item.
EDITS = 0.08
#: Characters of items that tasks hold at once.
BLOCK_CHARS = 8_000_000
#: Characters of texts searched at once; a longer text is searched alone.
CHUNK = 1 << 19
FILTER_BITS = 22
HIT = "array<struct<item_id:{0},start:long,end:long,edits:long>>"
_BLANK = re.compile(r"\s")


def plain(text: str | None) -> str:
    """Lower case, blanks as spaces; as many characters as before."""
    low = (text or "").lower()
    if len(low) != len(text or ""):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return _BLANK.sub(" ", low)


def budget(m: int) -> int:
    """Edits allowed for an item of `m` characters."""
    return max(0, min(int(EDITS * m), (m - Q) // Q))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(codes: np.ndarray) -> np.ndarray:
    """A hash of the `Q` characters from each place on."""
    n = max(0, len(codes) - Q + 1)
    out = np.zeros(n, np.uint64)
    for i in range(Q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[i:i + n]
    return out


def align(item: np.ndarray, text: np.ndarray, free_start: bool) -> tuple[int, int]:
    """Fewest edits between `item` and a stretch of `text`, and where the stretch ends; its start is free or 0."""
    place = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64) if free_start else place.copy()
    for char in item:
        below = row + 1
        below[1:] = np.minimum(below[1:], row[:-1] + (text != char))
        row = np.minimum.accumulate(below - place) + place
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """Items with an index of their q-grams."""

    def __init__(self, rows: list[tuple[object, str]]):
        kept = [(i, plain(t)) for i, t in rows]
        self.rows = [(i, t, codes_of(t), budget(len(t))) for i, t in kept if len(t) >= Q]
        hashes = [grams(codes) for _, _, codes, _ in self.rows]
        sizes = np.array([len(h) for h in hashes], np.int64)
        every = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(every, kind="stable")
        self.gram, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.item = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place = (np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        self.step = np.array([k + 1 for _, _, _, k in self.rows], np.int64)
        self.least = np.array([len(t) - Q + 1 - k * Q for _, t, _, k in self.rows], np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.gram >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """Item, first and last diagonal of every region with enough common q-grams."""
        found = grams(codes)
        at = np.flatnonzero(self.filter[found >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.gram):
            return []
        index = np.minimum(np.searchsorted(self.gram, found[at]), len(self.gram) - 1)
        same = self.gram[index] == found[at]
        at, index = at[same], index[same]
        counts = self.first[index + 1] - self.first[index]
        entry = np.arange(counts.sum()) + np.repeat(self.first[index] - (np.cumsum(counts) - counts), counts)
        item, diagonal = self.item[entry], np.repeat(at, counts) - self.place[entry]
        bands = diagonal // self.step[item]
        shift = len(codes) + int(max((len(t) for _, t, _, _ in self.rows), default=0)) + 2
        key = item * (2 * shift) + bands + shift
        key, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        item, band = key // (2 * shift), key % (2 * shift) - shift
        enough = n >= self.least[item]
        regions: list[tuple[int, int, int]] = []
        for i, b in zip(item[enough].tolist(), band[enough].tolist()):
            step = int(self.step[i])
            low, high = b * step, (b + 2) * step - 1
            if regions and regions[-1][0] == i and low <= regions[-1][2] + 1:
                regions[-1] = (i, regions[-1][1], high)
            else:
                regions.append((i, low, high))
        return regions

    def verify(self, i: int, low: int, high: int, text: str, codes: np.ndarray) -> tuple | None:
        """The closest stretch of a region within the edit budget: item_id, start, end, edits."""
        item_id, item, item_codes, k = self.rows[i]
        start = max(0, low - k)
        window = codes[start:max(start, high + len(item) + k)]
        exact = text.find(item, start, start + len(window))
        if exact >= 0:
            return item_id, exact, exact + len(item), 0
        edits, end = align(item_codes, window, True)
        if edits > k:
            return None
        _, back = align(item_codes[::-1], window[:end][::-1], False)
        return item_id, start + end - back, start + end, edits

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """Hits of each text, by start and item."""
        hits: list[list[tuple]] = [[] for _ in texts]
        held, size = [], 0
        for number, text in enumerate(texts):
            if text and len(text) >= Q // 2:
                held.append((number, plain(text)))
                size += len(text)
            if held and (size >= CHUNK or number == len(texts) - 1):
                self._search(held, hits)
                held, size = [], 0
        if held:
            self._search(held, hits)
        return hits

    def _search(self, held: list[tuple[int, str]], hits: list[list[tuple]]) -> None:
        parts = [codes_of(t) for _, t in held]
        gap = np.full(Q, 0x110000, "<u4")  # no character, so no q-gram reaches over it
        joined = np.concatenate([x for part in parts for x in (part, gap)])
        starts = np.cumsum([0] + [len(p) + Q for p in parts])
        for i, low, high in self.candidates(joined):
            first = max(0, int(np.searchsorted(starts, max(low, 0), "right")) - 1)
            last = int(np.searchsorted(starts, high + len(self.rows[i][1]), "left"))
            for d in range(first, min(last, len(held))):  # nearly always one text
                offset = int(starts[d])
                hit = self.verify(i, low - offset, high - offset, held[d][1], parts[d])
                if hit:
                    hits[held[d][0]].append(hit)
        for number, _ in held:
            hits[number] = sorted(set(hits[number]), key=lambda h: (h[1], h[2], str(h[0])))


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items, block by block; a block has about `BLOCK_CHARS` characters."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_CHARS)
    for block in range(blocks):
        yield sorted(((r.item_id, r.text) for r in rows.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()), key=str)


def hits_column(items: list[tuple[object, str]], kind: str, text: Column) -> Column:
    @F.pandas_udf(HIT.format(kind))
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Items(items)
        for batch in batches:
            yield pd.Series([
                [{"item_id": i, "start": s, "end": e, "edits": n} for i, s, e, n in found]
                for found in index.search(batch.tolist())], dtype=object)

    return search(text)


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str = "hits") -> DataFrame:
    """The documents with the stretches that are close to an item: item_id, start, end, edits."""
    small_batches(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = docs.withColumn(name, F.array().cast(HIT.format(kind)))
    for number, items in enumerate(item_blocks(benchmark)):
        if number:
            found = stage(found, "hits")  # one block of items in a task at a time
        found = found.withColumn(name, F.concat(F.col(name), hits_column(items, kind, F.col("text"))))
    return found


def op7_decontamination(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_hits(docs, read_table(spark, sf_dir, "benchmark"))
    written = F.transform("hits", lambda h: F.concat_ws(":", h["item_id"], h["start"], h["end"], h["edits"]))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"),
        F.size(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))).cast("long").alias("n_items"),
        F.transform("hits", lambda h: h["item_id"]).alias("item_ids"), F.array_join(written, ",").alias("hits"))
