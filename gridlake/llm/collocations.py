"""Phrase collocations: words that stand together more often than apart, counted on a prefix-free parse.

Texts are cut where a hash of three words says so, whatever stands around them, into chunks that overlap by those three
words; copies of a passage give the same chunks.  Distinct chunks with their frequencies are the dictionary.  Phrases are
counted inside distinct chunks, weighted by frequency; a phrase counts in the chunk in whose own part it starts, so the
overlap, which starts the next chunk, counts once.

Few phrases are frequent.  Two passes over the dictionary add up 64-bit hashes of phrases (words and pairs, then longer
phrases whose pairs are all frequent) and mark those that reach the limit in a bit field of fixed size.  The last pass
counts marked phrases by their text.  Equal hashes and full fields only let more phrases into that pass: its counts
decide.

Edge cases: a null text is empty, and gives no phrase; a null language is `und`; a word is what stands between blanks and
tabs, whatever its characters; a phrase never crosses `.,;:!?` or a line end; repeated rows count as often as they occur;
ties in a score go to the more frequent phrase, then to the phrase itself in byte order; a very long text is one row
of a task, as its chunks are cut from it; an empty table gives no rows; further columns are ignored.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridlake.llm.common import LOWER, UPPER, read_table, small_batches, stage
from gridlake.llm.shingles import mix

#: Longest phrase; chunks overlap by one word less.
LONGEST = 4
#: One window of words in so many starts a chunk.
TRIGGER = 16
MIN_COUNT, PER_LANG, MAX_INSIDE_PERCENT = 30, 2000, 80
#: Bits of the field of frequent phrases (16 MB), and of one of its rows.
FIELD_BITS, ROW_BITS = 1 << 27, 1 << 15
#: Bytes of text that are parsed together, a longer text alone; and of those that are hashed together, a longer word alone.
SLAB, PART = 1 << 22, 1 << 17

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\v\f\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Multipliers of characters, of words in a phrase, and of the second hash.
_CHAR, _WORD, _OTHER = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of `_CHAR` and of its inverse modulo 2**64."""
    out = []
    for base in (int(_CHAR), pow(int(_CHAR), -1, 1 << 64)):
        power = np.full(n, base, np.uint64)
        power[:1] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


class Words:
    """Words of several texts in a row: their bytes, hashes, texts, and where phrases may not pass."""

    def __init__(self, texts: list[bytes]):
        ends = np.cumsum([len(t) + 1 for t in texts])
        raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = _KIND[raw]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        start, end = edge[::2], edge[1::2]
        self.n = len(start)
        words_before = np.searchsorted(start, ends)
        self.text = np.repeat(np.arange(len(texts)), np.diff(words_before, prepend=0))
        self.new_text = np.diff(self.text, prepend=-1) != 0
        new_piece = np.zeros(self.n + 1, bool)
        new_piece[np.searchsorted(start, np.flatnonzero(kind == 2))] = True
        new_piece = new_piece[:self.n] | self.new_text
        self.piece = np.cumsum(new_piece)
        # One byte between words: a line end where a phrase may not pass, else a blank.
        raw[end[:-1]] = np.where(new_piece[1:], 10, 32)
        inside[end] = True
        self.plain = raw[inside].tobytes()
        self.size = end - start
        self.at = np.cumsum(self.size + 1) - self.size - 1
        self.hash = self._hashes(raw, start, end)
        self.sums = {}

    @staticmethod
    def _hashes(raw, start, end):
        """Sums of characters times powers by place in the word, as differences of running sums over parts of the bytes."""
        out, part = np.zeros(len(start), np.uint64), 0
        power, inverse = _powers(PART)
        while part < len(start):
            stop = max(part + 1, int(np.searchsorted(end, start[part] + PART, "right")))
            first, length = start[part], int(end[stop - 1] - start[part])
            if length > len(power):
                power, inverse = _powers(length)
            sums = np.zeros(length + 1, np.uint64)
            letters = raw[first:first + length].astype(np.uint64) + np.uint64(1)
            np.cumsum(letters * power[:length], out=sums[1:])
            size = (end[part:stop] - start[part:stop]).astype(np.uint64)
            from_ = start[part:stop] - first
            out[part:stop] = mix((sums[end[part:stop] - first] - sums[from_]) * inverse[from_] + size * _WORD)
            part = stop
        return out

    def rolled(self, n: int, seed, by=_WORD) -> np.ndarray:
        """Hash of the `n` words from each word on; the last words have none.  `seed` is one value or one per word."""
        count = max(0, self.n - n + 1)
        with np.errstate(over="ignore"):
            if (n, by) not in self.sums:
                one = self.hash if n == 1 else (self._sum(n - 1, by)[:count]
                                                + self.hash[n - 1:] * np.uint64(pow(int(by), n - 1, 1 << 64)))
                self.sums[n, by] = one
            return mix(self.sums[n, by][:count] + (seed if np.isscalar(seed) else seed[:count]) + np.uint64(n) * by)

    def _sum(self, n, by):
        self.rolled(n, np.uint64(0), by) if (n, by) not in self.sums else None
        return self.sums[n, by]

    def phrases(self, first: np.ndarray, n: int) -> list[str]:
        last = first + n - 1
        return [self.plain[a:b].decode() for a, b in zip(
            self.at[first].tolist(), (self.at[last] + self.size[last]).tolist())]


def slabs(batches, columns):
    """Lists of the columns' values with some `SLAB` bytes of the first column, which is text, in each."""
    held, size = [[] for _ in columns], 0
    for batch in batches:
        for values in zip(*[batch[c].to_pylist() for c in columns]):
            for kept, value in zip(held, values):
                kept.append(value)
            size += len(values[0])
            if size >= SLAB:
                yield held
                held, size = [[] for _ in columns], 0
    if held[0]:
        yield held


def _chunks_of(batches):
    for texts, langs in slabs(batches, ["text", "lang"]):
        words = Words([t.encode() for t in texts])
        if not words.n:
            continue
        overlap = LONGEST - 1
        begin = words.new_text.copy()
        rolled = words.rolled(overlap, np.uint64(0))
        whole = words.text[:len(rolled)] == words.text[overlap - 1:][:len(rolled)]
        begin[:len(rolled)] |= whole & (rolled % np.uint64(TRIGGER) == 0)
        first = np.flatnonzero(begin)
        after = np.append(first[1:], words.n)
        # The last chunk of a text owns all its words; another one also has the window that starts the next.
        ends_text = np.append(words.new_text[first[1:]], True)
        stop = np.where(ends_text, after, after + overlap)
        from_, to = words.at[first], words.at[stop - 1] + words.size[stop - 1]
        found = Counter()
        for lang, a, b, own in zip([langs[t] for t in words.text[first]], from_.tolist(), to.tolist(),
                                   (after - first).tolist()):
            found[lang, words.plain[a:b], own] += 1
        yield pa.RecordBatch.from_pydict({
            "lang": [k[0] for k in found], "chunk": [k[1].decode() for k in found],
            "own": pa.array([k[2] for k in found], pa.int64()), "weight": pa.array(found.values(), pa.int64())})


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """Distinct chunks: lang, chunk (a line end where a phrase may not pass), own (words it counts for), weight."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    chunks = texts.mapInArrow(_chunks_of, "lang string, chunk string, own bigint, weight bigint")
    return chunks.groupBy("lang", "chunk", "own").agg(F.sum("weight").alias("weight"))


class Phrases:
    """Phrases of a slab of chunks: hashes, weights and where they start."""

    def __init__(self, chunks, langs, own, weight):
        self.words = Words([c.encode() for c in chunks])
        first = np.flatnonzero(self.words.new_text)
        self.chunk = self.words.text
        owned = np.asarray(own, np.int64)[self.chunk[first]]
        self.own = np.arange(self.words.n) - np.repeat(first, np.diff(np.append(first, self.words.n))) < np.repeat(
            owned, np.diff(np.append(first, self.words.n)))
        seeds = {lang: np.uint64(zlib.crc32(lang.encode()) + 1) for lang in set(langs)}
        self.seed = mix(np.array([seeds[lang] for lang in langs], np.uint64))[self.chunk]
        self.weight = np.asarray(weight, np.int64)[self.chunk]
        self.good = None

    def whole(self, n: int) -> np.ndarray:
        """Whether the `n` words from each word on make a phrase."""
        piece = self.words.piece
        count = max(0, self.words.n - n + 1)
        return piece[:count] == piece[n - 1:][:count]

    def hashes(self, n: int) -> np.ndarray:
        return self.words.rolled(n, self.seed)

    def pairs_frequent(self, n: int, field: np.ndarray) -> np.ndarray:
        """Phrases of `n` words whose pairs are all marked."""
        if self.good is None:
            self.good = self.whole(2) & marked(field, self.hashes(2))
        good, out = self.good, self.whole(n)
        for i in range(n - 1):
            out &= good[i:i + len(out)]
        return out


def marked(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(FIELD_BITS - 1)
    return (field[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def summed(keys: np.ndarray, weight: np.ndarray, also: np.ndarray | None = None):
    """First places and total weights of equal keys (and equal `also`)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.diff(keys, prepend=keys[:1]) != 0
    if also is not None:
        also = also[order]
        new |= np.diff(also, prepend=also[:1]) != 0
    new[:1] = True
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def _frequent_hashes(dictionary: DataFrame, lengths: tuple[int, ...], min_count: int, field=None) -> DataFrame:
    """Hashes of phrases of the lengths that reach the limit; with a field, of those whose pairs are marked."""
    def run(batches):
        for chunks, *rest in slabs(batches, ["chunk", "lang", "own", "weight"]):
            phrases = Phrases(chunks, *rest)
            hashes, weights = [], []
            for n in lengths:
                kept = phrases.whole(n) if field is None else phrases.pairs_frequent(n, field.value)
                kept = kept & phrases.own[:len(kept)]
                hashes.append(phrases.hashes(n)[kept])
                weights.append(phrases.weight[:len(kept)][kept])
            hashes, weights = np.concatenate(hashes), np.concatenate(weights)
            first, total = summed(hashes, weights)
            yield pa.RecordBatch.from_pydict({"h": pa.array(hashes[first].view(np.int64)), "n": pa.array(total)})

    counted = dictionary.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count).select("h")


def bit_field(hashes: DataFrame) -> np.ndarray:
    """The field with the hashes marked.  Tasks make its rows, so the driver receives `FIELD_BITS` at most."""
    slot = F.col("h").bitwiseAND(FIELD_BITS - 1)
    slots = hashes.select(slot.alias("slot")).distinct().withColumn("row", F.floor(F.col("slot") / ROW_BITS))

    def row(pdf):
        import pandas as pd

        bits = np.zeros(ROW_BITS, np.uint8)
        bits[(pdf["slot"] % ROW_BITS).to_numpy()] = 1
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    field = np.zeros(FIELD_BITS // 8, np.uint8)
    for r in slots.groupBy("row").applyInPandas(row, "row bigint, bits binary").toLocalIterator():
        at = r.row * (ROW_BITS // 8)
        field[at:at + ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return field


def phrase_counts(dictionary: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, phrase, f of all phrases of up to `LONGEST` words with f of `min_count` or more."""
    context = dictionary.sparkSession.sparkContext
    short = context.broadcast(bit_field(_frequent_hashes(dictionary, (1, 2), min_count)))
    long_ = context.broadcast(bit_field(_frequent_hashes(dictionary, tuple(range(3, LONGEST + 1)), min_count, short)))

    def run(batches):
        for chunks, *rest in slabs(batches, ["chunk", "lang", "own", "weight"]):
            phrases = Phrases(chunks, *rest)
            out = {"lang": [], "phrase": [], "f": []}
            for n in range(1, LONGEST + 1):
                hashes = phrases.hashes(n)
                kept = phrases.whole(n) if n < 3 else phrases.pairs_frequent(n, short.value)
                kept = np.flatnonzero(kept & phrases.own[:len(kept)] & marked((short if n < 3 else long_).value, hashes))
                # Within a slab phrases are told apart by two hashes, 128 bits; across slabs by their text.
                first, total = summed(hashes[kept], phrases.weight[kept],
                                      phrases.words.rolled(n, phrases.seed, _OTHER)[kept])
                at = kept[first]
                out["lang"] += [rest[0][c] for c in phrases.chunk[at].tolist()]
                out["phrase"] += phrases.words.phrases(at, n)
                out["f"] += total.tolist()
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())]))

    counted = dictionary.mapInArrow(run, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"))
    return counted.where(F.col("f") >= min_count)


def _part(first, n):
    return F.array_join(F.slice("words", first, n), " ")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words or more with the counts a, l, r of their worst cut and its score."""
    phrases = counts.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words")).where(
        F.size("words") > 1)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.size("words")).alias("right"))
    sides = [counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
             for side, count in (("left", "l"), ("right", "r"))]
    whole = "cast({} as decimal(20,0))".format
    score = F.expr(f"2000000 * {whole('a')} div ({whole('l')} + {whole('r')})")
    worst = cuts.join(sides[0], ["lang", "left"]).join(sides[1], ["lang", "right"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def not_inside(candidates: DataFrame, percent: int = MAX_INSIDE_PERCENT) -> DataFrame:
    """Candidates that are not part of a longer one with `percent` of their count or more."""
    words = candidates.select("lang", "a", F.split("phrase", " ").alias("words")).where(F.size("words") > 2)
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1),
        lambda i: F.array_join(F.slice("words", i, n), " "))))
    longer = words.select("lang", "a", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("of_longer"))
    inside = F.expr(f"100 * cast(of_longer as decimal(20,0)) >= {percent} * cast(a as decimal(20,0))")
    return candidates.join(longer, ["lang", "phrase"], "left").where(F.col("of_longer").isNull() | ~inside).drop(
        "of_longer")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, per_lang: int = PER_LANG) -> DataFrame:
    """The best phrases of each language in `docs` (text, lang): lang, rank, phrase, a, l, r, n, score."""
    small_batches(docs.sparkSession)
    dictionary = stage(chunk_dictionary(docs), "chunks")
    counts = stage(phrase_counts(dictionary, min_count), "phrases")
    sizes = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("weight")).alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = not_inside(scored(counts)).withColumn("rank", F.row_number().over(best).cast("long")).where(
        F.col("rank") <= per_lang)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return collocations(read_table(spark, sf_dir, "documents").select("text", "lang"))


def _grams(n: int) -> str:
    words = " || ' ' || ".join(f"w[i + {k}]" for k in range(n)) if n > 1 else "w[i]"
    return (f"select lang, {n} as size, {words} as phrase, count(*) as f from "
            f"(select lang, w, unnest(range(1, len(w) - {n - 2})) as i from pieces) group by lang, phrase")


ORACLE_SQL = f"""
with pieces as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w
  from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents)),
counts as ({" union all ".join(_grams(n) for n in range(1, LONGEST + 1))}),
sizes as (select lang, sum(f) as n from counts where size = 1 group by lang),
candidates as (
  select lang, phrase, size, f as a, string_split(phrase, ' ') as w from counts where size > 1 and f >= {MIN_COUNT}),
cuts as (
  select lang, phrase, size, a, w, k, array_to_string(w[1:k], ' ') as left_part,
         array_to_string(w[k + 1:size], ' ') as right_part
  from (select *, unnest(range(1, size)) as k from candidates)),
worst as (
  select c.lang, c.phrase, c.size, c.a, c.k, l.f as l, r.f as r,
         (2000000::hugeint * c.a) // (l.f::hugeint + r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.phrase = c.left_part and l.size = c.k
  join counts r on r.lang = c.lang and r.phrase = c.right_part and r.size = c.size - c.k
  qualify row_number() over (partition by c.lang, c.phrase order by score, c.k) = 1),
parts as (
  select distinct lang, array_to_string(w[i:i + m - 1], ' ') as phrase, a
  from (select lang, w, a, m, unnest(range(1, size - m + 2)) as i
        from (select *, unnest(range(2, size)) as m from candidates))),
kept as (
  select * from worst c where not exists (
    select 1 from parts p where p.lang = c.lang and p.phrase = c.phrase and 100::hugeint * p.a >= {MAX_INSIDE_PERCENT}::hugeint * c.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
       a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from kept join sizes using (lang)
qualify rank <= {PER_LANG}
"""
