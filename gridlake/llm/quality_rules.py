"""Quality rules: counts within a text, and lines that many documents of a host share.

Base rules look at one text: words, symbols, repeated lines and words in repeated windows.  The method looks at all
documents: lines are normalised and hashed, the documents of each host that hold a line are counted, lines that stand in
more than a fixed number of them are removed, and a document that loses most of its words is rejected.  The number does
not depend on the size of the host; lines with few characters, which recur by chance, stay.  Copies of a document count
as documents: a text that a host has more often than the limit loses its lines, so near copies should be reduced before.

Edge cases: a null text is an empty one, has no words and fails the base rules; a null host is a host of its own; a
document counts once for a line, however often it holds it; a repeated row counts as a further document and is
returned as often as it occurs; an empty table gives no rows; of further columns only those asked for are read.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import BLANKS, LOWER, UPPER, read_table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: A line is common when more documents of its host hold it than this.
MOST_DOCS = 5
#: Shorter lines, by the characters of their words, are never common.
MIN_LINE_CHARS = 20
#: A document is depleted when fewer of its word characters than this are left.
MIN_LEFT_PERCENT = 30


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """Lines with at least one word."""
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(f"[^{BLANKS}]")))


def normal_line(line: Column) -> Column:
    """A line with A-Z lower-cased, digits as 0 and single blanks between words."""
    plain = F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), f"[{BLANKS}]+", " "))
    return F.regexp_replace(plain, "[0-9]", "0")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{BLANKS}]+", "")).cast("long")


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows whose hash occurs twice or more; `windows` has the hash of each start."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s):
        last = F.size(s) - 1
        kept = F.filter(F.transform(s, lambda x, k: F.struct(
            x["i"].alias("i"),
            (((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(s, k + 1)["h"] == x["h"])))
            .alias("twice"))), lambda x: x["twice"])
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def total(starts):
        steps = F.transform(starts, lambda at, k: F.least(
            F.coalesce(F.get(starts, k + 1) - at, F.lit(width)), F.lit(width)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return let(let(pairs, repeated), total)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words in windows of `width` words that are found twice or more, the first included."""
    zero = F.lit(0).cast("long")

    def of(hashes):
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), zero)
                   .otherwise(_covered(w, width)))

    return F.when(F.size(words) <= width, zero).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), of))


def with_key(docs: DataFrame, host: str) -> DataFrame:
    """Two hashes over id, host and text, which tell rows apart; rows that agree in all three share them."""
    return docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.struct(F.col(host).isNull().alias("none"), F.coalesce(host, F.lit("")).alias("name")).alias("host"),
    ).withColumns({"key_1": F.xxhash64("doc_id", "host", "text"), "key_2": F.xxhash64("text", "host", "doc_id")})


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the row key and the counts within each text."""
    split = docs.select("doc_id", "key_1", "key_2", "text", words_of(F.col("text")).alias("words"))
    counted = split.select(
        "doc_id", "key_1", "key_2", "text", F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("text")).alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines_of(F.col("text")), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
    return counted.withColumn("base_failed", failed)


def line_chars(normal: Column) -> Column:
    """Characters of the words of a normalised line."""
    return F.length(F.translate(normal, " ", "")).cast("long")


def lines(docs: DataFrame) -> DataFrame:
    """A row per line with a word: row key, host, place in the text, hash of the normalised line, word characters."""
    found = F.transform(lines_of(F.col("text")), lambda line: let(normal_line(line), lambda n: F.struct(
        F.xxhash64(n).alias("line"), line_chars(n).alias("chars"))))
    return docs.select("key_1", "key_2", "host", F.posexplode(found).alias("place", "x")).select(
        "key_1", "key_2", "host", "place", "x.line", "x.chars")


def common_lines(docs: DataFrame, most_docs: int = MOST_DOCS, min_chars: int = MIN_LINE_CHARS) -> DataFrame:
    """Host and hash of the lines of `min_chars` or more that over `most_docs` documents of the host hold."""
    normal = F.transform(lines_of(F.col("text")), normal_line)
    long_enough = F.filter(normal, lambda n: line_chars(n) >= min_chars)
    distinct = F.array_distinct(F.transform(long_enough, lambda n: F.xxhash64(n)))
    return docs.select("host", F.explode(distinct).alias("line")).groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > most_docs).select("host", "line")


def quality_rules(docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS,
                  min_chars: int = MIN_LINE_CHARS, min_left: int = MIN_LEFT_PERCENT) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, n_removed_lines, kept, and clean_text without common lines."""
    keyed = with_key(docs, host)
    # Only lines that are removed are grouped by document; a frequent line meets its documents in a splittable join.
    hits = lines(keyed).join(common_lines(keyed, most_docs, min_chars), ["host", "line"])
    # Rows that agree in id, host and text share a key: their lines are taken once.
    once = hits.groupBy("key_1", "key_2", "place").agg(F.max("line").alias("line"), F.max("chars").alias("chars"))
    removed = once.groupBy("key_1", "key_2").agg(
        F.count(F.lit(1)).alias("n_removed_lines"), F.sum("chars").alias("removed_chars"),
        F.collect_set("line").alias("removed_lines"))
    joined = base_counts(keyed).join(removed, ["key_1", "key_2"], "left")
    left = F.col("word_chars") - F.coalesce("removed_chars", F.lit(0))
    hashes = F.coalesce("removed_lines", F.array().cast("array<long>"))
    clean = F.array_join(F.filter(
        F.split("text", "\n"), lambda line: ~F.array_contains(hashes, F.xxhash64(normal_line(line)))), "\n")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("n_removed_lines", F.lit(0).cast("long")).alias("n_removed_lines"),
        (~F.col("base_failed") & (100 * left >= min_left * F.col("word_chars"))).alias("kept"),
        F.when(F.col("removed_lines").isNull(), F.col("text")).otherwise(clean).alias("clean_text"))


def op8_quality_rules(spark, sf_dir):
    return quality_rules(read_table(spark, sf_dir, "documents")).drop("clean_text")


ORACLE_SQL = f"""
with docs as (
  select row_number() over () as row_id, doc_id, coalesce(source, '') as host, source is null as no_host,
         coalesce(text, '') as text
  from documents),
words as (
  select *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from docs),
windows as (
  select row_id, i, array_to_string(w[i:i + 7], ' ') as win
  from (select row_id, w, unnest(range(1, len(w) - 6)) as i from words where len(w) >= 8)),
repeated as (
  select row_id, i from windows qualify count(*) over (partition by row_id, win) > 1),
covered as (
  select row_id, sum(least(8, coalesce(nxt - i, 8))) as n
  from (select row_id, i, lead(i) over (partition by row_id order by i) as nxt from repeated) group by row_id),
raw_lines as (
  select row_id, host, no_host, line, lower_line,
         length(replace(lower_line, ' ', '')) as chars
  from (
    select row_id, host, no_host, line,
           regexp_replace(trim(regexp_replace(translate(line, '{UPPER}', '{LOWER}'),
             '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g') as lower_line
    from (select row_id, host, no_host, unnest(string_split(text, chr(10))) as line from docs))
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
dups as (
  select row_id, count(*) - count(distinct line) as n from raw_lines group by row_id),
common as (
  select host, no_host, lower_line from raw_lines where chars >= {MIN_LINE_CHARS}
  group by host, no_host, lower_line having count(distinct row_id) > {MOST_DOCS}),
removed as (
  select row_id, count(*) as n, sum(chars) as chars
  from raw_lines l join common c on l.host = c.host and l.no_host = c.no_host and l.lower_line = c.lower_line
  group by row_id),
counts as (
  select d.doc_id, cast(len(d.w) as bigint) as n_words,
         cast(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
         cast(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(dups.n, 0) as bigint) as n_dup_lines,
         cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
         cast(coalesce(removed.n, 0) as bigint) as n_removed_lines, coalesce(removed.chars, 0) as removed_chars
  from words d left join dups using (row_id) left join covered using (row_id) left join removed using (row_id)),
judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed
  from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_lines,
       not base_failed and 100 * (word_chars - removed_chars) >= {MIN_LEFT_PERCENT} * word_chars as kept
from judged
"""
