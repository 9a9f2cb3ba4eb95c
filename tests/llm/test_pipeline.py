"""The stages of the pipeline against plain Python, on the small tables and planted documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlake.llm.toxicity import REJECT, fit_toxicity, with_toxicity

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
CLASHING = ["_toxicity", "_hits", "kept_id", "copies", "kept_hash", "score", "text_hash", "component"]


def planted(spark):
    rng = random.Random(3)
    # Words of documents known as clean: the classifier has some 20 toxic rows to learn from and no idea of other words.
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").select("doc_id")
    texts = spark.read.parquet(f"{SF}/documents.parquet").join(clean, "doc_id").where("lang = 'en'").orderBy("doc_id")
    known = [w for r in texts.collect() for w in re.findall("[a-z]{2,}", r.text or "")]

    def prose(n):
        return " ".join(rng.choice(known) for _ in range(n))

    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    near = prose(80).split()
    rows = {1000: " ".join(near), 1001: " ".join([*near[:40], "other", *near[41:]]), 1002: " ".join(near),
            1003: f"{prose(30)} {passage} {prose(30)}", 1004: f"{prose(30)} write to jo.doe@mail.example.org {prose(30)}",
            1005: f"{prose(60)} " * 500, 1006: "", 1007: None, 1008: " \n ", 1009: prose(40)}
    return [*rows.items(), (None, None), (None, None), (None, prose(50)), (1009, rows[1009])]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The small tables with the planted documents and columns of clashing names."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame(planted(spark), "doc_id long, text string").withColumns({
        "lang": F.lit("en"), "source": F.lit("planted"), "n_chars": F.length("text")})
    both = docs.unionByName(more.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema]))
    both.withColumns({c: F.xxhash64("text", F.lit(c)) for c in CLASHING}).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def one_per_group(rows):
    """Rows without words, and the smallest id of each group of texts whose shingles agree to four fifths."""
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(r.text) for r in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    ids, wordless = {}, sum(not s for s in sets)
    for i, r in enumerate(rows):
        if sets[i]:
            ids.setdefault(root(i), []).append(r.doc_id)
    kept = [min((d for d in members if d is not None), default=None) for members in ids.values()]
    return kept, wordless


def key(i):
    return (i is None, i or 0)


def test_every_stage_does_its_work_and_keeps_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    whole = {c: F.xxhash64("text", F.lit(c)) for c in CLASHING}

    def untouched(df):
        return df.where(" or ".join(f"`{c}` <> xxhash64(text, '{c}')" for c in whole)).count() == 0

    calm = corpus_pipeline.drop_toxic(spark, docs, tables).cache()
    model = fit_toxicity(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    mild = with_toxicity(docs.select("doc_id", "text"), model).where(F.col("score") < REJECT)
    assert sorted((r.doc_id for r in calm.collect()), key=key) == sorted((r.doc_id for r in mild.collect()), key=key)
    assert calm.columns == docs.columns and untouched(calm)
    assert {r.doc_id for r in calm.where("doc_id >= 1000").collect()} == set(range(1000, 1010))

    single = corpus_pipeline.drop_near_copies(spark, calm, tables).cache()
    rows = calm.select("doc_id", "text").collect()
    kept, wordless = one_per_group(rows)
    got = single.collect()
    assert single.columns == docs.columns and untouched(single)
    assert sorted((r.doc_id for r in got if r.text and r.text.strip(" \t\n\v\f\r")), key=key) == sorted(kept, key=key)
    assert sum(not (r.text and r.text.strip(" \t\n\v\f\r")) for r in got) == wordless == sum(
        not (r.text and r.text.strip(" \t\n\v\f\r")) for r in rows)
    assert {1000, 1009} <= {r.doc_id for r in got} and not {1001, 1002} & {r.doc_id for r in got}

    fresh = corpus_pipeline.drop_contaminated(spark, single, tables).cache()
    left = {r.doc_id for r in fresh.collect()}
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert fresh.columns == docs.columns and untouched(fresh)
    assert not any(item in (r.text or "") for r in fresh.collect() for item in items)
    assert 1003 not in left and {1000, 1004, 1005, 1006, 1007, 1008, 1009, None} <= left

    safe = corpus_pipeline.redact_personal_data(spark, fresh, tables).cache()
    texts = {r.doc_id: r for r in safe.where("doc_id is not null").collect()}
    assert safe.columns == docs.columns and safe.count() == fresh.count()
    assert not any(EMAIL.search(r.text or "") for r in texts.values()) and "write to " in texts[1004].text
    assert all(r.n_chars == len(r.text) for r in texts.values() if r.text is not None)
    assert "n_chars" not in corpus_pipeline.redact_personal_data(spark, fresh.drop("n_chars"), tables).columns

    pieces = corpus_pipeline.pack(spark, safe, tables).collect()
    packed = {}
    for p in pieces:
        packed.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in packed.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    tokens = {}
    for p in pieces:
        if p.doc_id is not None:
            tokens.setdefault(p.doc_id, [p.doc_tokens, 0])[1] += p.length
    assert set(tokens) == set(texts) and all(a == b for a, b in tokens.values()) and tokens[1006] == [1, 1]


def test_run_of_an_empty_table(spark, tables, tmp_path):
    empty = f"{tmp_path}/documents.parquet"
    spark.read.parquet(f"{tables}/documents.parquet").limit(0).write.parquet(empty)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
