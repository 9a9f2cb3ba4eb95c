"""Joins and filters over small tables that stand for the hard cases."""

import random

import duckdb

from gridlake.llm import ngram_join, quality_rules, url_filters
from testbed.compare import differences


def test_join_against_all_pairs(spark, monkeypatch):
    """Frequent shingles, short and long sets, copies, null ids and chains of near copies."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    monkeypatch.setattr(ngram_join, "PAIR_SIZE", 30)
    monkeypatch.setattr(ngram_join, "MEMBERS", 4)
    rng = random.Random(1)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 8, 20, 45, 70]))] for _ in range(12)]
    rows = [(100, None, "x"), (101, "", "x"), (102, " \t", "x"), (None, "same text of six words here", "x"),
            (103, "Same text of six words here", "x")]
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(words), "x"))
    rows.append(rows[-1])

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(t) for _, t, _ in rows]
    reach = list(range(len(rows)))

    def root(k):
        while reach[k] != k:
            k = reach[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                reach[max(root(a), root(b))] = min(root(a), root(b))
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            ids[root(k)] = min(ids.get(root(k), i), i)
    expected = sorted(((i, len(s), ids[root(k)]) for k, ((i, _, _), s) in enumerate(zip(rows, sets))), key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string")
    got = ngram_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected
    kept = ngram_join.one_of_each(docs).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, n, c in expected if n} | {100, 101, 102})


def test_join_of_a_pivot_whose_partners_have_a_smaller_one(spark):
    """x is a near copy of P and shares one signature with Q, Q < P < x: P is compared with nothing at first."""
    import numpy as np

    none, rng = np.zeros(0, np.uint64), random.Random(1)

    def words(n):
        return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))

    def fits(p, x, q):
        sets = ngram_join.shingle_sets([p, x, q])
        a, b, c = (set(ngram_join.signatures(s, none)[0].tolist()) for s in sets)
        a_class, b_class, c_class = map(ngram_join.class_of, sets)
        return c_class < a_class < b_class and a & b and b & c and not a & c

    p, x, q = "", "", ""
    while not fits(p, x, q):
        p, passage = words(60), words(5)
        x, q = f"{p} {passage}", f"{passage} {words(12)}"
    docs = spark.createDataFrame([(1, p), (2, x), (3, q)], "doc_id long, text string")
    got = ngram_join.jaccard_components(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 3)]
    assert sorted(r.doc_id for r in ngram_join.one_of_each(docs).select("doc_id").collect()) == [1, 3]


def test_all_rows_without_words_stay(spark):
    rows = [(None, None)] * 3 + [(None, "")] * 2 + [(1, " \t")] * 2 + [(2, "one text of six words here")] * 2
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(rows[:-1], key=str)


def test_join_of_an_empty_table(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_bound_what_sets_have_in_common():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, m, common in ((5, 9, 3), (100, 90, 60), (3000, 700, 500)):
        shared = rng.integers(0, 1 << 63, common, dtype=np.uint64) * np.uint64(2)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, k - common, dtype=np.uint64)])) for k in (n, m))
        assert ngram_join.common_at_most(ngram_join.sketch_of(a), ngram_join.sketch_of(b)) >= len(np.intersect1d(a, b))


def test_common_lines(spark):
    line = "Common LINE 7 of words"
    own = [" ".join("abcdef"[d] + "xyzuvw"[k % 6] * (k // 6 + 1) for k in range(30)) for d in range(6)]
    rows = [(d, f"{own[d]}\n{line}", "h") for d in range(4)] + [(9, "\n".join([line] * 6), "h"), (10, None, None),
            (9, "\n".join([line] * 6), "h"), (11, own[5], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality_rules.quality_rules(docs, most_docs=2, min_chars=1).collect()
    got = sorted((r.doc_id, r.n_removed_lines, r.kept) for r in out)
    assert got == sorted([(d, 1, True) for d in range(4)] + [(9, 6, False)] * 2 + [(10, 0, False), (11, 0, True)])
    assert {r.clean_text for r in out if r.doc_id == 0} == {own[0]}
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_common_lines_of_small_and_large_hosts_against_sql(spark, tmp_path):
    """Lines are removed in a host of 6 documents as in one of 400; other hosts, short lines and 5 documents count not."""
    rng = random.Random(8)
    own = lambda n: " ".join(rng.choice("abcdefgh") * 5 + str(rng.random()) for _ in range(n))
    line = "All Rights reserved by the makers of these pages, 2024"
    rows = [(d, f"{own(30)}\n{line.upper()}\n{own(30)}", "small") for d in range(6)]
    rows += [(d, f"{own(30)}\n  {line}", "five") for d in range(10, 15)]
    rows += [(d, f"{own(30)}\nread more here", "short") for d in range(20, 40)]
    rows += [(d, f"{own(3)}\n" + f"{line.replace('2024', str(d)[-4:].zfill(4))}\n" * 4, "large") for d in range(100, 106)]
    rows += [(d, own(40), "large") for d in range(200, 594)]
    rows += [(600, None, "small"), (601, "", None), (602, line, None), (602, line, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    removed = {d: r.n_removed_lines for d, r in out.items() if r.n_removed_lines}
    assert removed == {**dict.fromkeys(range(6), 1), **dict.fromkeys(range(100, 106), 4)}
    assert all(out[d].kept for d in (*range(6), *range(10, 15), *range(20, 40), *range(200, 594)))
    assert not any(out[d].kept or out[d].base_failed for d in range(100, 106) if out[d].n_repeat_words == 0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    n, found = differences(quality_rules.op8_quality_rules(spark, str(tmp_path)), db, quality_rules.ORACLE_SQL)
    assert n == len(rows) and not found, found


def test_a_document_of_common_lines_is_depleted(spark):
    rng = random.Random(9)
    shared = [" ".join(f"{rng.choice('xyz')}{rng.random()}" for _ in range(6)) for _ in range(8)]
    rows = [(d, "\n".join([*shared, f"only here {d}"]), "h") for d in range(6)]
    rows += [(9, "\n".join(" ".join(f"w{rng.random()}" for _ in range(6)) for _ in range(8)), "h")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [(out[d].base_failed, out[d].n_removed_lines, out[d].kept) for d in range(6)] == [(False, 8, False)] * 6
    assert out[9].kept and out[0].clean_text == "only here 0"


def test_hosts_paths_and_rules(spark):
    urls = {1: ("http://A.Example.ORG/en/1x?q=/es/", "a.example.org", "/en/1x", "example.org/en/1", "block"),
            2: ("https://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
            3: ("x://my.org", "my.org", "", None, None), 4: ("no host", "", "", None, None), 5: (None, "", "", None, None),
            6: ("http://notexample.org/es/?a", "notexample.org", "/es/", "org/", "allow"),
            7: ("http://b.com/de/x#y", "b.com", "/de/x", "com/de/", "block"), 8: ("a://b://c/d", "b:", "//c/d", None, None)}
    rows = [(i, u[0], "h") for i, u in urls.items()] + [(2, urls[2][0], "h")]
    out = url_filters.url_filters(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(out) == len(rows)
    for r in out:
        _, host, path, rule, verdict = urls[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict


def test_variable_segments_become_wildcards(spark):
    rows = [(i, f"http://h.com/{lang}/{i}") for i in range(40) for lang in ("de", "fr", "en")]
    out = url_filters.url_filters(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.template for r in out} == {"/de/*", "/fr/*", "/*/*"}
    assert {r.verdict for r in out if "/de/" in r.path} == {"block"}
    assert url_filters.url_filters(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_components_of_few_and_of_many_links(spark, monkeypatch):
    """Chains, stars and rings, joined in one task and by steps over the table."""
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(300 + rng.randrange(60), 300 + rng.randrange(60)) for _ in range(45)] + [(5, 5)]
    names = list(range(400))
    rng.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    expected = {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    links = spark.createDataFrame(edges, "a long, b long")
    for few in (ngram_join.FEW_LINKS, 20, -1):
        monkeypatch.setattr(ngram_join, "FEW_LINKS", few)
        assert {r["class"]: r.component for r in ngram_join.components(links).collect()} == expected
    assert ngram_join.components(links.limit(0)).collect() == []
