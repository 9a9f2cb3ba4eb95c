"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct five-word shingles, hashed to 64 bits.  Documents with equal sets form a class, and
classes are joined: two link when 100 |intersection| >= 80 |union|.

Shingles are ordered, rare ones before frequent ones.  Two linked sets share at least 80 % of either, so the first two
shingles they share lie within the first n - ceil(0.8 n) + 2 of both.  If the first is rare, both sets have it among
their single-token signatures; if not, both shared shingles are frequent, and both sets have the pair as a
signature.  Sets of many shingles have their frequent ones as singles instead of pairs; sets of a size that may link with
either kind have both.  Which shingles count as frequent only decides how many candidates there are, never the result.

Classes with a common signature form a group.  Every class is first compared with the smallest one of a group, and those
that resemble each other form cells.  Then the cells that meet in a group are compared as a whole, and so are the classes of a
cell unless they are linked already: two parts of cells at a time, in a matrix product that counts the shingles in
common.  Single classes whose sketches, counts of shingles by bucket, leave no room for a link are passed over.  So every pair
of a group is compared or ruled out, and a large group of near copies does not become all its pairs.  Links are joined into components.

Edge cases: texts without words, null ones included, have an empty set and link with nothing; a text of fewer than five words
is one shingle; repeated rows and rows with a null id belong to the class of their set and are returned as often as
they occur; component_id is the smallest id of the component, or the own id (null too) without links; an empty table
gives no rows; further columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from gridlake.llm.common import BLANKS, LOWER, UPPER, read_table, small_batches, stage
from gridlake.llm.shingles import mix, shingle_sets

PERCENT = 80
#: A shingle is frequent if chunks of `CHUNK` shingles that have it `LOCAL` times or more add up to `FREQUENT`.
CHUNK, LOCAL, FREQUENT = 1 << 22, 3, 32
#: Frequent shingles that every task knows at most, the most frequent ones; 8 bytes each.
MAX_FREQUENT = 1 << 20
#: Sets of more shingles have no pairs as signatures.
PAIR_SIZE = 250
#: Texts of a side that a task compares.
MEMBERS = 256
#: Classes lie in the same cell from this similarity on, in percent; it decides what is compared together only.
ALIKE = 30
#: Shared shingles that are counted in one matrix product.
COLUMNS = 4096
#: Texts to compare are looked up by a broadcast of at most so many keys, about 80 bytes each; of more, by a shuffle.
BROADCAST_ROWS = 500_000
#: Links that a single task joins into components; of more, steps over the whole table leave fewer.
FEW_LINKS = 1_000_000


def common_at_least(n):
    """Shingles that a set of `n` has in common with any set that links with it."""
    return (PERCENT * n + 99) // 100


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit hash of a set; two different ones of 10**8 sets agree with a chance of 3 in 10,000."""
    total = mix(tokens ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def sketch_of(tokens: np.ndarray) -> bytes:
    """Shingles counted in about as many buckets as there are shingles, a byte each; nothing if a byte is too small."""
    bits = max(4, len(tokens).bit_length() - 1)
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def common_at_most(a: bytes, b: bytes) -> float:
    """A bound of the shingles that two sets have in common, from their sketches."""
    if not a or not b:
        return np.inf
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = (v.reshape(n, -1).sum(axis=1, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum())


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """The shingles that stand out in chunks of the table, at most `MAX_FREQUENT`, sorted."""

    def count(batches):
        held, size = [], 0

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(token[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            held += shingle_sets(batch.column("text").to_pylist())
            size += sum(map(len, held[-batch.num_rows:])) if batch.num_rows else 0
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    found = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    rows = found.orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().view(np.uint64))


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of rare and of frequent shingles of a set (sorted hashes)."""
    n = len(tokens)
    none = np.zeros(0, np.uint64)
    if n < 2:
        return none, none  # links with equal sets only
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
    else:
        often = np.zeros(n, bool)
    rare, common = tokens[~often], tokens[often]
    prefix = n - common_at_least(n) + 1
    single = rare[:prefix]
    pairs, alone = none, none
    if n <= PAIR_SIZE:
        own = common[:max(0, prefix + 1 - len(rare))]
        i, j = np.triu_indices(len(own), 1)
        pairs = mix(own[i] * np.uint64(3) + mix(own[j]))
    if 100 * n >= PERCENT * PAIR_SIZE:
        alone = common[:max(0, prefix - len(rare))]
    return single, np.concatenate([pairs, alone])


def set_table(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Per document: doc_id, text_hash, n_shingles, class, its signatures of rare and of frequent shingles, sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(frequent)  # at most 8 * MAX_FREQUENT bytes

    def describe(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist())
            both = [signatures(s, known.value) for s in sets]
            arrays = [pa.array([x[k].view(np.int64) for x in both], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_of(s) for s in sets], pa.int64()), *arrays,
                 pa.array([sketch_of(s) for s in sets], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "class", "rare", "common", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        describe, f"doc_id {kind}, text_hash long, n_shingles long, class long, rare array<long>, "
                  "common array<long>, sketch binary")


def groups(sets: DataFrame) -> DataFrame:
    """Signature, class and `pivot`, the smallest class of the signature; without the pivot itself."""
    rare = sets.select("class", F.explode("rare").alias("signature"))
    least = F.first("class").over(Window.partitionBy("signature").orderBy("class"))
    few = rare.withColumn("pivot", least).where(F.col("class") != F.col("pivot"))
    # Many classes may have a frequent signature: its smallest class is found before the shuffle, then joined.
    common = stage(sets.select("class", F.explode("common").alias("signature")).distinct(), "common")
    least_common = common.groupBy("signature").agg(F.min("class").alias("pivot"), F.max("class").alias("last"))
    many = common.join(least_common.where(F.col("pivot") != F.col("last")), "signature").where(
        F.col("class") != F.col("pivot"))
    names = ["signature", "class", "pivot"]
    return stage(few.select(*names).distinct().unionByName(many.select(*names)), "groups")


def with_texts(docs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """`rows`, which have a class, with the text of one document of it."""
    first = sets.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    wanted = stage(rows.join(first, "class").select(
        *rows.columns, F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash")), "wanted")
    at = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return texts.join(at, (F.col("text_hash") == F.col("one_hash")) & F.col("doc_id").eqNullSafe(
        F.col("one_id"))).select(*rows.columns, "text")


def compare(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) with their sizes and the size of their intersection.

    The texts of both are brought together, `MEMBERS` of b at a time for an a that has many.
    """
    pairs = pairs.select("a", "b").distinct()
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select(
        F.col("b").alias("class"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("member"))
    heads = parts.select(F.col("a").alias("class"), "a", F.explode(F.sequence(
        F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"))
    texts = with_texts(docs, sets, members.unionByName(heads))

    def intersect(batches):
        key, head = None, None
        for batch in batches:
            found = [[] for _ in range(5)]
            columns = [batch.column(c).to_pylist() for c in ("a", "part", "member", "class")]
            for a, part, member, b, own in zip(*columns, shingle_sets(batch.column("text").to_pylist())):
                if not member:
                    key, head = (a, part), own
                    continue
                assert key == (a, part)
                both = len(head) + len(own) - len(np.unique(np.concatenate([head, own])))
                for column, value in zip(found, (a, b, len(head), len(own), both)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in found], names=["a", "b", "n_a", "n_b", "common"])

    near = texts.repartition("a", "part").sortWithinPartitions("a", "part", "member", "class")
    return near.mapInArrow(intersect, "a long, b long, n_a long, n_b long, common long")


def components(links: DataFrame) -> DataFrame:
    """Node and the smallest node reachable, for the nodes of `links` (a, b).

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which keep the components and end with
    every node linked to the smallest one; a step needs sums by node only.  Each step leaves fewer links or nearer ones;
    `FEW_LINKS` or fewer, 16 bytes each, are joined in one task, to the same result.
    """
    edges = stage(links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now[0] <= FEW_LINKS:
            return edges.repartition(1).mapInArrow(_join_few, "class long, component long")
        if now == state:
            roots = edges.select(F.col("v").alias("u"), "v").distinct()
            return edges.unionByName(roots).select(F.col("u").alias("class"), F.col("v").alias("component"))
        state = now
        # Both directions once on disk: the sums by node and the join with them read it.
        both = stage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def _join_few(batches):
    """Every node of a few links with the smallest one that it reaches."""
    root: dict[int, int] = {}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            a, b = find(root.setdefault(u, u)), find(root.setdefault(v, v))
            root[max(a, b)] = min(a, b)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(root), pa.int64()), pa.array([find(x) for x in root], pa.int64())], names=["class", "component"])


def block_links(sets: list[np.ndarray], sides: list[int], labels: list[int]) -> list[tuple[int, int]]:
    """Links between a first and a second side, or within a single one, that join different labels; a spanning few."""
    n = np.array([len(s) for s in sets], np.int64)
    token, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = count > 1
    column = np.cumsum(shared) - 1
    kept = shared[where]
    owner, where = owner[kept], column[where[kept]]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    side = np.array(sides)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(right):
        right = left
    common = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        part = slice(*np.searchsorted(where, [first, first + COLUMNS]))
        table = np.zeros((len(sets), COLUMNS), np.float32)
        table[owner[part], where[part] - first] = 1
        common += table[left] @ table[right].T
    i, j = np.nonzero(100 * common >= PERCENT * (n[left][:, None] + n[right][None, :] - common))
    root = {x: x for x in labels}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(left[i].tolist(), right[j].tolist()):
        a, b = find(labels[x]), find(labels[y])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def compare_cells(docs: DataFrame, sets: DataFrame, cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the given pairs of cells (first, second), equal ones included.

    `cells` has class, component and cell.  A cell is compared with the classes of all its partners together; both are cut
    into parts of about `MEMBERS` classes, and a task holds the sets of two parts.
    """
    def placed(rows, group):
        parts = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
        return parts, rows.join(parts, group).withColumn(
            "part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).drop("parts")

    def each(column, name):
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1)).alias(name)

    own_parts, own = placed(cells.select("cell", "class", "component"), "cell")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    # The larger cell of a pair is the one that its partners are gathered for.
    first, second = (sizes.select(F.col("cell").alias(c), F.col("size").alias(f"{c}_size")) for c in ("first", "second"))
    larger = F.col("first_size") >= F.col("second_size")
    across = pairs.where("first != second").join(first, "first").join(second, "second").select(
        F.when(larger, F.col("first")).otherwise(F.col("second")).alias("first"),
        F.when(larger, F.col("second")).otherwise(F.col("first")).alias("cell"))
    guest_parts, guests = placed(across.join(cells.select("cell", "class", "component"), "cell").drop("cell"), "first")
    inner = pairs.where("first = second").select(F.col("first").alias("cell")).join(own_parts, "cell").select(
        F.col("cell").alias("first"), F.lit(0).alias("guest"), each("parts", "i"), "parts").select(
        "first", "guest", "i", each("parts", "j")).where("i <= j")
    outer = own_parts.withColumnsRenamed({"cell": "first", "parts": "p"}).join(guest_parts, "first").select(
        "first", F.lit(1).alias("guest"), each("p", "i"), "parts").select("first", "guest", "i", each("parts", "j"))
    key = ["first", "guest", "i", "j"]
    hosts = own.withColumnRenamed("cell", "first")

    def side(jobs, rows, part, number):
        return jobs.join(rows.withColumnRenamed("part", part), ["first", part]).select(
            *key, F.lit(number).alias("side"), "class", "component")

    wanted = side(inner.unionByName(outer), hosts, "i", 0).unionByName(
        side(inner.where("i != j"), hosts, "j", 1)).unionByName(side(outer, guests, "j", 1))
    texts = with_texts(docs, sets, wanted)

    def search(batches):
        job, held = None, []

        def flush():
            found = block_links([h[0] for h in held], [h[1] for h in held], [h[3] for h in held])
            pairs = [[held[x][2] for x, _ in found], [held[y][2] for _, y in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "side", "class", "component")]
            for *own, side, name, label, tokens in zip(*columns, shingle_sets(batch.column("text").to_pylist())):
                if own != job:
                    if held:
                        yield flush()
                    job, held = own, []
                held.append((tokens, side, name, label))
        if held:
            yield flush()

    return texts.repartition(*key).sortWithinPartitions(*key, "side", "class").mapInArrow(search, "a long, b long")


def may_link(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of single classes (first, second) whose sketches leave room for a link."""
    wanted = pairs.select(F.explode(F.array("first", "second")).alias("class")).distinct()
    sketches = stage(sets.select("class", "n_shingles", "sketch").join(wanted, "class", "left_semi").dropDuplicates(
        ["class"]), "sketches")
    a, b = (sketches.select(F.col("class").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
            for c in ("first", "second"))

    @F.pandas_udf("boolean")
    def room(n_a: pd.Series, n_b: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        most = np.array([common_at_most(p, q) for p, q in zip(x, y)], dtype=np.float64)
        return pd.Series(100 * most >= PERCENT * (n_a.to_numpy() + n_b.to_numpy() - most))

    return pairs.join(a, "first").join(b, "second").where(
        room("n_first", "n_second", "sketch_first", "sketch_second")).select("first", "second")


def class_links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect all classes that are connected by any links."""
    shared = groups(sets)
    first = shared.groupBy("class").agg(F.min("pivot").alias("pivot"))
    compared = stage(compare(docs, sets, first.select(F.col("pivot").alias("a"), F.col("class").alias("b"))), "first")
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    links = compared.where(100 * F.col("common") >= PERCENT * union).select("a", "b")
    # Classes that resemble the one they were compared with lie in its cell, others in one of their own.
    alike = stage(components(compared.where(100 * F.col("common") >= ALIKE * union).select("a", "b")), "alike")
    # Every class of a group has a cell, also a pivot whose partners were all compared with a smaller one.
    grouped = shared.select("class").unionByName(shared.select(F.col("pivot").alias("class"))).distinct()
    names = sets.select("class", F.col("n_shingles").alias("n")).join(grouped, "class", "left_semi").distinct()
    cells = stage(names.join(alike.withColumnRenamed("component", "cell"), "class", "left").join(
        components(links), "class", "left").select(
        "class", "n", F.coalesce("cell", "class").alias("cell"), F.coalesce("component", "class").alias("component")),
        "cells")
    spans = cells.groupBy("cell").agg(
        F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("component").alias("least"), F.max("component").alias("last"))
    within = spans.where("least != last").select(F.col("cell").alias("first"), F.col("cell").alias("second"))
    # Cells that meet in a group; a cell comes once a group, however many of its classes are there.
    members = shared.select("signature", "class").unionByName(shared.select("signature", F.col("pivot").alias("class")))
    met = stage(members.join(cells.select("class", "cell"), "class").select("signature", "cell").distinct().join(
        spans.select("cell", "low", "high"), "cell"), "met")
    x, y = met.alias("x"), met.alias("y")
    fits = ((100 * F.col("x.high") >= PERCENT * F.col("y.low"))
            & (100 * F.col("y.high") >= PERCENT * F.col("x.low")))
    between = x.join(y, (F.col("x.signature") == F.col("y.signature")) & (F.col("x.cell") < F.col("y.cell"))).where(
        fits).select(F.col("x.cell").alias("first"), F.col("y.cell").alias("second")).distinct()
    # Cells of one class are named after it; the others are those that `alike` has names for.
    several = alike.select("component").distinct()
    met_pairs = stage(between.join(several.withColumnsRenamed({"component": "first"}).withColumn("f", F.lit(1)), "first", "left").join(
        several.withColumnsRenamed({"component": "second"}).withColumn("s", F.lit(1)), "second", "left"), "met_pairs")
    single = F.col("f").isNull() & F.col("s").isNull()
    lone = may_link(sets, met_pairs.where(single).select("first", "second"))
    pairs = stage(within.unionByName(met_pairs.where(~single).select("first", "second")).unionByName(lone), "pairs")
    return links.unionByName(stage(compare_cells(docs, sets, cells, pairs), "more"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, class, n_shingles, component_id."""
    small_batches(docs.sparkSession)
    sets = stage(set_table(docs, frequent_tokens(docs)), "sets")
    named = sets.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    joined = components(class_links(docs, sets))
    by_class = named.join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    by_component = by_class.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = by_class.join(by_component, "component").select("class", "component", "component_id")
    empty = F.col("n_shingles") == 0
    return sets.select("doc_id", "text_hash", "class", "n_shingles").join(ids, "class", "left").select(
        "doc_id", "text_hash", F.coalesce("component", "class").alias("component"), "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, one of each component: that of the smallest id; texts without words all stay."""
    worded = F.rlike(F.coalesce("text", F.lit("")), F.lit(f"[^{BLANKS}]"))
    found = stage(jaccard_components(docs.where(worded)), "components")
    kept = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    ).select("one.doc_id", "one.text_hash")
    counted = stage(found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies")).join(
        kept.distinct().withColumn("kept", F.lit(True)).alias("k"),
        F.col("k.doc_id").eqNullSafe(found["doc_id"]) & (F.col("k.text_hash") == found["text_hash"])).select(
        found["doc_id"].alias("kept_id"), found["text_hash"].alias("kept_hash"), "copies"), "kept")
    # Columns by table, as the documents may have columns of these names too.
    at = (counted["kept_hash"] == F.xxhash64(docs["text"])) & docs["doc_id"].eqNullSafe(counted["kept_id"])
    empty = docs.where(~worded)
    single = docs.join(counted.where("copies = 1"), at, "left_semi")
    repeated = docs.join(counted.where("copies > 1"), at, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated).unionByName(empty)


def op2_ngram_join(spark, sf_dir):
    return jaccard_components(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


ORACLE_SQL = f"""
with recursive docs as (
  select row_number() over () as row_id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents),
shingles as materialized (
  select distinct row_id, case when len(w) < 5 then list_aggregate(w, 'string_agg', ' ')
    else list_aggregate(w[i:i + 4], 'string_agg', ' ') end as shingle, len(w) < 5 as short
  from (select *, unnest(range(1, greatest(len(w) - 3, 2))) as i from docs where len(w) > 0)),
sizes as materialized (select row_id, count(*) as n from shingles group by row_id),
links as materialized (
  select x.row_id as a, y.row_id as b
  from (select s.row_id as x_id, t.row_id as y_id, count(*) as n
        from shingles s join shingles t
          on s.shingle = t.shingle and s.short = t.short and s.row_id <> t.row_id group by all) c
  join sizes x on x.row_id = x_id join sizes y on y.row_id = y_id
  where 100 * c.n >= {PERCENT} * (x.n + y.n - c.n)),
reach as (
  select row_id as a, row_id as b from docs
  union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from docs d left join sizes s using (row_id)
join (select a, min(doc_id) as component_id from reach join docs on reach.b = docs.row_id group by a) c
  on c.a = d.row_id
"""
