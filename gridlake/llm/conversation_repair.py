"""Repair of conversation structure: the cheapest edits that give every conversation the roles `(s?(ua)+)?`.

Each row becomes one symbol, its role's initial and its fault.  A conversation's symbols are its signature, read from the
end: signatures with the same end share the nodes of that end.  A node knows for each state of the grammar the cost to go
and the first edit of the best audit from there, so both are worked out once for all conversations that share it.
Distinct signatures are sorted from their ends and dealt in ranges, so that a task holds the nodes of one signature only.

Edits: K keep (0), R rerole to user or assistant (2), D delete (3, a must for blank and duplicate rows), I insert an
empty text of user or assistant (2); a truncated row that stays adds 1.  Among cheapest edits the audit that is least in
ASCII counts.  In a state of the grammar an edit has one outcome, so the first letter settles ties.

Signatures are cut into blocks of `BLOCK` rows.  What follows a block matters only by its cost to go in each state, and a
block in front of others is first measured for each state at its end; so the edits are the cheapest of the whole
conversation, and no step but the digest of the query has a whole conversation in one task.

Edge cases: null role and text are one blank each; rows are ordered by turn (null first), role and text, so ties and
repeated rows have one order; a null conversation is one of its own; a role whose initial is not s, u or a is never
kept; an empty conversation needs no edits; an empty table gives no rows; further columns are ignored, whatever
their names.  Rows that share a conversation and `SLICE` turn numbers are numbered by one sort.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlake.llm.common import BLANKS, read_table, small_batches, stage

#: Rows of a conversation in a block, and turn numbers in a slice that is sorted together.
BLOCK, SLICE = 4096, 1024
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, DONE = range(4)
STATES = (START, SYSTEM, USER, DONE)
#: State after a role's initial is added, and the role that an inserted or reroled row takes in a state.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): DONE, (DONE, "u"): USER}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", DONE: "user"}
NEXT = {state: AFTER[state, role[0]] for state, role in WANTED.items()}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: Symbol of a row that has to go; others are the initial (o for any but s, u, a), in upper case if truncated.
GONE, OTHER = "-", "o"
NEVER = 1 << 40
#: Costs to go at the end of a conversation before anything is inserted there.
END = (0, NEVER, NEVER, 0)


def node(symbol: str | None, ahead: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """Costs to go and first edits, by state, in front of a row whose followers cost `ahead`; None: the end itself."""
    late = int(symbol is not None and symbol.isupper())
    choices = []
    for state in STATES:
        if symbol is None:
            found = {"": ahead[state]}
        else:
            found = {"D": DELETE + ahead[state]}
            if symbol != GONE:
                found["R"] = REROLE + late + ahead[NEXT[state]]
                kept = AFTER.get((state, symbol.lower()))
                if kept is not None:
                    found["K"] = KEEP + late + ahead[kept]
        choices.append(found)
    plain = [min(c.values()) for c in choices]
    # Two inserts come back to the same state or a dearer one, so one step to user and one to done are enough.
    open_, done = min(plain[USER], INSERT + plain[DONE]), min(plain[DONE], INSERT + plain[USER])
    ahead_of = {START: open_, SYSTEM: open_, USER: done, DONE: open_}
    for state in STATES:
        choices[state]["I"] = INSERT + ahead_of[state]
    costs = tuple(min(c.values()) for c in choices)
    return costs, [min(e for e, cost in c.items() if cost == least) for c, least in zip(choices, costs)]


class SuffixNodes:
    """Nodes along one signature from its end; those of an end shared with the signature before are used again."""

    def __init__(self):
        self.follows, self.backward, self.path, self.built = None, "", [], 0

    def move(self, follows: tuple[int, ...] | None, signature: str) -> None:
        """Go to a signature; `follows` has the costs to go of the block after it, None for the end."""
        backward = signature[::-1]
        if follows != self.follows or not self.path:
            self.follows, self.backward = follows, ""
            self.path = [node(None, END) if follows is None else (follows, [""] * len(STATES))]
        shared = 0
        for a, b in zip(self.backward, backward):
            if a != b:
                break
            shared += 1
        del self.path[shared + 1:]
        for symbol in backward[shared:]:
            self.path.append(node(symbol, self.path[-1][0]))
            self.built += 1
        self.backward = backward

    def audit(self, state: int) -> tuple[str, int]:
        """Edits of the signature from a state on, and the state after them."""
        edits, at = [], len(self.path) - 1
        while True:
            edit = self.path[at][1][state]
            if edit == "":
                return "".join(edits), state
            edits.append(edit)
            if edit == "I":
                state = NEXT[state]
                continue
            symbol = self.backward[at - 1]
            at -= 1
            if edit != "D":
                state = NEXT[state] if edit == "R" else AFTER[state, symbol.lower()]


def costs_of(text: str) -> tuple[int, ...] | None:
    return tuple(map(int, text.split(","))) if text else None


def cost_text(costs) -> str:
    """Costs with the least at 0, so that blocks with the same differences ahead share nodes."""
    least = min(costs)
    return ",".join(str(NEVER if c >= NEVER else c - least) for c in costs)


def _through_nodes(wanted: DataFrame, schema: str, read) -> DataFrame:
    """`read(nodes, follows, signature)` of the distinct rows of `wanted`, sorted from the signatures' ends."""
    def run(batches):
        nodes = SuffixNodes()
        for batch in batches:
            out = [[] for _ in range(len(names))]
            for follows, signature in zip(batch["follows"].to_pylist(), batch["signature"].to_pylist()):
                nodes.move(costs_of(follows), signature)
                for values, value in zip(out, (follows, signature, *read(nodes))):
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types
    backward = F.reverse("signature")
    rows = wanted.select("follows", "signature").distinct()
    return rows.repartitionByRange(F.col("follows"), backward).sortWithinPartitions(
        F.col("follows"), backward).mapInArrow(run, schema)


def with_audits(blocks: DataFrame) -> DataFrame:
    """Blocks (id, block, last_block, signature) with audit, cost and the state in front of them."""
    lone = blocks.where(F.col("last_block") == 0).withColumns({"follows": F.lit(""), "state": F.lit(START)})
    several = blocks.where(F.col("last_block") > 0)
    chained = stage(_chained(several), "chains") if not several.isEmpty() else None
    wanted = lone if chained is None else lone.unionByName(several.join(chained, ["id", "block"]))

    def read(nodes):
        found = []
        for state in STATES:
            audit, after = nodes.audit(state) if nodes.path[-1][0][state] < NEVER else ("", state)
            ahead = 0 if nodes.follows is None else nodes.follows[after]
            found.append({"audit": audit, "cost": nodes.path[-1][0][state] - ahead})
        return [found]

    audits = _through_nodes(wanted, "follows string, signature string, found array<struct<audit:string,cost:bigint>>", read)
    return wanted.join(audits, ["follows", "signature"]).withColumn("best", F.get("found", "state")).select(
        "id", "block", "signature", "state", "best.audit", "best.cost")


def _chained(blocks: DataFrame) -> DataFrame:
    """id, block, costs to go after the block, and the state in front of it, of conversations with several blocks."""
    unit = [",".join("0" if s == exit_ else str(NEVER) for s in STATES) for exit_ in STATES]
    is_last = F.col("block") == F.col("last_block")
    ends = blocks.withColumn("follows", F.explode(F.when(is_last, F.array(F.lit(""))).otherwise(
        F.array(*[F.lit(u) for u in unit]))))
    measured = _through_nodes(ends, "follows string, signature string, costs array<bigint>",
                              lambda nodes: [list(nodes.path[-1][0])])
    sizes = ends.join(measured, ["follows", "signature"]).select("id", "block", "last_block", "follows", "costs")

    def chain(pdf):
        import pandas as pd

        table = {(b, f): c for b, f, c in zip(pdf["block"], pdf["follows"], pdf["costs"])}
        last = int(pdf["last_block"].iloc[0])
        ahead, follows = list(table[last, ""]), [""] * (last + 1)
        for block in range(last - 1, -1, -1):
            follows[block] = cost_text(ahead)
            known = costs_of(follows[block])
            ahead = [min(table[block, u][s] + known[e] for e, u in enumerate(unit)) for s in STATES]
        return pd.DataFrame({"id": pdf["id"].iloc[0], "block": range(last + 1), "follows": follows})

    follows = sizes.groupBy("id").applyInPandas(chain, "id string, block bigint, follows string")
    named = stage(blocks.join(follows, ["id", "block"]).select("id", "block", "last_block", "signature", "follows"),
                  "followed")
    after = _through_nodes(named, "follows string, signature string, after array<int>", lambda nodes: [
        [nodes.audit(s)[1] if nodes.path[-1][0][s] < NEVER else s for s in STATES]])

    def start(pdf):
        pdf = pdf.sort_values("block")
        states = [START]
        for outcome in list(pdf["after"])[:-1]:
            states.append(int(outcome[states[-1]]))
        return pdf.assign(state=states)[["id", "block", "follows", "state"]]

    return named.join(after, ["follows", "signature"]).select("id", "block", "follows", "after").groupBy(
        "id").applyInPandas(start, "id string, block bigint, follows string, state int")


def conversation_id(key: Column) -> Column:
    """The key as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def faulty_rows(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows with id, position `pos` in the conversation, turn, role, text, initial, fault and symbol; staged."""
    mark = f"[^{BLANKS}]"
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    rows = turns.select(conversation_id(F.col(key)).alias("id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({
        "slice": F.floor(F.col("turn") / SLICE), "initial": F.substring("role", 1, 1),
        "is_blank": ~F.rlike("text", F.lit(mark)), "is_truncated": ~F.rlike("text", F.lit(f"[.!?][{BLANKS}]*\\z")),
        "same": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)})
    inside = Window.partitionBy("id", "slice").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ranked = stage(rows.withColumn("rank", F.row_number().over(inside) - 1), "ranked")
    before = Window.partitionBy("of_id").orderBy(F.col("of_slice").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = ranked.groupBy(F.col("id").alias("of_id"), F.col("slice").alias("of_slice")).agg(
        F.count(F.lit(1)).alias("n")).select(
        "of_id", "of_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = ranked.join(starts, (F.col("id") == F.col("of_id")) & F.col("slice").eqNullSafe(F.col("of_slice"))).select(
        "id", (F.col("start") + F.col("rank")).cast("long").alias("pos"), "turn", "role", "text", "initial", "is_blank",
        "is_truncated", "same")
    # A text that fills a conversation is one row per task here, and the join splits what is frequent.
    first = placed.where(~F.col("is_blank")).groupBy("id", "same").agg(F.min("pos").alias("first"))
    found = placed.join(first, ["id", "same"], "left")
    fault = F.when(F.col("is_blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(
        F.col("is_truncated"), TRUNCATED)
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(OTHER)
    symbol = F.when(F.col("fault").isin(BLANK, DUPLICATE), GONE).when(
        F.col("fault") == TRUNCATED, F.upper(kind)).otherwise(kind)
    return stage(found.withColumn("fault", fault).select(
        "id", "pos", "turn", "role", "text", "initial", "fault", symbol.alias("symbol")), "faults")


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per block of a conversation: signature, counts of faults, and adjacent roles that the grammar forbids."""
    grouped = rows.groupBy("id", F.floor(F.col("pos") / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "symbol", "initial"))).alias("rows"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)])
    initials = grouped.select(
        "id", "block", BLANK, DUPLICATE, TRUNCATED, F.max("block").over(Window.partitionBy("id")).alias("last_block"),
        F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("signature"),
        F.transform("rows", lambda r: r["initial"]).alias("initials"))
    before = F.lag(F.get("initials", F.size("initials") - 1)).over(Window.partitionBy("id").orderBy("block"))
    led = initials.withColumn("led", F.when(F.col("block") == 0, F.col("initials")).otherwise(
        F.concat(F.array(before), F.col("initials"))))
    pairs = F.transform(F.slice("led", 2, block + 1), lambda x, i: F.concat(F.get("led", i), x))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long")
    return led.select("id", "block", "last_block", "signature", BLANK, DUPLICATE, TRUNCATED, illegal.alias("illegal"))


def edits_of(audits: DataFrame, block_rows: int) -> DataFrame:
    """One row per edit of a block: its place, the row it is about (none for an insert), and the role it gives."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(_edits_of_batch(batch, block_rows), pa.schema([
                ("id", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("pos", pa.int64()),
                ("edit", pa.string()), ("new_role", pa.string())]))

    return audits.select("id", "block", "signature", "state", "audit").mapInArrow(
        run, "id string, block bigint, place int, pos bigint, edit string, new_role string")


def _edits_of_batch(batch, block_rows: int) -> dict[str, list]:
    out = {"id": [], "block": [], "place": [], "pos": [], "edit": [], "new_role": []}
    for id_, block, signature, state, audit in zip(*[
            batch[c].to_pylist() for c in ("id", "block", "signature", "state", "audit")]):
        at = 0
        for place, edit in enumerate(audit):
            out["id"].append(id_)
            out["block"].append(block)
            out["place"].append(place)
            out["pos"].append(None if edit == "I" else block * block_rows + at)
            out["edit"].append(edit)
            out["new_role"].append(WANTED[state] if edit in "IR" else None)
            if edit in "IR":
                state = NEXT[state]
            elif edit == "K":
                state = AFTER[state, signature[at].lower()]
            at += edit != "I"
    return out


def repaired_rows(rows: DataFrame, audits: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every edit with the row that it leaves: id, block, place, edit, fault, role, text (null where deleted)."""
    edits = edits_of(audits, block)
    columns = ["id", "block", "place", "edit", "fault", "role", "text"]
    # Inserted rows have no position, so they pass the join by.
    inserted = edits.where(F.col("edit") == "I").select(
        "id", "block", "place", "edit", F.lit(None).cast("string").alias("fault"), F.col("new_role").alias("role"),
        F.lit("").alias("text"))
    stays = F.col("edit") != "D"
    others = edits.where(F.col("edit") != "I").join(rows, ["id", "pos"]).withColumns({
        "role": F.when(stays, F.coalesce("new_role", "role")), "text": F.when(stays, F.col("text"))})
    return others.select(columns).unionByName(inserted)


def repair_conversations(turns: DataFrame, key: str = "conv_id", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Two frames of `turns` (key, turn, role, text).

    First, the edits in order of `block` and `place`, with the rows they leave.  Second, one row per conversation that
    has rows: id (see `conversation_id`), gaps, blank, duplicate, truncated, illegal, cost.
    """
    rows = faulty_rows(turns, key)
    blocks = stage(blocks_of(rows, block), "blocks")
    audits = stage(with_audits(blocks), "audits")
    costs = audits.groupBy("id").agg(F.sum("cost").alias("cost"))
    numbers = blocks.groupBy("id").agg(*[F.sum(c).alias(c) for c in (BLANK, DUPLICATE, TRUNCATED, "illegal")])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    spans = rows.groupBy("id").agg(gaps.alias("gaps"))
    return repaired_rows(rows, audits, block), numbers.join(costs, "id").join(spans, "id")


def _digests(batches):
    """Audit and hash of the repaired text of each conversation, from rows in order; holds one batch at a time."""
    def done():
        return pa.RecordBatch.from_pydict({"id": [now], "audit": ["".join(edits)], "repaired_sha256": [seen.hexdigest()]})

    now, edits, seen, first = None, [], hashlib.sha256(), True
    for batch in batches:
        for id_, edit, role, text in zip(*[batch[c].to_pylist() for c in ("id", "edit", "role", "text")]):
            if id_ != now:
                if now is not None:
                    yield done()
                now, edits, seen, first = id_, [], hashlib.sha256(), True
            edits.append(edit)
            if edit != "D":
                seen.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
    if now is not None:
        yield done()


def with_digests(edits: DataFrame) -> DataFrame:
    """id, audit, repaired_sha256.  A hash reads its text in order, so a conversation passes through one task."""
    ordered = edits.select("id", "block", "place", "edit", "role", "text").repartition("id").sortWithinPartitions(
        "id", "block", "place")
    return ordered.mapInArrow(_digests, "id string, audit string, repaired_sha256 string")


def damaged(table: DataFrame) -> DataFrame:
    """Rows of `conversations` with the faults that their key's hash names; some are dropped, some repeated."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = table.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), hit.alias("hit"))
    return rows.where(F.col("hit") != 0).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def op11_conversation_repair(spark, sf_dir):
    small_batches(spark)
    table = read_table(spark, sf_dir, "conversations")
    edits, numbers = repair_conversations(damaged(table))
    all_ids = table.select("conv_id").distinct().withColumn("id", conversation_id(F.col("conv_id")))
    found = all_ids.join(numbers, "id", "left").join(with_digests(edits), "id", "left")
    counts = ["gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
