"""Repairs against a programme that carries whole audits, on damaged rows and with small blocks."""

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridlake.llm import conversation_repair as repair

SF_DIR = os.environ.get("GRIDLAKE_TEST_SF_DIR", "/root/testdata/sf0.001")

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    return {conv: sorted(g) for conv, g in groups.items()}


def expected(group):
    """The result for one conversation: cheapest (cost, audit, text) from every place and end of the roles so far."""
    seen, kinds = set(), []
    for _, _, role, text in group:
        body = text.strip(" \t\n\v\f\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    grow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", []), "a": (0, "", []), "u": (2, "I", ["assistant:"]), "s": (4, "II", ["user:", "assistant:"])}
    for (_, _, role, text), kind in zip(reversed(group), reversed(kinds)):
        late, new = int(kind == "truncated"), {}
        for state in grow:
            choices = [(best[state][0] + 3, "D" + best[state][1], best[state][2])]
            if kind not in ("blank", "duplicate"):
                if role[:1] and role[:1] in grow[state]:
                    c, a, t = best[role[:1]]
                    choices.append((c + late, "K" + a, [f"{role}:{text}"] + t))
                wanted = "assistant" if state == "u" else "user"
                c, a, t = best[wanted[0]]
                choices.append((c + late + 2, "R" + a, [f"{wanted}:{text}"] + t))
            new[state] = min(choices, key=lambda x: x[:2])
        for _ in range(4):
            for state in grow:
                wanted = "assistant" if state == "u" else "user"
                c, a, t = new[wanted[0]]
                new[state] = min(new[state], (c + 2, "I" + a, [f"{wanted}:"] + t), key=lambda x: x[:2])
        best = new
    turns = [t for there, t, _, _ in group if there]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    starts = [r[:1] for _, _, r, _ in group]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(starts, starts[1:]))
    cost, audit, text = best[""]
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(text).encode()).hexdigest())


def found(spark, rows, block):
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "block": F.lit("x"), "pos": F.lit(2)})
    edits, numbers = repair.repair_conversations(turns, block=block)
    both = numbers.join(repair.with_digests(edits), "id")
    return {r.id: tuple(r[c] for c in COLUMNS) for r in both.collect()}


def name(conv):
    return "" if conv is None else f"={conv}"


@pytest.mark.parametrize("block", [3, repair.BLOCK])
def test_equals_brute_force_on_random_conversations(spark, block):
    random.seed(11)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(random.choice([1, 2, 3, 5, 9, 16])):
            rows.append((conv, random.choice([turn, turn, turn, None, turn // 2]),
                         random.choice(["user", "assistant", "system", "tool", "", " "]),
                         random.choice(["Yes.", "no", " ", "", "Why? ", "a.b", "So!\n", f"{turn}."])))
    wanted = {name(c): expected(g) for c, g in by_conversation(rows).items()}
    assert found(spark, rows, block) == wanted


def test_cheapest_of_all_edits():
    """Costs and audits of short signatures against every sequence of edits."""
    for symbols in itertools.product("suao-SUAO", repeat=2):
        best = None
        for n in range(0, 6):
            for edits in itertools.product("DIKR", repeat=n):
                state, at, cost = "", 0, 0
                for e in edits:
                    want = "a" if state == "u" else "u"
                    if e == "I":
                        state, cost = want, cost + 2
                        continue
                    if at == 2 or (e != "D" and symbols[at] == "-"):
                        break
                    low, late = symbols[at].lower(), symbols[at].isupper()
                    if e == "D":
                        cost += 3
                    elif e == "R":
                        state, cost = want, cost + 2 + late
                    elif low in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                        state, cost = low, cost + late
                    else:
                        break
                    at += 1
                else:
                    if at == 2 and state in ("", "a"):
                        best = min(best or (cost, "".join(edits)), (cost, "".join(edits)))
        nodes = repair.SuffixNodes()
        nodes.move(None, "".join(symbols))
        assert (nodes.path[-1][0][repair.START], nodes.audit(repair.START)[0]) == best


def test_shared_ends_are_built_once():
    nodes = repair.SuffixNodes()
    for signature in sorted(["suaua", "uaua", "aua", "aaua"], key=lambda s: s[::-1]):
        nodes.move(None, signature)
    assert nodes.built == len("uaua") + 1 + 1


def test_query_equals_brute_force_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    groups = by_conversation(damage(rows))
    wanted = {c: expected(groups.get(c, [])) for c in {r[0] for r in rows}}
    got = repair.op11_conversation_repair(spark, SF_DIR)
    assert got.columns == ["conv_id", *COLUMNS]
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == wanted
    assert sum(w[5] > 0 for w in wanted.values()) > 5


def test_damage_and_empty_tables(spark, tmp_path):
    rows = [(c, t, "user", "Is it? Yes.") for c in [None, 1, 2] for t in [None, *range(40)]]
    rows += [(9, 1, None, None), (9, 1, None, None), (9, 2, "user", "x" * 300_000 + ".")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    groups = by_conversation(damage(rows))
    wanted = {c: expected(groups.get(c, [])) for c in {r[0] for r in rows}}
    got = repair.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == wanted
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(path)
    assert repair.op11_conversation_repair(spark, str(tmp_path)).collect() == []
