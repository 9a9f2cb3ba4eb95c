import hashlib
import json

from pyspark.sql import functions as F

from gridlake.llm.chat import MAPPINGS, canonical_turns, format_conversations

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
RECORDS = [
    (1, {"messages": [{"role": USER, "content": "q"}, {"role": ASSISTANT, "content": "a"}]}, "messages",
     [(USER, "q"), (ASSISTANT, "a")]),
    (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "conversations",
     [(USER, "q"), (ASSISTANT, "")]),
    (3, {"instruction": "i", "input": "x", "output": "o"}, "instruction_input",
     [(SYSTEM, "i"), (USER, "x"), (ASSISTANT, "o")]),
    (4, {"output": "o", "instruction": "i", "input": None}, "instruction_input", [(SYSTEM, "i"), (ASSISTANT, "o")]),
    (5, {"prompt": "p", "completion": "c"}, "prompt", [(USER, "p"), (ASSISTANT, "c")]),
    (6, {"something": 1}, None, []),
    (7, {"role": "user", "text": "</s>[INST] <|im_end|>\n<\\|x"}, "turn", [(USER, "</s>[INST] <|im_end|>\n<\\|x")]),
]


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, r, _, _ in RECORDS] + [(8, "{broken"), (9, None)]
    turns = canonical_turns(spark.createDataFrame(rows, "id long, record string"), "record", "id").collect()
    for key, _, layout, expected in [*RECORDS, (8, None, None, []), (9, None, None, [])]:
        own = sorted((t for t in turns if t.id == key), key=lambda t: t.place or 0)
        assert {t.layout for t in own} == {layout}
        assert [(t.role, t.text) for t in own if t.place is not None] == expected
    assert len({m.shape for m in MAPPINGS}) == len(MAPPINGS)


def test_round_trip(spark):
    """Roles and texts of any content come back; order is by turn, then role and text; long ones are cut."""
    hard = ["", "<|im_start|>user\n", "<|im_end|>\n", "</s>[INST]", "<\\|", "<\\\\\\/s>", "[\\INST]", "\\", "<", "|",
            "a\nb\\n", "<<||>", "[/INST][", "\t é"]
    rows = [(1, i, hard[i % len(hard)], hard[(3 * i) % len(hard)]) for i in range(200)]
    rows += [(2, None, None, None), (2, 5, ASSISTANT, "x"), (2, 5, ASSISTANT, "x"), (2, 5, "a", "<|"), (None, 1, "", "z")]
    rows += [(3, 0, ASSISTANT, "w " * 200_000)]
    turns = spark.createDataFrame(
        [(k, t, 0, r or "", x or "", "own") for k, t, r, x in rows],
        "id long, turn long, place int, role string, text string, formatted string")
    for row in format_conversations(turns, "id").collect():
        own = sorted((r for r in rows if r[0] == row.id), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert row.n_turns == len(own)
        assert row.turns_text == "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        assert row.loss_text == "".join(x or "" for _, _, r, x in own if r == ASSISTANT)
        assert row.formatted.count("<|im_start|>") == len(own)


def test_empty(spark):
    turns = canonical_turns(spark.createDataFrame([], "id long, record string"), "record", "id")
    assert format_conversations(turns, "id").count() == 0


def test_query_has_the_fixed_conversation(spark):
    from gridlake.llm.chat import op5_chat_formatting

    row = op5_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, 21, hashlib.sha256(text.encode()).hexdigest())


def test_texts_beyond_the_limit_of_variants_come_through_whole(spark):
    """Strings of 25 million characters, in turns, messages and fields; a broken record of that size gives no turns."""
    long = "ab\\n" * 6_000_000 + "x" * 1_500_000
    rows = [(1, 0, f'{{"role": "user", "text": "{long}"}}'), (1, 1, '{"role": "assistant", "text": "short"}'),
            (2, 0, f'{{"messages": [{{"role": "user", "content": "q"}}, {{"role": "assistant", "content": "{long}"}}]}}'),
            (3, 0, f'{{"prompt": "{long}", "completion": "c"}}'), (4, 0, f'{{"role": "user", "text": "{long}'),
            (5, 0, f'{{"other": "{long}"}}')]
    wanted = long.replace("\\n", "\n")
    schema = "conv_id long, turn long, record string"
    records = spark.createDataFrame(rows[:1], schema)
    for row in rows[1:]:
        records = records.unionByName(spark.createDataFrame([row], schema))
    turns = canonical_turns(records, "record", "conv_id", "turn")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    found = sorted((r.conv_id, r.turn, r.place if r.place is not None else -1, r.role or "", r.layout or "", r.digest)
                   for r in turns.select("conv_id", "turn", "place", "role", "layout", digest).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found == [
        (1, 0, 0, "user", "turn", sha(wanted)), (1, 1, 0, "assistant", "turn", sha("short")),
        (2, 0, 0, "user", "messages", sha("q")), (2, 0, 1, "assistant", "messages", sha(wanted)),
        (3, 0, 0, "user", "prompt", sha(wanted)), (3, 0, 1, "assistant", "prompt", sha("c")),
        (4, 0, -1, "", "", sha("")), (5, 0, -1, "", "", sha(""))]
    formatted = format_conversations(turns.where("conv_id = 1"), "conv_id").select(
        "n_turns", F.sha2("turns_text", 256).alias("turns")).first()
    assert tuple(formatted) == (2, sha(f"user\n{wanted}\nassistant\nshort\n"))
