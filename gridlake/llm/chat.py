"""Chat formatting: records of any known layout become turns, turns become marked text.

The nested field paths of a record are hashed; the hash selects a declarative mapping, which says where turns, roles
and texts are.  Turns are rendered with a mark before the role and one after the text.  Control strings inside
texts get a backslash after their first character, one more if there are some already, which is undone on reading.

Edge cases: a null role or text is an empty one; turns are ordered by turn number (null first), place in the record, role
and text, so repeated rows and ties have one order; a null conversation is one of its own; records of unknown layout or
malformed JSON give no turns and layout null; an empty table gives no rows; further columns are ignored.
A record of more than `LONG_RECORD` characters is known by its outer keys alone and read by the schema of its mapping, so
that texts of any length that a string can have come through whole.
Conversations are rendered in stretches of `STRETCH` turn numbers, so that a long one is not sorted in one row.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table

STRETCH = 64
#: Records of more characters are not parsed into variants, whose strings have a limit of 20 million.
LONG_RECORD = 10_000_000
#: Marks of the template, and the control strings that texts must not contain: a first character and a rest.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = "(\\||/s>|INST\\]|/INST\\])"
ESCAPE = f"([<\\[])(\\\\*){CONTROL}"
UNESCAPE = f"([<\\[])\\\\(\\\\*){CONTROL}"
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    `shape` has the nested field paths as `record_shape` writes them.  Either `items` is the path of an array of
    turns with the fields `role` and `text`, or `fields` lists paths of texts with their roles, in order; a null or
    empty text of `fields` is no turn.  `names` translates roles.
    """

    name: str
    shape: str
    items: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    names: tuple[tuple[str, str], ...] = ()


SHARED_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping("turn", "OBJECT<role, text>", items="$", role="role", text="text"),
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", items="$.messages"),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", items="$.conversations", role="from",
            text="value", names=SHARED_NAMES),
    Mapping("instruction", "OBJECT<instruction, output>",
            fields=(("$.instruction", "user"), ("$.output", "assistant"))),
    Mapping("instruction_input", "OBJECT<input, instruction, output>",
            fields=(("$.instruction", "system"), ("$.input", "user"), ("$.output", "assistant"))),
    Mapping("prompt", "OBJECT<completion, prompt>",
            fields=(("$.prompt", "user"), ("$.completion", "assistant"))),
    Mapping("prompt_system", "OBJECT<completion, prompt, system>",
            fields=(("$.system", "system"), ("$.prompt", "user"), ("$.completion", "assistant"))),
)


def record_shape(value: Column) -> Column:
    """Nested field paths of a variant in alphabetical order, without the types of the values."""
    return F.regexp_replace(
        F.schema_of_variant(value), ": (STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\\([0-9,]+\\))", "")


def _kind(mapping: Mapping) -> str:
    return f"struct<`{mapping.role}`:string,`{mapping.text}`:string>"


def items_of(value: Column, mapping: Mapping) -> Column:
    """The mapping's turns, or role and text of its fields, in a variant."""
    kind = _kind(mapping)
    if mapping.items == "$":
        return F.array(F.variant_get(value, "$", kind))
    if mapping.items:
        return F.coalesce(F.variant_get(value, mapping.items, f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    return F.array(*[F.struct(F.lit(role).alias("role"), F.variant_get(value, path, "string").alias("text"))
                     for path, role in mapping.fields])


def items_of_long(record: Column, mapping: Mapping) -> Column:
    """The same of a JSON text whose strings are too long for a variant; paths have one step."""
    kind, options = _kind(mapping), {"maxStringLen": str(2 ** 31 - 1)}
    if mapping.items == "$":
        return F.array(F.from_json(record, kind, options))
    if mapping.items:
        name = mapping.items.removeprefix("$.")
        found = F.from_json(record, f"struct<`{name}`:array<{kind}>>", options)[name]
        return F.coalesce(found, F.array().cast(f"array<{kind}>"))
    names = [path.removeprefix("$.") for path, _ in mapping.fields]
    found = F.from_json(record, f"struct<{','.join(f'`{n}`:string' for n in names)}>", options)
    return F.array(*[F.struct(F.lit(role).alias("role"), found[name].alias("text"))
                     for name, (_, role) in zip(names, mapping.fields)])


def turns_of(items: Column, mapping: Mapping) -> Column:
    if not mapping.items:
        return F.filter(items, lambda x: F.coalesce(x["text"], F.lit("")) != "")
    role = lambda x: F.coalesce(x[mapping.role], F.lit(""))
    if mapping.names:
        names = F.create_map(*[F.lit(n) for pair in mapping.names for n in pair])
        plain = role
        role = lambda x: F.coalesce(names[plain(x)], plain(x))
    return F.transform(items, lambda x: F.struct(
        role(x).alias("role"), F.coalesce(x[mapping.text], F.lit("")).alias("text")))


def outer_keys(mapping: Mapping) -> list[str]:
    if mapping.items == "$":
        return sorted([mapping.role, mapping.text])
    return [mapping.items.removeprefix("$.")] if mapping.items else sorted(p.removeprefix("$.") for p, _ in mapping.fields)


def canonical_turns(records: DataFrame, record: str, key: str, order: str | None = None,
                    mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turns of JSON records: key, turn (the record's `order`), place in the record, role, text, layout."""
    is_long = F.length(record) > LONG_RECORD
    parsed = records.select(
        F.col(key), (F.col(order) if order else F.lit(0)).cast("long").alias("turn"),
        F.try_parse_json(F.when(~is_long, F.col(record))).alias("value"),
        F.when(is_long, F.col(record)).alias("long_record"),
    ).withColumns({
        "fingerprint": F.xxhash64(record_shape(F.col("value"))),
        "keys": F.sort_array(F.json_object_keys("long_record"))})
    turns, layout = F.lit(None).cast("array<struct<role:string,text:string>>"), F.lit(None).cast("string")
    for mapping in mappings:
        chosen = F.col("fingerprint") == F.xxhash64(F.lit(mapping.shape))
        long_one = F.col("keys") == F.array(*[F.lit(k) for k in outer_keys(mapping)])
        turns = F.when(chosen, turns_of(items_of(F.col("value"), mapping), mapping)).when(
            long_one, turns_of(items_of_long(F.col("long_record"), mapping), mapping)).otherwise(turns)
        layout = F.when(chosen | long_one, mapping.name).otherwise(layout)
    return parsed.select(
        key, "turn", layout.alias("layout"), F.posexplode_outer(turns).alias("place", "t")
    ).select(key, "turn", "place", "t.role", "t.text", "layout")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), "\\\\\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def rendered(turns: DataFrame, key: str) -> DataFrame:
    """Key, stretch, its turns in order as marked text, and the marked text's pieces, one per turn."""
    one = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")))
    rows = turns.withColumns({
        "stretch": F.floor(F.col("turn") / STRETCH),
        "entry": F.when(F.col("place").isNotNull(), F.struct("turn", "place", "role", "text", one.alias("piece")))})
    grouped = rows.groupBy(key, "stretch").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return grouped.select(key, "stretch", F.array_join(F.transform(
        "entries", lambda e: F.concat(e["piece"], F.lit(END))), "").alias("formatted"))


def read_back(stretches: DataFrame, key: str) -> DataFrame:
    """What the marked text says: key, stretch, turns as an array of role and text."""
    marks = START.replace("|", "\\|"), END.replace("|", "\\|")
    pieces = F.filter(F.split("formatted", marks[1]), lambda p: p != "")

    def turn(piece):
        body = F.substr(piece, F.lit(len(START) + 1))
        at = F.instr(body, "\n")
        return F.struct(unescape_role(F.substr(body, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substr(body, at + F.lit(1))).alias("text"))

    return stretches.withColumn("turns", F.transform(pieces, turn))


def joined(parts: str) -> Column:
    """Text of the stretches of a conversation, in order."""
    return F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("stretch", F.col(parts).alias("part")))), lambda x: x["part"]), "")


def format_conversations(turns: DataFrame, key: str) -> DataFrame:
    """Key, n_turns, formatted text, and what is read back from it: all turns as text, and the text to learn from."""
    read = read_back(rendered(turns, key), key)
    texts = read.withColumns({
        "n": F.size("turns").cast("long"),
        "said": F.array_join(F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
        "learned": F.array_join(F.transform(
            F.filter("turns", lambda t: t["role"] == LEARNED_ROLE), lambda t: t["text"]), "")})
    return texts.groupBy(key).agg(
        F.sum("n").alias("n_turns"), joined("formatted").alias("formatted"), joined("said").alias("turns_text"),
        joined("learned").alias("loss_text"))


def op5_chat_formatting(spark, sf_dir):
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    kinds = dict(table.dtypes)
    more = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    records = table.unionByName(more).select("conv_id", "turn", F.to_json(
        F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    done = format_conversations(canonical_turns(records, "record", "conv_id", "turn"), "conv_id")
    return done.select(
        "conv_id", "n_turns", F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length('<|im_start|>') + length(role) + 1 + length(text) + length('<|im_end|>') + 1
    + len(regexp_extract_all(text, '[<\\[]\\\\*(\\||/s>|INST\\]|/INST\\])')) as chars
  from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""
