"""Chat formatting: records of different layouts become canonical turns, then marked text.

A record is a JSON object. Its fingerprint is a hash of its nested field paths, without
types or values; the fingerprint selects a declarative mapping (:data:`LAYOUTS`) that says
where turns are. The template is ``### role: text</turn>`` and a newline for each turn.
Inside roles and texts ``\\``, ``<``, ``#`` (and ``:`` in roles) become ``\\b``, ``\\l``,
``\\h``, ``\\c``; so no text can hold a control string, and reading back is exact.

Built-in functions only. A conversation is one output row, hence one group; long texts of
many conversations are spread by conversation.

Defined cases: null texts and roles are empty; turns sort by turn, role and text, null turns
first, and repeated rows are repeated turns; records that are no JSON or of an unknown layout
yield no turns and are what :func:`unmapped` returns; a conversation without turns is absent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS = "array<struct<seq:bigint,role:string,text:string>>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """``shapes``: field paths, sorted, of the records it maps; ``schema``: of what it reads."""

    shapes: tuple[str, ...]
    schema: str
    turns: str


#: In SQL over the parsed record ``r``; each gives an array of (seq, role, text).
LAYOUTS = {
    "turn rows": Layout(
        ("OBJECT<conv_id, role, text, turn>",),
        "conv_id bigint, role string, text string, turn bigint",
        "array(named_struct('seq', r.turn, 'role', r.role, 'text', r.text))",
    ),
    "messages": Layout(
        ("OBJECT<conv_id, messages: ARRAY<OBJECT<content, role>>>", "OBJECT<conv_id, messages: ARRAY<VOID>>"),
        "conv_id bigint, messages array<struct<content:string,role:string>>",
        "transform(r.messages, (m, i) -> named_struct('seq', cast(i as bigint), 'role', m.role, 'text', m.content))",
    ),
    "from and value": Layout(
        ("OBJECT<conv_id, conversations: ARRAY<OBJECT<from, value>>>",),
        "conv_id bigint, conversations array<struct<from:string,value:string>>",
        "transform(r.conversations, (m, i) -> named_struct('seq', cast(i as bigint), 'role',"
        " CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END, 'text', m.value))",
    ),
    "instruction": Layout(
        ("OBJECT<conv_id, input, instruction, output>",),
        "conv_id bigint, input string, instruction string, output string",
        "array(named_struct('seq', 0L, 'role', 'user', 'text', concat_ws('\\n', r.instruction, nullif(r.input, ''))),"
        " named_struct('seq', 1L, 'role', 'assistant', 'text', r.output))",
    ),
    "prompt": Layout(
        ("OBJECT<completion, conv_id, prompt>",),
        "completion string, conv_id bigint, prompt string",
        "array(named_struct('seq', 0L, 'role', 'user', 'text', r.prompt),"
        " named_struct('seq', 1L, 'role', 'assistant', 'text', r.completion))",
    ),
}


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON record; null if it is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    return F.xxhash64(F.regexp_replace(shape, r": (?!OBJECT<|ARRAY<)[A-Z]+(?:\([0-9]+,\s?[0-9]+\))?(?=[,>])", ""))


def _layout(record: Column) -> Column:
    found = F.when(F.try_parse_json(record).isNull(), F.lit(None))
    mark = fingerprint(record)
    for name, layout in LAYOUTS.items():
        found = found.when(mark.isin([F.xxhash64(F.lit(s)) for s in layout.shapes]), F.lit(name))
    return found


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """One row per turn: ``conv_id``, ``seq``, ``role``, ``text``."""
    marked = records.select(F.col(record).alias("record")).withColumn("layout", _layout(F.col("record")))
    turns = F.array().cast(TURNS)
    conv = F.lit(None).cast("bigint")
    for name, layout in LAYOUTS.items():
        parsed = f"from_json(record, '{layout.schema}')"
        this = F.col("layout") == name
        turns = F.when(this, F.expr(layout.turns.replace("r.", f"{parsed}.")).cast(TURNS)).otherwise(turns)
        conv = F.when(this, F.expr(f"{parsed}.conv_id")).otherwise(conv)
    return marked.select(conv.alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.*")


def unmapped(records: DataFrame, record: str = "record") -> DataFrame:
    """The records whose layout no mapping knows."""
    return records.where(_layout(F.col(record)).isNull())


def escaped(text: Column, role: bool = False) -> Column:
    for plain, mark in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), *([(":", "\\c")] if role else [])):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in (("<", "\\l"), ("#", "\\h"), (":", "\\c"), ("\\", "\\b")):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``mask``, the spans of assistant texts in it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    by_turn = W.partitionBy("conv_id").orderBy("seq", "role", "text")
    head = F.concat(F.lit("### "), escaped(role, role=True), F.lit(": "))
    placed = (
        turns.select("conv_id", "seq", role.alias("role"), text.alias("text"))
        .withColumn("head", F.length(head))
        .withColumn("turn_text", F.concat(head, escaped(F.col("text")), F.lit("</turn>\n")))
        .withColumn("nth", F.row_number().over(by_turn))
        .withColumn("end", F.sum(F.length("turn_text")).over(by_turn.rowsBetween(W.unboundedPreceding, 0)))
    )
    start = F.col("end") - F.length("turn_text") + F.col("head")
    span = F.struct(start.alias("start"), (F.col("end") - len("</turn>\n")).alias("end"))
    each = F.struct(
        "nth", "turn_text", F.when(F.col("role") == ASSISTANT, span).alias("masked")
    )
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("turns"))
    return grouped.select(
        "conv_id",
        F.array_join("turns.turn_text", "").alias("formatted"),
        F.filter("turns.masked", lambda m: m.isNotNull()).alias("mask"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and text under the loss mask, read from ``formatted`` and ``mask`` alone."""
    parts = F.split("formatted", "</turn>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, ": ", 1)
        text = F.substring(part, F.length(role) + 3, F.length(part))
        return F.struct(
            unescaped(F.substring(role, F.lit(5), F.length(role))).alias("role"), unescaped(text).alias("text")
        )

    under = F.transform(
        "mask",
        lambda m: unescaped(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))),
    )
    return chats.withColumn("turns", F.transform(parts, turn)).withColumn("loss_text", F.array_join(under, ""))


def report(records: DataFrame) -> DataFrame:
    back = read_back(formatted(canonical_turns(records)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows of a turn each as records of the layout "turn rows"."""
    fields = F.struct(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return conversations.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))
