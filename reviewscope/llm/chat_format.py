r"""Chat records of any known layout to one marked-up training text with a loss mask.

The nested field paths of a record are hashed; the hash selects a declarative
mapping (one SQL expression) to canonical turns. Typed tables are fingerprinted
by their schema, JSON records one by one. An unknown layout gives NULL turns and
the layout name ``unknown``; it is never guessed.

Template: every turn is ``### role: text</turn>\n``. Inside roles and texts the
control strings are escaped with a backslash, so a text can hold any of them and
is read back unchanged.

Edge cases: a NULL text or role is empty; a record without turns gives an empty
text and no loss spans; turns with equal numbers are ordered by role, then text,
NULL first; repeated rows are repeated turns; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# The template.
HEAD, MID, TAIL = "### ", ": ", "</turn>\n"
# Escapes, in the order in which they are written; read back in reverse.
TEXT_ESCAPES = (("\\", r"\b"), ("</turn>", r"\l/turn>"), ("### ", r"\h## "))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", r"\c"))
LOSS_ROLE = "assistant"

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A layout by its field paths, and turns as SQL over ``record`` (a struct, or a VARIANT for JSON)."""

    name: str
    paths: tuple[str, ...]
    typed: str
    json: str


def _pair(user: str, assistant: str) -> str:
    return f"array(struct('user' as role, {user} as text), struct('assistant' as role, {assistant} as text))"


def _get(path: str, kind: str = "string") -> str:
    return f"try_variant_get(record, '$.{path}', '{kind}')"


def _listed(field: str, role: str, text: str, kind: str) -> tuple[str, str]:
    turn = f"x -> struct({kind.replace('ROLE', f'x.{role}')} as role, x.{text} as text)"
    json = _get(field, f"array<struct<{role}:string,{text}:string>>")
    return f"transform(record.{field}, {turn})", f"transform({json}, {turn})"


_SHARED_ROLES = "case ROLE when 'human' then 'user' when 'gpt' then 'assistant' else ROLE end"
_ASK = "concat_ws('\\n\\n', {a}, nullif({b}, ''))"
LAYOUTS = (
    Layout("prompt", ("prompt", "response"), _pair("record.prompt", "record.response"), _pair(_get("prompt"), _get("response"))),
    Layout("completion", ("completion", "prompt"), _pair("record.prompt", "record.completion"), _pair(_get("prompt"), _get("completion"))),
    Layout("question", ("answer", "question"), _pair("record.question", "record.answer"), _pair(_get("question"), _get("answer"))),
    Layout("instruction", ("instruction", "output"), _pair("record.instruction", "record.output"), _pair(_get("instruction"), _get("output"))),
    Layout(
        "instruction_input", ("input", "instruction", "output"),
        _pair(_ASK.format(a="record.instruction", b="record.input"), "record.output"),
        _pair(_ASK.format(a=_get("instruction"), b=_get("input")), _get("output")),
    ),
    Layout("messages", ("messages[].content", "messages[].role"), *_listed("messages", "role", "content", "ROLE")),
    Layout("shared", ("conversations[].from", "conversations[].value"), *_listed("conversations", "from", "value", _SHARED_ROLES)),
    Layout("turns", ("turns[].role", "turns[].text", "turns[].turn"), *_listed("turns", "role", "text", "ROLE")),
)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` marks the elements of an array."""
    if isinstance(kind, StructType):
        head = f"{prefix}." if prefix else ""
        return [p for f in kind.fields for p in schema_paths(f.dataType, head + f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def canonical_turns(records: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``turns`` and ``layout`` from a struct column; its schema's fingerprint selects the mapping."""
    known = {fingerprint(layout.paths): layout for layout in layouts}
    found = known.get(fingerprint(schema_paths(records.schema[column].dataType)))
    if found is None:
        return records.withColumns({"turns": F.lit(None).cast(TURNS), "layout": F.lit("unknown")})
    bound = found.typed.replace("record.", f"`{column}`.")
    return records.withColumns({"turns": F.expr(bound).cast(TURNS), "layout": F.lit(found.name)})


def canonical_turns_json(records: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``turns`` and ``layout`` from JSON text; every record is fingerprinted by itself.

    Text that is no JSON object, or NULL, has the layout ``unknown`` and NULL turns.
    """
    named = records.withColumn("record", F.try_parse_json(F.col(column)))
    named = named.withColumn("_print", F.sha2(F.array_join(json_paths("record"), "\n"), 256))
    turns, layout = F.lit(None).cast(TURNS), F.lit("unknown")
    for known in layouts:
        hit = F.col("_print") == fingerprint(known.paths)
        turns = F.when(hit, F.expr(known.json).cast(TURNS)).otherwise(turns)
        layout = F.when(hit, known.name).otherwise(layout)
    return named.withColumns({"turns": turns, "layout": layout}).drop("record", "_print")


def json_paths(record: str) -> Column:
    """Sorted field paths of a VARIANT down to the fields of objects in top-level arrays."""
    nested = F.expr(
        f"flatten(transform(map_entries(try_variant_get({record}, '$', 'map<string,variant>')), e -> "
        "coalesce(transform(array_distinct(flatten(transform("
        "try_variant_get(e.value, '$', 'array<map<string,variant>>'), m -> map_keys(m)))), "
        "k -> concat(e.key, '[].', k)), array(e.key))))"
    )
    return F.sort_array(F.coalesce(nested, F.array().cast("array<string>")))


def escape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    text = F.coalesce(text, F.lit(""))
    for plain, escaped in escapes:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    """In an escaped text every backslash starts an escape, so the codes can be replaced one after the other."""
    for plain, escaped in reversed(escapes):
        text = F.replace(text, F.lit(escaped[:2]), F.lit(plain[:1]))
    return text


def format_chats(records: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (start and end in code points of ``formatted``) from ``turns``.

    The loss mask covers the escaped text of assistant turns, neither head nor end mark.
    """
    marked = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(HEAD), escape(t["role"], ROLE_ESCAPES), F.lit(MID)).alias("head"),
        escape(t["text"]).alias("body"),
        (F.coalesce(t["role"], F.lit("")) == LOSS_ROLE).alias("loss"),
    ))
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def advance(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(turn["head"])
        end = start + F.length(turn["body"])
        grown = F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(
            (end + len(TAIL)).alias("at"), F.when(turn["loss"], grown).otherwise(state["spans"]).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), spans.alias("spans"))
    return (
        records.withColumn("_marked", F.coalesce(marked, F.array().cast("array<struct<head:string,body:string,loss:boolean>>")))
        .withColumns({
            "formatted": F.array_join(F.transform("_marked", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))), ""),
            "loss_spans": F.aggregate("_marked", begin, advance, lambda state: state["spans"]),
        })
        .drop("_marked")
    )


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text, unescaped."""
    blocks = F.split(formatted, F.lit(TAIL))
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing follows the last end mark

    def turn(block: Column) -> Column:
        cut = F.instr(block, MID)
        return F.struct(
            unescape(F.substr(block, F.lit(len(HEAD) + 1), cut - F.lit(len(HEAD) + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(block, cut + F.lit(len(MID)))).alias("text"),
        )

    return F.transform(blocks, turn)


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def gather_turns(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) to one record per conversation, in order of the turns.

    A conversation is one output text, so its rows meet in one group of that
    size; a NULL conv_id is one conversation.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.struct(F.sort_array(F.collect_list(turn)).alias("turns")).alias("chat"))
