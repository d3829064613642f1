"""Conversations of any known layout, formatted for training with an escaped template and a loss mask.

Layouts are declarative: the field paths they need and the SQL expressions that give canonical turns. A table's nested
field paths are hashed layout by layout, and the fingerprint selects the mapping; rows of JSON text are fingerprinted
one by one in the same way.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climate_lake.session import materialise

TURNS = "array<struct<turn:long,role:string,text:string>>"

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Strings that chat templates use as controls, without their first character.
CONTROLS = [
    "|im_start|>", "|im_end|>", "|endoftext|>", "|startoftext|>", "|user|>", "|assistant|>", "|system|>", "|end|>",
    "|eot_id|>", "|start_header_id|>", "|end_header_id|>", "|begin_of_text|>", "|end_of_text|>", "s>", "/s>",
    "<SYS>>", "</SYS>>", "INST]", "/INST]", "start_of_turn>", "end_of_turn>", "bos>", "eos>", "pad>", "unk>",
]
_REST = "(?:" + "|".join(one.replace("|", r"\|").replace("]", r"\]") for one in CONTROLS) + ")"
# A control string, or one that was escaped before: one more backslash goes in after its first character.
ESCAPE = (rf"([<\[])(\\*)(?={_REST})", r"$1$2\\")
UNESCAPE = (rf"([<\[])(\\*)\\(?={_REST})", r"$1$2")


@dataclass(frozen=True)
class Layout:
    """``paths``: field paths with kind of value; ``turns``: SQL for ``TURNS``; ``per_row``: a row is one turn."""

    name: str
    paths: frozenset[str]
    turns: str
    per_row: bool = False

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: frozenset[str] | set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _listed(field: str, role: str, text: str) -> str:
    return f"transform({field}, (x, i) -> named_struct('turn', bigint(i), 'role', string(x.{role}), 'text', string(x.{text})))"


def _pairs(*pairs: tuple[str, str]) -> str:
    turns = ", ".join(f"named_struct('turn', {k}L, 'role', '{role}', 'text', string({text}))" for k, (role, text) in enumerate(pairs))
    return f"array({turns})"


# The most specific layout whose paths a table has is taken; ties go to the first.
LAYOUTS = [
    Layout("turn rows", frozenset(["conv_id:scalar", "turn:scalar", "role:scalar", "text:scalar"]), "", per_row=True),
    Layout("messages", frozenset(["messages[].role:scalar", "messages[].content:scalar"]), _listed("messages", "role", "content")),
    Layout("conversations", frozenset(["conversations[].from:scalar", "conversations[].value:scalar"]),
           _listed("conversations", "from", "value")),
    Layout("instruction with input", frozenset(["instruction:scalar", "input:scalar", "output:scalar"]),
           _pairs(("user", "if(coalesce(input, '') = '', instruction, concat(coalesce(instruction, ''), '\\n\\n', input))"), ("assistant", "output"))),
    Layout("instruction", frozenset(["instruction:scalar", "output:scalar"]), _pairs(("user", "instruction"), ("assistant", "output"))),
    Layout("system, prompt, response", frozenset(["system:scalar", "prompt:scalar", "response:scalar"]),
           _pairs(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("prompt, response", frozenset(["prompt:scalar", "response:scalar"]), _pairs(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt, completion", frozenset(["prompt:scalar", "completion:scalar"]), _pairs(("user", "prompt"), ("assistant", "completion"))),
    Layout("question, answer", frozenset(["question:scalar", "answer:scalar"]), _pairs(("user", "question"), ("assistant", "answer"))),
]

# Names other layouts give to the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def schema_paths(schema: T.DataType, prefix: str = "") -> set[str]:
    """Nested field paths of a Spark schema: ``a.b`` in structs, ``a[]`` in arrays, with the kind of the value."""
    if isinstance(schema, T.StructType):
        inner = [schema_paths(field.dataType, f"{prefix}.{field.name}" if prefix else field.name) for field in schema]
        return set().union(*inner)
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, prefix + "[]")
    return {prefix + ":scalar"}


def json_paths(value, prefix: str = "") -> set[str]:
    """The same paths of one parsed JSON value."""
    if isinstance(value, dict):
        return set().union(*[json_paths(x, f"{prefix}.{name}" if prefix else name) for name, x in value.items()])
    if isinstance(value, list):
        return set().union(*[json_paths(x, prefix + "[]") for x in value])
    return {prefix + ":scalar"}


def choose(paths: set[str], layouts: list[Layout] = LAYOUTS) -> Layout | None:
    """The layout selected by the fingerprint of the paths it knows; fields that no layout uses don't matter."""
    mapping = {layout.fingerprint: layout for layout in layouts}
    found = [mapping.get(fingerprint(paths & layout.paths)) for layout in layouts]
    fitting = [layout for layout, own in zip(found, layouts) if layout is own]
    return max(fitting, key=lambda layout: len(layout.paths), default=None)


def canonical(df: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id, turns`` from a table of a known layout.

    Turn rows are gathered by conv_id in the order turn, role, text (nulls first), repeated rows included. In the other
    layouts a row is a conversation; it keeps its ``conv_id`` if it has one, else it gets null. Null texts and roles
    become empty, null lists of turns become empty lists.
    """
    layout = choose(schema_paths(df.schema), layouts)
    if layout is None:
        raise ValueError(f"no layout has the fields of {df.schema.simpleString()}")
    if layout.per_row:
        one = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        rows = df.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
        rows = rows.withColumn("turns", F.sort_array("turns"))
    else:
        own = F.col("conv_id").cast("long") if "conv_id" in df.columns else F.lit(None).cast("long")
        rows = df.select(own.alias("conv_id"), F.expr(layout.turns).alias("turns"))
    return rows.select("conv_id", _cleaned(F.col("turns")).alias("turns"))


def _cleaned(turns: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(
        F.transform(
            turns,
            lambda x: F.struct(
                F.coalesce(names[x["role"]], x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")
            ),
        ),
        F.expr("cast(array() as array<struct<role:string,text:string>>)"),
    )


def canonical_json(df: DataFrame, column: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id, turns, layout`` from rows of JSON text, each in a layout of its own.

    Every record is fingerprinted by its own paths; ``layout`` is null, and ``turns`` empty, for text that isn't JSON or
    of no known layout. Turn rows are no layout of a single record.
    """
    own = [layout for layout in layouts if not layout.per_row]

    @F.udf("string")
    def name_of(text: str | None) -> str | None:
        try:
            layout = choose(json_paths(json.loads(text)), own) if text else None
        except (ValueError, RecursionError):
            return None
        return layout.name if layout else None

    fields = (
        "conv_id long, messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, "
        "instruction string, input string, output string, system string, prompt string, response string, completion string, "
        "question string, answer string"
    )
    rows = df.select(name_of(column).alias("layout"), F.from_json(column, fields).alias("x")).select("layout", "x.*")
    turns = F.lit(None).cast(TURNS)
    for layout in own:
        turns = F.when(F.col("layout") == layout.name, F.expr(layout.turns)).otherwise(turns)
    return rows.select("conv_id", _cleaned(turns).alias("turns"), "layout")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *map(F.lit, ESCAPE))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *map(F.lit, UNESCAPE))


def _role_mark(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_of(mark: Column) -> Column:
    return unescape(F.replace(F.replace(mark, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_turns(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans`` from ``conv_id, turns``.

    A turn is the opening mark, its role, a line break, its escaped text and the closing mark. ``loss_spans`` lists
    start and end (code points of ``formatted``, end excluded) of the trained role's texts, in order.
    """
    marked = F.transform(
        "turns",
        lambda x: F.struct(
            F.concat(F.lit(OPEN), _role_mark(x["role"]), F.lit("\n")).alias("head"),
            escape(x["text"]).alias("body"),
            (x["role"] == trained_role).alias("trained"),
        ),
    )
    rows = conversations.select("conv_id", marked.alias("marked"))
    parts = F.transform("marked", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.when(x["trained"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    spans = F.aggregate("marked", start, step, lambda state: state["spans"])
    return rows.select("conv_id", F.array_join(parts, "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text) parsed back and ``trained``, the unescaped text under each loss span."""
    pieces = F.split("formatted", OPEN.replace("|", r"\|"))
    closed = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    turns = F.transform(
        closed,
        lambda x: F.struct(
            _role_of(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(
                F.substr(x, F.locate("\n", x) + 1, F.length(x) - F.locate("\n", x) - F.lit(len(CLOSE)))
            ).alias("text"),
        ),
    )
    trained = F.transform(
        "loss_spans",
        lambda x: unescape(F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))),
    )
    return formatted.select("*", turns.alias("turns"), trained.alias("trained"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted text: turns, texts under the loss mask, and their sizes."""
    rows = read_turns(formatted)
    listed = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Canonical turns, formatted, written to the shared work folder and read back."""
    return materialise(format_turns(canonical(conversations)), "formatted_chats")
