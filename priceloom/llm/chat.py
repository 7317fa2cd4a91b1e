"""Chat formatting of records and tables in many layouts.

The nested field paths of a record, or of a table's schema, are hashed. A declared layout is selected if the
hashes of all paths it needs are among them; it says where roles and texts are. The turns are then written
with one template. Control strings inside texts are escaped so that the template's own marks stay
unambiguous and everything can be read back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

# The template's marks.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Names of one role in different layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Turns are the elements of ``list`` (path, role and text fields), one per entry of ``fields``, or the rows of a table.

    ``row`` names a table's columns of conversation, turn, role and text.
    """

    name: str
    list: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    row: tuple[str, str, str, str] | None = None

    @property
    def paths(self) -> tuple[str, ...]:
        """The field paths it needs, as `paths_of` and `field_paths` write them."""
        if self.list:
            path, role, text = map(_escaped, self.list)
            return f"{path}[]", f"{path}[].{role}", f"{path}[].{text}"
        return tuple(map(_escaped, self.row or [path for _, path in self.fields]))

    @property
    def nested(self) -> tuple[str, ...]:
        """Paths it must not find: a role or text that is no scalar in some turn."""
        return tuple(path + kind for path in self.paths if not path.endswith("[]") for kind in ("{}", "[]", "[0]", "[*]"))

    @property
    def empty(self) -> tuple[str, ...]:
        """The path of its list without turns."""
        return (f"{_escaped(self.list[0])}[0]",) if self.list else ()


def _escaped(name: str) -> str:
    return re.sub(r"([\\.\[\]{}])", r"\\\1", name)


def _hashed(paths: tuple[str, ...]) -> list[int]:
    found = (xxhash.xxh64_intdigest(path, 42) for path in paths)
    return [value - (1 << 64) if value >> 63 else value for value in found]


LAYOUTS = [
    Layout("messages", list=("messages", "role", "content")),
    Layout("conversations", list=("conversations", "from", "value")),
    Layout("turns", list=("turns", "role", "text")),
    Layout("prompt-response", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt-completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question-answer", fields=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction-output", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction-input-output", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("system-prompt-response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
]
#: Tables with one row per turn.
ROWS = "rows"
ROW_LAYOUTS = [Layout(ROWS, row=("conv_id", "turn", "role", "text"))]

_TURNS = "array<struct<role:string,text:string>>"


def paths_of(schema: T.StructType) -> list[str]:
    """Field paths of a schema: ``a`` a scalar, ``a{}`` an object, ``a[]`` an array of objects, ``a[*]`` another array."""

    def fields(kind: T.StructType, before: str) -> list[str]:
        found = []
        for field in kind:
            path, inner = before + _escaped(field.name), field.dataType
            if isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType):
                found += [path + "[]", *fields(inner.elementType, path + "[].")]
            else:
                found.append(path + ("{}" if isinstance(inner, T.StructType) else "[*]" if isinstance(inner, T.ArrayType) else ""))
        return found

    return fields(schema, "")


def _entries(value: Column) -> Column:
    """(path, value) of each field of an object; null for anything else."""
    name = lambda e: F.regexp_replace(e["key"], r"([\\.\[\]{}])", r"\\$1")
    fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    return F.transform(fields, lambda e: F.struct(name(e).alias("path"), e["value"].alias("value")))


def _kind(value: Column) -> Column:
    found = F.schema_of_variant(value)
    return F.when(found.startswith("OBJECT<"), F.lit("{}")).when(found.startswith("ARRAY<"), F.lit("[*]")).otherwise(F.lit(""))


def field_paths(record: Column) -> Column:
    """Field paths of each JSON record, as `paths_of` writes them, and ``a[0]`` for an empty array.

    Scalar types don't matter. Null elements of an array of objects are passed over. Null if it is no object.
    """

    def of(entry: Column) -> Column:
        path = entry["path"]
        parts = F.try_variant_get(entry["value"], "$", "array<variant>")
        there = F.filter(parts, lambda p: ~F.is_variant_null(p))
        objects = (F.size(there) > 0) & F.forall(there, lambda p: _kind(p) == "{}")
        inner = F.flatten(F.transform(there, lambda p: F.transform(_entries(p), lambda e: F.concat(path, F.lit("[]."), e["path"], _kind(e["value"])))))
        return (
            F.when(_kind(entry["value"]) != "[*]", F.array(F.concat(path, _kind(entry["value"]))))
            .when(F.size(parts) == 0, F.array(F.concat(path, F.lit("[0]"))))
            .when(objects, F.concat(F.array(F.concat(path, F.lit("[]"))), inner))
            .otherwise(F.array(F.concat(path, F.lit("[*]"))))
        )

    return F.array_distinct(F.flatten(F.transform(_entries(record), of)))


def _canonical(layout: Layout, record: Column) -> Column:
    if layout.list:
        path, role, text = layout.list
        items = F.variant_get(record, f"$.{path}", f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(items, lambda t: F.struct(t[role].alias("role"), t[text].alias("text")))
    turns = [F.struct(F.lit(role).alias("role"), F.variant_get(record, f"$.{path}", "string").alias("text")) for role, path in layout.fields]
    # An optional field that is empty makes no turn; what is said by the assistant always does.
    return F.filter(F.array(*turns), lambda t: (t["role"] == ASSISTANT) | (F.coalesce(t["text"], F.lit("")) != ""))


def turns_of_records(rows: DataFrame, id: str = "conv_id", record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, layout) from JSON records, one per conversation.

    Of the layouts whose paths are all there, the one that needs most is taken, among equals the first; a list
    without turns counts last. Other paths don't matter. A conversation without turns gives one row with a
    layout, and null turn, role and text. A record of no declared layout, or that is no JSON, gives one row
    with null layout too: `rejected` has them; nothing is guessed.
    """
    parsed = rows.select(F.col(id).alias("conv_id"), F.try_parse_json(F.col(record).cast("string")).alias("_record"))
    keyed = parsed.withColumn("_keys", F.transform(field_paths(F.col("_record")), lambda p: F.xxhash64(p)))
    held = lambda keys: F.size(F.array_except(F.array(*map(F.lit, keys)), F.col("_keys"))) == 0
    whole = sorted(layouts, key=lambda x: -len(x.paths))
    choices = [(x, held(_hashed(x.paths)) & ~F.arrays_overlap(F.col("_keys"), F.array(*map(F.lit, _hashed(x.nested))))) for x in whole]
    choices += [(x, held(_hashed(x.empty))) for x in layouts if x.empty]
    turns, name = F.lit(None).cast(_TURNS), F.lit(None).cast("string")
    for layout, fits in reversed(choices):
        turns = F.when(F.col("_layout") == layout.name, _canonical(layout, F.col("_record")).cast(_TURNS)).otherwise(turns)
        name = F.when(fits, F.lit(layout.name)).otherwise(name)
    found = keyed.withColumn("_layout", name)
    found = found.select("conv_id", F.col("_layout").alias("layout"), F.posexplode_outer(turns).alias("turn", "_turn"))
    return found.select("conv_id", F.col("turn").cast("long").alias("turn"), _role(F.col("_turn.role")).alias("role"), "_turn.text", "layout")


def rejected(turns: DataFrame) -> DataFrame:
    """(conv_id) of each record for which no layout is declared."""
    return turns.where(F.col("layout").isNull()).select("conv_id")


def _role(role: Column) -> Column:
    for other, plain in ROLES.items():
        role = F.when(role == other, F.lit(plain)).otherwise(role)
    return role


def turns_of_rows(rows: DataFrame, layouts=ROW_LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, layout) from a table with a row per turn; its hashed field paths select the layout."""
    keys = set(_hashed(tuple(paths_of(rows.schema))))
    for layout in sorted(layouts, key=lambda x: -len(x.paths)):
        if keys.issuperset(_hashed(layout.paths)):
            id, turn, role, text = (F.col(f"`{name}`") for name in layout.row)
            return rows.select(
                id.alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.lit(layout.name).alias("layout")
            )
    raise ValueError(f"no layout is declared for a table with the fields {', '.join(paths_of(rows.schema))}")


# --- the template ------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    """``<|`` becomes ``<\\|`` and each ``<\\|`` gets one backslash more: no mark can be left in a text."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role is one line: line feeds and backslashes are spelt out."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans): one text per conversation, turns in order.

    ``spans`` has the place of each turn's text (code points, end exclusive) and whether it counts for
    the loss: the assistant's do. Null roles and texts count as empty. Equal turn numbers are ordered by
    role, then text; repeated rows are turns of their own; a null conv_id is a conversation. A
    conversation is one value and so is made in one task; nothing else is held there. A conversation
    without turns is an empty text; what `rejected` has is left out. Without a column ``layout`` all rows are turns.
    """
    said = F.lit(True)
    if "layout" in turns.columns:
        turns = turns.where(F.col("layout").isNotNull())
        said = F.col("turn").isNotNull() | F.col("layout").isin([x.name for x in ROW_LAYOUTS])
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _escape_role(role), F.lit("\n"))
    rows = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.length(head).alias("_head"), F.when(said, F.concat(head, escape(text), F.lit(END + "\n"))).alias("_piece"),
    ).withColumn("_length", F.length("_piece").cast("long"))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum("_length").over(before), F.lit(0)))
    part = F.struct(
        F.col("_at"), F.col("_piece"), (F.col("_at") + F.col("_head")).alias("start"),
        (F.col("_at") + F.col("_length") - len(END) - 1).alias("end"), (F.col("role") == ASSISTANT).alias("loss"),
    )
    part = F.when(F.col("_piece").isNotNull(), part)
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("_parts", lambda p: p["_piece"]), "").alias("formatted"),
        F.transform("_parts", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["loss"].alias("loss"))).alias("spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text): the turns of ``formatted`` text, and all text under its loss mask."""
    body = F.split("formatted", r"<\|im_start\|>", -1)
    segments = F.slice(body, 2, F.size(body) - 1)
    # A segment starts after the mark that follows the end of the text before it.
    ends = F.concat(F.array(F.lit(-len(END) - 1).cast("long")), F.transform("spans", lambda s: s["end"]))
    starts = F.transform(ends, lambda e: e + len(END) + 1 + len(START))
    placed = F.arrays_zip(segments.alias("segment"), F.col("spans").alias("span"), F.slice(starts, 1, F.size("spans")).alias("at"))

    def turn(p: Column) -> Column:
        said = F.substring(p["segment"], (p["span"]["start"] - p["at"] + 1).cast("int"), (p["span"]["end"] - p["span"]["start"]).cast("int"))
        role = F.substring_index(p["segment"], "\n", 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(said).alias("text"), p["span"]["loss"].alias("loss"))

    turns = F.transform(placed, turn)
    found = formatted.select("conv_id", "formatted", turns.alias("turns"))
    under = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return found.select("conv_id", "formatted", "turns", under.alias("loss_text"))
