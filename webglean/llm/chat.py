r"""Chat records of many layouts to one template, and back.

A layout is told by its schema: the nested field paths of a row's non-null columns are hashed, and
the hash picks a declarative mapping that turns prompt, instruction or message fields into turns
``array<struct<role, text>>``. Only DataFrame functions are used.

Template, a turn: ``### role: text</turn>`` and a line break. Inside texts and roles ``\`` is
written ``\\``, ``#`` is ``\h`` and ``<`` is ``\l`` (in roles also ``:`` is ``\c``), so no text can
hold a control string and every text comes back as it was.

A row whose layout is unknown, or without any known column, gets null turns and null results. Null
roles and texts are empty, null list items are left out, an empty list gives an empty text. Other
columns stay; a column with the name of a result column is replaced. A conversation is one value, so
its turns meet in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURNS = "array<struct<role: string, text: string>>"
# Names that other layouts give to the roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
# Code points in which a formatted text is cut to find its spans.
PIECE = 1024


class Layout(NamedTuple):
    """``needs`` are leaf paths such as ``messages[].role``; ``turns`` is the mapping."""

    name: str
    needs: tuple[str, ...]
    turns: Callable[[], Column]


def _turn(role: Column, text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))


def _listed(column: str, role: str, text: str, named: dict[str, str] | None = None) -> Column:
    def name(x: Column) -> Column:
        given = x[role].cast("string")
        for other, known in (named or {}).items():
            given = F.when(x[role] == other, known).otherwise(given)
        return given

    items = F.filter(F.col(column), lambda x: x.isNotNull())
    return F.transform(items, lambda x: _turn(name(x), x[text]))


def _fields(user: tuple[str, ...], assistant: str, system: bool) -> Column:
    asked = F.concat_ws("\n\n", *[F.when(F.col(c) != "", F.col(c)) for c in user])
    turns = F.array(_turn(F.lit("user"), asked), _turn(F.lit("assistant"), F.col(assistant)))
    if not system:
        return turns
    return F.concat(F.array(_turn(F.lit("system"), F.col("system"))), turns)


def _pair(user: str, assistant: str) -> list[Layout]:
    return [
        Layout(f"{user}-{assistant}", (user, assistant), lambda: _fields((user,), assistant, False)),
        Layout(
            f"system-{user}-{assistant}", ("system", user, assistant),
            lambda: _fields((user,), assistant, True),
        ),
    ]


LAYOUTS: list[Layout] = [
    Layout("turns", ("turns[].role", "turns[].text"), lambda: _listed("turns", "role", "text")),
    Layout(
        "messages", ("messages[].content", "messages[].role"),
        lambda: _listed("messages", "role", "content"),
    ),
    Layout(
        "conversations", ("conversations[].from", "conversations[].value"),
        lambda: _listed("conversations", "from", "value", ROLES),
    ),
    *_pair("prompt", "completion"),
    *_pair("prompt", "response"),
    *_pair("question", "answer"),
    *_pair("instruction", "output"),
    Layout(
        "instruction-input-output", ("input", "instruction", "output"),
        lambda: _fields(("instruction", "input"), "output", False),
    ),
    Layout(
        "system-instruction-input-output", ("input", "instruction", "output", "system"),
        lambda: _fields(("instruction", "input"), "output", True),
    ),
]


def field_paths(name: str, kind: DataType) -> list[str]:
    """Leaf paths of a column: ``name``, ``name.field`` and ``name[].field``."""
    if isinstance(kind, ArrayType):
        return field_paths(f"{name}[]", kind.elementType)
    if isinstance(kind, StructType):
        return [path for f in kind.fields for path in field_paths(f"{name}.{f.name}", f.dataType)]
    return [name]


def fingerprint(df: DataFrame, layouts: list[Layout] = LAYOUTS) -> Column:
    """Hash of the known leaf paths of a row's non-null columns; others don't count."""
    known = {path for layout in layouts for path in layout.needs}
    parts = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        paths = sorted(known.intersection(field_paths(field.name, field.dataType)))
        if paths:
            parts.append(F.when(F.col(f"`{field.name}`").isNotNull(), F.lit("\n".join(paths))))
    return F.xxhash64(F.concat_ws("\n", *parts))


def canonical_turns(
    df: DataFrame, layouts: list[Layout] = LAYOUTS, to: str = "turns", layout: str = "layout"
) -> DataFrame:
    """Add the name of each row's layout and its turns."""
    there = {p for f in df.schema.fields for p in field_paths(f.name, f.dataType)}
    usable = [x for x in layouts if set(x.needs) <= there]
    mark = fingerprint(df, layouts)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in usable:
        fits = mark == F.xxhash64(F.lit("\n".join(sorted(x.needs))))
        name = F.when(fits, x.name).otherwise(name)
        turns = F.when(fits, x.turns()).otherwise(turns)
    return df.withColumns({to: turns, layout: name})


def _escape(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescape(text: Column) -> Column:
    # Escapes are pairs, so a run of backslashes is read in pairs from its left.
    def plain(part: Column) -> Column:
        for written, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            part = F.replace(part, F.lit(written), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def _role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit(":"), F.lit("\\c"))


def format_turns(
    df: DataFrame, turns: str = "turns", to: str = "formatted", mask: str = "loss_spans",
    learn: str = "assistant",
) -> DataFrame:
    """Add the text of the template, and the spans (start, length in code points) of the texts of
    the role ``learn``: what a loss is taken over."""
    def written(t: Column) -> Column:
        head = F.concat(F.lit("### "), _role(t["role"]), F.lit(": "))
        return F.struct(head.alias("head"), _escape(t["text"]).alias("body"), (t["role"] == learn).alias("learn"))

    def joined(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda t: F.concat(t["head"], t["body"], F.lit("</turn>\n"))), "")

    empty = F.lit(None).cast("array<struct<start: int, length: int>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array()).alias("spans"))

    def step(done: Column, t: Column) -> Column:
        head, body = F.length(t["head"]), F.length(t["body"])
        span = F.struct((done["at"] + head).alias("start"), body.alias("length"))
        spans = F.when(t["learn"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((done["at"] + head + body + 8).alias("at"), spans.alias("spans"))

    # An array of one: the parts are written once for both columns.
    both = F.transform(F.array(F.transform(turns, written)), lambda parts: F.struct(
        joined(parts).alias("text"), F.aggregate(parts, start, step, lambda done: done["spans"]).alias("spans")
    ))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (to.lower(), mask.lower())]
    return df.select(*kept, F.inline(both).alias(to, mask))


def parse_turns(df: DataFrame, formatted: str = "formatted", to: str = "turns") -> DataFrame:
    """Read the turns back from a formatted text."""
    pieces = F.filter(F.split(formatted, "</turn>\n"), lambda x: x != "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ": ", 1)
        text = F.substring(piece, F.length(head) + 3, F.length(piece))
        role = F.substring(head, F.lit(5), F.length(head))
        return F.struct(_unescape(role).alias("role"), _unescape(text).alias("text"))

    return df.withColumn(to, F.transform(pieces, turn))


def loss_text(formatted: str = "formatted", mask: str = "loss_spans") -> Column:
    """All text under the mask, unescaped, nothing between."""

    # Code points are counted once: a span is cut from the few pieces of ``PIECE`` that it touches.
    def cut(pieces: Column, s: Column) -> Column:
        first = F.floor(s["start"] / PIECE).cast("int")
        last = F.floor((s["start"] + s["length"]) / PIECE).cast("int")
        touched = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return _unescape(F.substring(touched, s["start"] - first * PIECE + 1, s["length"]))

    # An array of one keeps the pieces from being made again for every span.
    whole = F.array(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), 0))
    return F.transform(whole, lambda pieces: F.array_join(F.transform(mask, lambda s: cut(pieces, s)), ""))[0]
