"""Chat formatting: heterogeneous layouts to canonical turns, turns to one text with a loss mask.

A layout is recognised by its fingerprint, the hash of the nested field paths it is known by. Each known
layout has a declarative mapping to canonical turns (conv_id, turn, role, text). Formatting
writes all turns of a conversation into one text; control strings inside texts are escaped with a
backslash, which is undone exactly when reading back. All of it is column expressions.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateparcel.llm.rows import free_name


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    ``rows``: columns (turn, role, text) of a table with one row per turn. ``items``: the array of
    turns and its (role, text) fields. ``fields``: (role, field) pairs in order of speaking; several
    fields of one role are joined by a blank line, null ones are skipped.
    """

    name: str
    paths: tuple[str, ...]
    rows: tuple[str, str, str] | None = None
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)

    @property
    def needed(self) -> tuple[str, ...]:
        """The paths that a record of this layout cannot do without."""
        return tuple(p for p in self.paths if p not in OPTIONAL)


def fingerprint(paths: tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


#: Fields that records of a layout may leave out.
OPTIONAL = ("input", "context", "system")

#: The layouts in common use, by their field paths.
LAYOUTS = (
    Layout("turn rows", ("turn", "role", "text"), rows=("turn", "role", "text")),
    Layout("messages", ("messages[].role", "messages[].content"),
           items=("messages", "role", "content")),
    Layout("shared conversations", ("conversations[].from", "conversations[].value"),
           items=("conversations", "from", "value")),
    Layout("instruction", ("instruction", "input", "output"),
           fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction and response", ("instruction", "context", "response"),
           fields=(("user", "instruction"), ("user", "context"), ("assistant", "response"))),
    Layout("prompt", ("prompt", "completion"),
           fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt with system", ("system", "prompt", "response"),
           fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question", ("question", "answer"),
           fields=(("user", "question"), ("assistant", "answer"))),
)
#: Role names in use and the canonical ones.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Template:
    """Control strings of the formatted text.

    ``others`` are control strings of common templates, escaped as well so that a text never turns
    into markup in a later template. Every control string begins with ``<`` or ``[``.
    """

    begin: str = "<s>"
    role: str = "[ROLE]"
    text: str = "[INST]"
    end: str = "</s>"
    others: tuple[str, ...] = (
        "[/INST]", "<<SYS>>", "<</SYS>>",
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>",
    )

    def control(self) -> tuple[str, ...]:
        return (self.begin, self.role, self.text, self.end, *self.others)


def paths_of(schema: T.StructType, before: str = "") -> set[str]:
    """Nested field paths of a schema; ``[]`` marks arrays."""
    found: set[str] = set()
    for field in schema.fields:
        kind, path = field.dataType, before + field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        found |= paths_of(kind, path + ".") if isinstance(kind, T.StructType) else {path}
    return found


def layout_of(schema: T.StructType) -> Layout:
    """The layout whose fingerprint the schema has.

    Only paths that some layout names count, so that other columns do not matter. If columns of
    several layouts are there, the first one that is complete is taken. An unknown schema is an
    error that names its paths.
    """
    found = paths_of(schema)
    named = {p for layout in LAYOUTS for p in layout.paths}
    own = fingerprint(tuple(found & named))
    for layout in LAYOUTS:
        if layout.fingerprint == own:
            return layout
    for layout in LAYOUTS:
        if set(layout.paths) <= found:
            return layout
    raise ValueError(f"no layout has the fields {sorted(found)}")


def canonical_role(role: Column) -> Column:
    name = F.coalesce(role.cast("string"), F.lit(""))
    out = name
    for other, canonical in ROLES.items():
        out = F.when(F.lower(name) == other, canonical).otherwise(out)
    return out


def _turns_array(layout: Layout, get, items) -> Column:
    """Array of (role, text) of one record."""
    if layout.items:
        return items(layout)
    spoken: dict[str, list[str]] = {}
    for role, field in layout.fields:
        spoken.setdefault(role, []).append(field)
    parts = []
    for role, names in spoken.items():
        texts = F.array_compact(
            F.array(*[F.when(get(n) != "", get(n)) for n in names])
        )
        text = F.array_join(texts, "\n\n")
        told = F.struct(F.lit(role).alias("role"), text.alias("text"))
        # a turn of the user or assistant is there even if empty; a system turn only if not
        parts.append(F.when(F.size(texts) > 0, told) if role == "system" else told)
    return F.array_compact(F.array(*parts))


def to_turns(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a table of any known layout.

    Null texts and roles are empty. Role names of turn rows stay as they are; in other layouts common
    names become user or assistant. Tables without the key column number nothing: they need one.
    """
    layout = layout_of(records.schema)
    if layout.rows:
        turn, role, text = layout.rows
        return records.select(
            F.col(key).alias("conv_id"),
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        )

    def items(layout: Layout) -> Column:
        name, role, text = layout.items
        return F.transform(
            F.filter(name, lambda x: x.isNotNull()),
            lambda x: F.struct(x[role].cast("string").alias("role"), x[text].cast("string").alias("text")),
        )

    every = _turns_array(layout, lambda n: F.col(n).cast("string"), items)
    return _exploded(records.select(F.col(key).alias("conv_id"), every.alias("turns")))


def _exploded(frame: DataFrame) -> DataFrame:
    rows = frame.select("conv_id", F.posexplode("turns").alias("turn", "one"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long"),
        canonical_role(F.col("one.role")).alias("role"),
        F.coalesce(F.col("one.text"), F.lit("")).alias("text"),
    )


def json_paths(record: Column) -> Column:
    """Sorted paths of a JSON record that some layout names: top-level fields and those of array members."""
    named = sorted({p for layout in LAYOUTS for p in layout.paths})
    arrays = sorted({p.split("[].")[0] for p in named if "[]." in p})
    none = F.array().cast("array<string>")

    def below(name: str) -> Column:
        first = F.json_object_keys(F.get_json_object(record, f"$.{name}[0]"))
        members = F.from_json(F.get_json_object(record, f"$.{name}"), "array<map<string,string>>")
        keys = F.flatten(F.transform(F.filter(members, lambda m: m.isNotNull()), F.map_keys))
        keys = F.array_union(F.coalesce(first, none), F.coalesce(keys, none))
        return F.transform(keys, lambda key: F.concat(F.lit(f"{name}[]."), key))

    tops = F.coalesce(F.json_object_keys(record), none)
    nested = [below(name) for name in arrays]
    found = F.array_intersect(F.concat(tops, *nested), F.array(*[F.lit(p) for p in named]))
    return F.array_sort(found)


def json_fingerprint(record: Column) -> Column:
    """Fingerprint of a JSON record: its ``json_paths``."""
    return F.sha2(F.array_join(json_paths(record), "\n"), 256)


def json_layout(record: Column) -> Column:
    """Name of the layout of a JSON record; null if none fits.

    The layout with its fingerprint; else the first one all of whose needed fields are there.
    """
    layouts = [layout for layout in LAYOUTS if not layout.rows]
    paths, print_ = json_paths(record), json_fingerprint(record)
    exact = F.coalesce(*[F.when(print_ == x.fingerprint, x.name) for x in layouts])
    complete = F.coalesce(
        *[
            F.when(F.size(F.array_except(F.array(*map(F.lit, x.needed)), paths)) == 0, x.name)
            for x in layouts
        ]
    )
    return F.coalesce(exact, complete)


def from_json(records: DataFrame, record: str = "record", key: str = "conv_id") -> DataFrame:
    """Canonical turns of JSON records, each in a layout of its own.

    Returns (conv_id, turn, role, text). Records of several layouts are read by the first complete
    one (``json_layout``). Records of none, and null ones, give no turns; ``unknown_json`` lists them.
    """
    taken = free_name(records, "llm_layout")
    records = records.withColumn(taken, json_layout(F.col(record)))
    one = F.col(record)
    choice = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in LAYOUTS:
        if layout.rows:
            continue

        def items(layout: Layout) -> Column:
            name, role, text = layout.items
            inner = f"array<struct<`{role}`:string,`{text}`:string>>"
            parsed = F.from_json(F.get_json_object(one, f"$.{name}"), inner)
            return F.transform(
                F.filter(parsed, lambda x: x.isNotNull()),
                lambda x: F.struct(x[role].alias("role"), x[text].alias("text")),
            )

        every = _turns_array(layout, lambda n: F.get_json_object(one, f"$.{n}"), items)
        choice = F.when(F.col(taken) == layout.name, every).otherwise(choice)
    return _exploded(records.select(F.col(key).alias("conv_id"), choice.alias("turns")))


def unknown_json(records: DataFrame, record: str = "record") -> DataFrame:
    """The records that no layout fits."""
    return records.where(json_layout(F.col(record)).isNull())


def escape_pattern(template: Template) -> str:
    """The first character of a control string, where the rest follows."""
    rest: dict[str, list[str]] = {}
    for control in template.control():
        rest.setdefault(control[0], []).append(java_literal(control[1:]))
    return "|".join(f"{java_literal(c)}(?={'|'.join(tails)})" for c, tails in rest.items())


def java_literal(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled, and one put after the first character of every control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({escape_pattern(template)})", r"$1\\")


def unescape(text: Column) -> Column:
    """A backslash and the character after it are that character."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    ``loss_mask`` lists (start, length) of every assistant text in the formatted one, in code
    points from 0. Turns are ordered by turn, then role and text, so that repeated turns and ties
    have one order; a null turn comes first. Null conversation ids are one conversation. A
    conversation is one value and is put together in one place.
    """
    t = template
    lead = F.concat(F.lit(t.begin + t.role), escape(F.col("role"), t), F.lit(t.text))
    body = escape(F.col("text"), t)
    written = turns.select("conv_id", "turn", "role", "text", lead.alias("lead"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = F.length("lead") + F.length("body") + F.lit(len(t.end))
    placed = written.select(
        "conv_id",
        "role",
        F.row_number().over(order).alias("number"),
        F.concat("lead", "body", F.lit(t.end)).alias("written"),
        (F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - whole + F.length("lead"))
        .cast("long").alias("start"),
        F.length("body").cast("long").alias("length"),
    )
    parts = F.array_sort(F.collect_list(F.struct("number", "written", "role", "start", "length")))
    return placed.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["written"]), "").alias("formatted"),
        F.transform(
            F.filter("parts", lambda p: p["role"] == "assistant"),
            lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
        ).alias("loss_mask"),
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turns, loss_text, formatted): turns as array of (role, text), texts unescaped.

    ``loss_text`` is cut out by the mask. A control string in the formatted text is markup for
    sure, as those of the texts are escaped.
    """
    t = template
    pieces = F.split("formatted", java_literal(t.end))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    lead = len(t.begin + t.role)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, lead + 1, 2**31 - 1), t.text, 1)).alias("role"),
            unescape(
                F.substring(p, F.locate(t.text, p, lead + 1) + len(t.text), F.lit(2**31 - 1))
            ).alias("text"),
        ),
    )
    loss = F.transform(
        "loss_mask",
        lambda m: unescape(
            F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))
        ),
    )
    return formatted.select(
        "conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"), "formatted"
    )


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation what reading back gives: counts and digests of turns and loss text."""
    back = read_back(formatted, template)
    told = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
