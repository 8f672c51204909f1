"""Chat formatting: layouts by schema fingerprint, turns, template and loss mask.

A record's nested field paths are hashed; the hash selects a declarative
mapping that turns the record into canonical turns.  Turns are marked by control
strings, and control strings inside texts are escaped so that the formatted
text can be read back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.llm.common import bound_batches

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Layout:
    """How one layout of records maps to turns.

    `turns`: path of a list of turns with its role and text fields, or of flat
    rows if empty.  `parts`: roles with the fields that make up their text.
    """

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    order: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: frozenset[str] = frozenset()
    names: dict[str, str] = field(default_factory=dict, hash=False)

    def required(self) -> frozenset[str]:
        if self.turns is None:
            return frozenset(p for _, paths in self.parts for p in paths) - self.optional
        inside = f"{self.turns}[]." if self.turns else ""
        return frozenset(inside + p for p in (self.role, self.text, self.order) if p)


#: Records of one row for each turn come with a conversation and a position.
LAYOUTS = (
    Layout("rows", turns="", role="role", text="text", order="turn"),
    Layout("messages", turns="messages", role="role", text="content"),
    Layout(
        "from_value",
        turns="conversations",
        role="from",
        text="value",
        names={"human": "user", "gpt": "assistant"},
    ),
    Layout(
        "instruction",
        parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        optional=frozenset({"system", "input"}),
    ),
    Layout(
        "prompt",
        parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))),
        optional=frozenset({"system"}),
    ),
    Layout("question", parts=(("user", ("question",)), ("assistant", ("answer",)))),
)


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def _registered() -> dict[str, Layout]:
    found = {}
    for layout in LAYOUTS:
        optional = sorted(layout.optional)
        for n in range(len(optional) + 1):
            for more in combinations(optional, n):
                found[fingerprint([*layout.required(), *more])] = layout
    return found


BY_FINGERPRINT = _registered()


def select_layout(paths: set[str]) -> Layout | None:
    """The layout with the fingerprint of `paths`; if other fields come with
    it, the first layout whose fields are all there.
    """
    exact = BY_FINGERPRINT.get(fingerprint(paths))
    return exact or next((x for x in LAYOUTS if x.required() <= paths), None)


def paths_of(value: object, at: str = "") -> Iterator[str]:
    """Nested field paths of a decoded JSON record; a list adds `[]`."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from paths_of(inner, f"{at}.{name}" if at else str(name))
    elif isinstance(value, list):
        for inner in value:
            yield from paths_of(inner, f"{at}[]")
    elif at:
        yield at


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """Nested field paths of a schema, in the same notation."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def turns_in(record: dict) -> tuple[str | None, list[tuple[str, str]]]:
    """Layout and (role, text) turns of a decoded record; (None, []) if no
    mapping has its fields.
    """
    layout = select_layout(set(paths_of(record)))
    if layout is None or layout.turns == "":
        return (layout.name, [(plain(record["role"]), plain(record["text"]))]) if layout else (None, [])
    if layout.turns is not None:
        return layout.name, [
            (layout.names.get(plain(x.get(layout.role)), plain(x.get(layout.role))), plain(x.get(layout.text)))
            for x in record[layout.turns]
            if isinstance(x, dict)
        ]
    turns = []
    for role, fields in layout.parts:
        texts = [plain(record.get(f)) for f in fields]
        if any(f in record for f in fields) and not (role == "system" and not any(texts)):
            turns.append((role, "\n".join(t for t in texts if t)))
    return layout.name, turns


def turns_of_json(records: DataFrame, column: str = "record", key: str = "conv_id") -> DataFrame:
    """Canonical turns of JSON records of any mix of layouts.

    A record that is null, no JSON object, or of an unknown layout gives one row
    with null layout, turn, role and text, so that none is lost unseen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    record = json.loads(text or "")
                except ValueError:
                    record = None
                name, turns = turns_in(record) if isinstance(record, dict) else (None, [])
                out += [(conv, name, i, role, said) for i, (role, said) in enumerate(turns)] or [
                    (conv, name, None, None, None)
                ]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["conv_id", "layout", "turn", "role", "text"],
            )

    bound_batches(records.sparkSession)
    return records.select(F.col(key).cast("long"), F.col(column).cast("string")).mapInArrow(
        run, "conv_id long, layout string, turn long, role string, text string"
    )


def turns_of(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """Canonical turns of a table, by the fingerprint of its schema.

    Further columns are left aside.  A table without a known layout is an error.
    """
    layout = select_layout(set(schema_paths(records.schema)) - {key})
    if layout is None:
        raise ValueError(f"no mapping for the fields {sorted(schema_paths(records.schema))}")
    role_of = lambda c: _renamed(c.cast("string"), layout.names)
    if layout.turns == "":
        return records.select(
            F.col(key).cast("long").alias("conv_id"),
            F.col(layout.order).cast("long").alias("turn"),
            role_of(F.col(layout.role)).alias("role"),
            F.coalesce(F.col(layout.text).cast("string"), F.lit("")).alias("text"),
        )
    if layout.turns:
        listed = F.col(layout.turns)
    else:
        listed = F.filter(
            F.array(*[_part(records, role, fields) for role, fields in layout.parts]),
            lambda x: x.isNotNull(),
        )
    role, text = (layout.role, layout.text) if layout.turns else ("role", "text")
    return records.select(F.col(key).cast("long").alias("conv_id"), F.posexplode(listed).alias("turn", "_t")).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role_of(F.col(f"_t.{role}")).alias("role"),
        F.coalesce(F.col(f"_t.{text}").cast("string"), F.lit("")).alias("text"),
    )


def _renamed(role: Column, names: dict[str, str]) -> Column:
    role = F.coalesce(role, F.lit(""))
    for old, new in names.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def _part(records: DataFrame, role: str, fields: tuple[str, ...]) -> Column:
    there = [F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields if f in records.columns]
    text = F.concat_ws("\n", *there) if there else F.lit("")
    made = F.struct(F.lit(role).alias("role"), text.alias("text"))
    return F.when(text != "", made) if role == "system" else made


def escaped(text: Column) -> Column:
    r"""`<|` becomes `<\|`, and each run of backslashes in between grows by one."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """Each turn's piece of the formatted conversation, and its loss span.

    A conversation's formatted text is its pieces in the order of turn, role
    and text.  `loss_start` and `loss_end` count code points in the piece; the
    span holds the assistant's text and nothing else.  A null role is an empty
    one.
    """
    header = F.regexp_replace(F.coalesce("role", F.lit("")), r"\\", r"\\\\")
    header = F.concat(F.lit(START), escaped(F.regexp_replace(header, "\n", r"\\n")), F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    speaks = F.col("role") == "assistant"
    return turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(header, body, F.lit(END + "\n")).alias("piece"),
        F.when(speaks, F.length(header)).alias("loss_start"),
        F.when(speaks, F.length(header) + F.length(body)).alias("loss_end"),
    )


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, rest = piece.removeprefix(START).split("\n", 1)
    text = rest[: rest.index(END)]
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
    return role, unescape(text)


class Digest:
    """Running digests of one conversation as it is read back."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.all, self.under = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        role, text = read_piece(piece)
        self.turns += 1
        self.chars += len(piece)
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            said = unescape(piece[start:end])
            self.loss += len(said)
            self.under.update(said.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.under.hexdigest(), self.chars


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted pieces.

    A digest of a whole conversation has to see its turns one after another, so
    they meet in one task.  They stream through it in sorted order and none is
    held, however long the conversation is.  Turns without a conv_id make up one
    conversation; repeated turns are all part of theirs.
    """
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Digest | None = None
        for batch in batches:
            done = []
            for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = Digest(conv)
                now.add(piece, start, end)
            if done:
                yield out(done)
        if now is not None:
            yield out([now.row()])

    bound_batches(formatted.sparkSession)
    placed = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(run, DIGESTS)
