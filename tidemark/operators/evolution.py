"""Schema evolution: comparing, widening, merging and judging schemas."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import types as T


class Mode(str, Enum):
    """What changes a table takes."""

    STRICT = "strict"
    MERGE = "merge"
    OVERWRITE = "overwrite"


class Action(str, Enum):
    """What a batch's schema does to the table's."""

    NONE = "none"
    MERGE = "merge"
    OVERWRITE = "overwrite"


class SchemaIncompatible(ValueError):
    """The table's mode doesn't take the change."""


#: Orders in which a type may widen into one after it.
WIDENING = [[T.ByteType, T.ShortType, T.IntegerType, T.LongType], [T.FloatType, T.DoubleType]]


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether new only widens old: along WIDENING, in an array's elements, or in the fields of a struct with the same names
    in the same order. A type doesn't widen into itself, but may stand unchanged within a struct."""
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return widens(old.elementType, new.elementType)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        same = old.names == new.names
        return same and not _equal(old, new) and all(_equal(a.dataType, b.dataType) or widens(a.dataType, b.dataType) for a, b in zip(old, new, strict=True))
    return any(type(old) in order and type(new) in order and order.index(type(old)) < order.index(type(new)) for order in WIDENING)


def _equal(a: T.DataType, b: T.DataType) -> bool:
    """The same type but for nullability."""
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _equal(a.elementType, b.elementType)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return a.names == b.names and all(_equal(x.dataType, y.dataType) for x, y in zip(a, b, strict=True))
    return a == b


@dataclass
class Comparison:
    """How an incoming schema differs; columns that only widened are in `widened` and count as equal."""

    new: list[T.StructField] = field(default_factory=list)
    missing: list[T.StructField] = field(default_factory=list)
    changed: list[tuple[str, T.DataType, T.DataType]] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)

    @property
    def identical(self) -> bool:
        return not (self.new or self.missing or self.changed)

    @property
    def compatible(self) -> bool:
        return not self.changed and all(f.nullable for f in self.new)

    def message(self) -> str:
        parts = []
        required = [f.name for f in self.new if not f.nullable]
        if required:
            parts.append(f"new required fields: {_names(required)}")
        elif self.new:
            parts.append(f"new fields: {_names([f.name for f in self.new])}")
        if self.missing:
            parts.append(f"missing fields: {_names([f.name for f in self.missing])}")
        if self.changed:
            parts.append("type changes: " + ", ".join(f"{n}: {a.simpleString()} -> {b.simpleString()}" for n, a, b in self.changed))
        return "; ".join(parts)


def _names(names: list[str]) -> str:
    return "[" + ", ".join(f'"{n}"' for n in names) + "]"


def compare(table: T.StructType, incoming: T.StructType, partition_columns: tuple[str, ...] = ()) -> Comparison:
    """By name; partition columns stand in paths, not in files, and are left out."""
    out = Comparison()
    known = {f.name: f for f in table if f.name not in partition_columns}
    given = {f.name: f for f in incoming if f.name not in partition_columns}
    for name, f in given.items():
        if name not in known:
            out.new.append(f)
        elif not _equal(known[name].dataType, f.dataType):
            if widens(known[name].dataType, f.dataType):
                out.widened.append(name)
            else:
                out.changed.append((name, known[name].dataType, f.dataType))
    out.missing = [f for n, f in known.items() if n not in given]
    return out


def merge(table: T.StructType, incoming: T.StructType) -> T.StructType:
    """The table's fields in order, then new ones as nullable. The table's types stay."""
    new = [T.StructField(f.name, f.dataType, True) for f in incoming if f.name not in table.names]
    return T.StructType([*table.fields, *new])


def widest(table: T.StructType, files: list[T.StructType]) -> T.StructType:
    """The table's schema with types as wide as any file's, to read them all."""

    def wide(a: T.DataType, b: T.DataType) -> T.DataType:
        return b if widens(a, b) else a

    out = {f.name: f for f in table}
    for schema in files:
        for f in schema:
            if f.name in out:
                out[f.name] = T.StructField(f.name, wide(out[f.name].dataType, f.dataType), out[f.name].nullable)
    return T.StructType(list(out.values()))


def judge(table: T.StructType | None, incoming: T.StructType, mode: Mode, partition_columns: tuple[str, ...] = ()) -> tuple[Action, T.StructType]:
    """(action, the table's schema afterwards); raises SchemaIncompatible where the mode doesn't take the difference. Without
    a table's schema anything is taken. Overwrite keeps partition columns."""
    if table is None:
        return Action.NONE, incoming
    found = compare(table, incoming, partition_columns)
    if found.identical:
        return Action.NONE, table
    if mode is Mode.STRICT or (mode is Mode.MERGE and not found.compatible):
        raise SchemaIncompatible(found.message())
    if mode is Mode.OVERWRITE:
        kept = [f for f in table if f.name in partition_columns and f.name not in incoming.names]
        return Action.OVERWRITE, T.StructType([*incoming.fields, *kept])
    return (Action.MERGE, merge(table, incoming)) if found.new else (Action.NONE, table)
