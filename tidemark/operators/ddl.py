"""Declared tables against live ones: differences, and a plan of what can be patched."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Spellings of types that mean the same, and which types can partition a table.
ALIASES = {"integer": "bigint", "int64": "bigint", "long": "bigint", "float": "double", "float64": "double", "bool": "boolean", "record": "struct", "bytes": "binary", "datetime": "timestamp"}
PARTITIONS = ("date", "timestamp", "timestamp_ntz")
CLUSTERED = 4
OK, DRIFT, REBUILD, BAD = 0, 1, 2, 3


class Undeclarable(ValueError):
    """A declaration that no table can have."""


def canonical(name: str) -> str:
    return ALIASES.get(name.lower(), name.lower())


def identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,127}", name):
        raise Undeclarable(f"{name!r} is not an identifier")
    return name


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    partition: str | None = None
    clustering: tuple[str, ...] = ()
    description: str = ""
    required: frozenset[str] = field(default_factory=frozenset)

    def __post_init__(self):
        identifier(self.name)
        if len(self.clustering) > CLUSTERED or set(self.clustering) - set(self.schema.names):
            raise Undeclarable(f"{self.name}: clustering {self.clustering}")
        if self.partition and (self.partition not in self.schema.names or self.schema[self.partition].dataType.simpleString() not in PARTITIONS):
            raise Undeclarable(f"{self.name}: partition {self.partition}")


def _shape(t: T.DataType) -> tuple[str, T.StructType | None]:
    """Kind of a type, and its fields if it nests: an array of structs nests like a struct."""
    inner, mode = (t.elementType, "array ") if isinstance(t, T.ArrayType) else (t, "")
    return (mode + "struct", inner) if isinstance(inner, T.StructType) else (mode + canonical(inner.simpleString()), None)


def field_differences(want: T.StructType, have: T.StructType, at: str = "") -> list[tuple[str, str, bool]]:
    """(path, what, can be patched) for each field that isn't as declared."""
    out, names = [], {f.name: f for f in have.fields}
    for f in want.fields:
        path = f"{at}{f.name}"
        live = names.get(f.name)
        if live is None:
            out.append((path, "missing column", f.nullable or isinstance(f.dataType, T.ArrayType)))
            continue
        (kind, nested), (live_kind, live_nested) = _shape(f.dataType), _shape(live.dataType)
        if kind != live_kind:
            out.append((path, f"type {live_kind}, not {kind}", False))
        elif nested is not None:
            out += field_differences(nested, live_nested, f"{path}.")
        if f.nullable != live.nullable:
            out.append((path, "nullable" if live.nullable else "required", f.nullable))
    out += [(f"{at}{n}", "unexpected column", False) for n in have.names if n not in want.names]
    shared = [n for n in have.names if n in want.names]
    if shared != [n for n in want.names if n in names]:
        out.append((at.rstrip(".") or "*", "order of columns", False))
    return out


def differences(want: list[Table], have: dict[str, Table]) -> list[tuple[str, str, str, bool]]:
    """(table, path, what, can be patched) over all tables, declared or not."""
    out = []
    for t in want:
        live = have.get(t.name)
        if live is None:
            out.append((t.name, "*", "missing table", True))
            continue
        out += [(t.name, *d) for d in field_differences(t.schema, live.schema)]
        if t.partition != live.partition:
            out.append((t.name, "*", f"partition {live.partition}, not {t.partition}", False))
        if t.clustering != live.clustering:
            out.append((t.name, "*", "clustering", True))
        if t.description != live.description:
            out.append((t.name, "*", "description", True))
    return out + [(n, "*", "undeclared table", False) for n in have if n not in {t.name for t in want}]


def patch_plan(want: list[Table], have: dict[str, Table]) -> tuple[list[str], list[str]]:
    """(statements that bring the live tables up to date, what needs a rebuild instead)."""
    statements, rebuild, tables = [], [], {t.name: t for t in want}
    for name, path, what, patch in differences(want, have):
        if what == "missing table":
            t = tables[name]
            part = f" PARTITIONED BY ({t.partition})" if t.partition else ""
            statements.append(f"CREATE TABLE {name} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in t.schema)}) USING parquet{part}")
        elif what == "missing column" and patch and "." not in path:
            statements.append(f"ALTER TABLE {name} ADD COLUMNS ({path} {tables[name].schema[path].dataType.simpleString()})")
        elif what == "description":
            statements.append("COMMENT ON TABLE {} IS '{}'".format(name, tables[name].description.replace("'", "\\'")))
        elif what == "clustering" or (patch and what == "required"):
            continue  # Parquet files have neither; later writes follow the declaration
        elif what != "undeclared table":
            rebuild.append(f"{name}.{path}: {what}")
    return statements, rebuild


def apply(spark: SparkSession, want: list[Table], have: dict[str, Table]) -> int:
    statements, rebuild = patch_plan(want, have)
    if rebuild:
        return REBUILD
    for s in statements:
        spark.sql(s)
    return OK


def verify(want: list[Table], have: dict[str, Table]) -> int:
    found = differences(want, have)
    return OK if not found else DRIFT if all(patch for *_, patch in found) else REBUILD


def view(template: str, dataset: str) -> str:
    """The text of a view, with its dataset filled in."""
    return template.replace("{dataset}", identifier(dataset))
