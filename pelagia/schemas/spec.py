"""How a declared table is described: columns, types, keys and cell rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared kind -> Spark type. ``datetime_t`` is the ISO form with a ``T`` between day and
# time, ``datetime_z`` the form ending in ``Z``, ``date_any`` a date in any common notation.
KINDS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "date_any": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "datetime_t": T.TimestampNTZType(),
    "datetime_z": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False
    unique: bool = False
    pattern: str | None = None
    soft_pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None

    @property
    def spark_type(self) -> T.DataType:
        return KINDS[self.kind]


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    missing: tuple[str, ...] = ("",)
    skip: tuple[str, ...] = field(default=("fid",))

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    def only(self, *names: str) -> Table:
        """The same table cut down to some of its fields; the key stays if it is covered."""
        fields = tuple(f for f in self.fields if f.name in names)
        key = self.key if set(self.key) <= set(names) else ()
        return Table(self.name, fields, key, self.missing, self.skip)

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


def table(
    name: str,
    key: str,
    fields: str,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    patterns: Mapping[str, str] | None = None,
    soft_patterns: Mapping[str, str] | None = None,
    missing: tuple[str, ...] = ("",),
) -> Table:
    """Build a :class:`Table` from lines of ``name kind [required] [unique]``."""
    ranges, patterns, soft = ranges or {}, patterns or {}, soft_patterns or {}
    parsed = []
    for line in fields.strip().splitlines():
        column, kind, *flags = line.split()
        low, high = ranges.get(column, (None, None))
        parsed.append(
            Field(
                column,
                kind,
                required="required" in flags,
                unique="unique" in flags,
                pattern=patterns.get(column),
                soft_pattern=soft.get(column),
                minimum=low,
                maximum=high,
            )
        )
    return Table(name, tuple(parsed), tuple(key.split()), missing)
