"""Schema conformance and projections.

Each operator issues a single ``select``/``toDF`` so the analyzed plan stays
one Project deep no matter how wide the table is.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lakemart.functions.casts import lenient_cast_sql
from lakemart.functions.sqlexpr import ident


class SchemaError(ValueError):
    """Raised when column names collide or an unexpected overlap appears."""


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name in one projection; raise on collisions."""
    lowered = [c.lower() for c in df.columns]
    seen: dict[str, str] = {}
    for orig, low in zip(df.columns, lowered):
        if low in seen:
            raise SchemaError(f"columns {seen[low]!r} and {orig!r} collide as {low!r}")
        seen[low] = orig
    return df.toDF(*lowered)


def conform(df: DataFrame, schema: StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Exactly the fields of ``schema``, in order, with their types.

    Present columns are cast leniently (dirty text → NULL, never an error),
    missing ones become typed NULLs, columns outside the schema are dropped
    (except names listed in ``keep``, appended at the end).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name in types:
            e = lenient_cast_sql(f.name, f.dataType, source=types[f.name])
        else:
            e = f"CAST(NULL AS {f.dataType.simpleString()})"
        out.append(f"{e} AS {ident(f.name)}")
    out += [ident(k) for k in keep if k in types and k not in schema.fieldNames()]
    return df.selectExpr(*out)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Add a literal column (e.g. the period key)."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def overlap(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``right`` that ``left`` also has, in ``right``'s order."""
    lcols = set(left.columns)
    return [c for c in right.columns if c in lcols]


def drop_overlap(left: DataFrame, right: DataFrame,
                 expected: Iterable[str] | None = None,
                 keep: Iterable[str] = ()) -> DataFrame:
    """Drop from ``right`` the columns ``left`` already has (except ``keep``).

    With ``expected`` given, an overlap outside that list raises instead of
    being silently dropped.
    """
    ov = [c for c in overlap(left, right) if c not in set(keep)]
    if expected is not None:
        unexpected = sorted(set(ov) - set(expected))
        if unexpected:
            raise SchemaError(f"unexpected overlapping columns: {unexpected}")
    return right.drop(*ov)


def pick(df: DataFrame, cols: Iterable) -> DataFrame:
    """Column selection (names or Columns)."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in one projection; unknown names raise."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise SchemaError(f"cannot rename missing columns {missing}")
    return df.select([F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def extend(df: DataFrame, **exprs: Column) -> DataFrame:
    """``SELECT *, expr AS name, ...`` in a single projection."""
    return df.select("*", *[e.alias(k) for k, e in exprs.items()])
