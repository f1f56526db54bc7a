"""Types of a delimited release inferred once and pinned beside it.

``read_inferred`` without a schema parses its input twice, on every read.  Here the types come from one aggregate over the text
columns: every value is put into the narrowest class that holds it, a column's classes meet in one bit mask (``bit_or``:
pre-aggregated in every task, one row leaves it), and the type is the least one above all classes seen.  The result is written
next to the data, and every later read uses it and parses once.

The lattice is Spark's own for CSV: int < bigint < decimal(p, 0) < double; date < timestamp; boolean; string above all, also above
mixtures of those groups; a column without a value is a string.  One difference, on purpose: the order of rows never
matters (Spark takes ``2020`` as a timestamp if a real timestamp came before it in the same split, and as a number otherwise;
here a column of numbers and timestamps is a string).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from lakemart.sources.files import read_delimited

#: Name of the folder, inside the data set's, that holds the pinned schema; readers skip names that begin with ``_``.
PIN = "_pinned_schema"

INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
_NUMBERS, _TIMES = INT | LONG | DECIMAL | DOUBLE, DATE | TIMESTAMP
#: Digits that a declared decimal can have.
_DIGITS = 38


def _whole(c: Column) -> Column:
    return c.rlike(r"^[+-]?[0-9]+$")


def _digits(c: Column) -> Column:
    """Significant digits of a whole number (0 has one)."""
    return F.greatest(F.length(F.regexp_replace(c, r"^[+-]?0*", "")), F.lit(1))


def _class(c: Column) -> Column:
    """The narrowest class of one value, as its bit; 0 for a missing or empty one."""
    number = F.when(_digits(c) > _DIGITS, F.lit(None)).otherwise(c.try_cast("decimal(38,0)"))
    fits = lambda bits: number.between(F.lit(-(2 ** bits)).cast("decimal(38,0)"), F.lit(2 ** bits - 1).cast("decimal(38,0)"))
    real = c.rlike(r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?)[\x00-\x20]*$")
    return (F.when(c.isNull() | (c == ""), 0)
            .when(_whole(c), F.when(fits(31), INT).when(fits(63), LONG).when(number.isNotNull(), DECIMAL).otherwise(DOUBLE))
            .when(real | c.isin("Inf", "-Inf"), DOUBLE)
            .when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(), DATE)
            .when(c.try_cast("timestamp").isNotNull(), TIMESTAMP)
            .when(F.lower(c).isin("true", "false"), BOOLEAN)
            .otherwise(TEXT))


def _type(mask: int, digits: int) -> DataType:
    """The least type above the classes in ``mask``; ``digits`` is the longest whole number's."""
    if mask and not mask & ~_NUMBERS:
        if mask & DOUBLE:
            return DoubleType()
        if mask & DECIMAL:                                          # beside an int or bigint: room for any of those
            return DecimalType(max(digits, 20 if mask & LONG else 10 if mask & INT else 1), 0)
        return LongType() if mask & LONG else IntegerType()
    if mask and not mask & ~_TIMES:
        return TimestampType() if mask & TIMESTAMP else DateType()
    return BooleanType() if mask == BOOLEAN else StringType()


def infer_types(df: DataFrame) -> StructType:
    """Types of the all-text columns of ``df``, from all rows, in one aggregate (two numbers a column reach the driver).

    Null and empty values are of no class; a table without rows or columns without values give strings.
    """
    if not df.columns:
        return StructType([])
    cols = [F.col(f"`{c}`") for c in df.columns]
    masks = [F.bit_or(_class(c)).alias(f"m{i}") for i, c in enumerate(cols)]
    digits = [F.max(F.when(_whole(c), _digits(c))).alias(f"d{i}") for i, c in enumerate(cols)]
    row = df.agg(*masks, *digits).first()
    return StructType([StructField(c, _type(row[f"m{i}"] or 0, row[f"d{i}"] or 1)) for i, c in enumerate(df.columns)])


def _pin_path(path: str) -> str:
    return f"{path.rstrip('/')}/{PIN}"


def pin_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Write ``schema`` beside the data set ``path`` (a folder), in place of an earlier one."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(_pin_path(path))
    return schema


def pinned_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema pinned beside ``path``; None if there is none (or its writing was cut short)."""
    done = spark._jvm.org.apache.hadoop.fs.Path(_pin_path(path) + "/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    import json
    return StructType.fromJson(json.loads(spark.read.option("wholetext", True).text(_pin_path(path)).first()[0]))


def merge_types(a: StructType, b: StructType) -> StructType:
    """The least schema above both, column by column (a release that brings wider values); ``b``'s new columns come last."""
    def mask(t: DataType) -> tuple[int, int]:
        if isinstance(t, DecimalType):
            return DECIMAL, t.precision
        classes = {IntegerType: INT, LongType: LONG, DoubleType: DOUBLE, DateType: DATE, TimestampType: TIMESTAMP, BooleanType: BOOLEAN}
        return classes.get(type(t), TEXT), 1

    def least(types: list[DataType]) -> DataType:
        found = [mask(t) for t in types]
        return _type(reduce(int.__or__, (m for m, _ in found)), max(d for _, d in found))

    names = list(dict.fromkeys([*a.names, *b.names]))
    return StructType([StructField(n, least([s[n].dataType for s in (a, b) if n in s.names])) for n in names])


def read_pinned(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", refresh: bool = False,
                mode: str = "FAILFAST") -> DataFrame:
    """Header CSV in folder ``path`` with the types pinned beside it; the first read (or ``refresh``) infers and pins them.

    A value outside its pinned type fails the read (``mode="PERMISSIVE"``: null), and so does a file whose header names other columns:
    a release that has drifted never passes as nulls.
    """
    schema = None if refresh else pinned_schema(spark, path)
    if schema is None:
        schema = pin_schema(spark, path, infer_types(read_delimited(spark, path, sep=sep, encoding=encoding)))
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
            .option("enforceSchema", False).option("mode", mode).csv(path))
