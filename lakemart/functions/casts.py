"""Type conversion that never throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (ByteType, DataType, IntegerType, LongType,
                               ShortType, StringType)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
# A decimal text with everything the non-ANSI cast trims (blanks and control characters): sign, digits, point, digits.
_EDGE = r"[\x00-\x20\x7F]*"
_DECIMAL = rf"^{_EDGE}([+-]?)([0-9]*)[.][0-9]*{_EDGE}$"
_WHOLE = "$1" + "0" + "$2"            # sign, then the whole part behind a zero: ".5" -> "0", "-12.7" -> "-012"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(col, to: DataType, source: DataType | None = StringType()) -> Column:
    """Cast like a non-ANSI engine: bad input becomes NULL instead of an error.

    For integral targets a decimal text such as ``"2.0"``, ``".5"`` or ``"2.9999999"``
    is accepted and truncated toward zero, as the non-ANSI cast does;
    exponents, letters and out-of-range values give NULL; surrounding blanks
    and control characters are ignored.  The fallback (the whole part) is evaluated only for
    values the plain cast rejects.  Pass ``source`` = the input's type to skip
    the fallback when it is not text.
    """
    c = _as_col(col)
    if isinstance(to, _INTEGRAL) and (source is None or isinstance(source, StringType)):
        return F.coalesce(c.try_cast(to), F.regexp_replace(c, _DECIMAL, _WHOLE).try_cast(to))
    if source is not None and source == to:
        return c
    return c.try_cast(to)


def lenient_cast_sql(name: str, to: DataType, source: DataType | None = StringType()) -> str:
    """``lenient_cast`` as Spark SQL text over column ``name`` (same semantics)."""
    from lakemart.functions.sqlexpr import ident, literal
    c, t = ident(name), to.simpleString()
    if isinstance(to, _INTEGRAL) and (source is None or isinstance(source, StringType)):
        return f"coalesce(try_cast({c} AS {t}), try_cast(regexp_replace({c}, {literal(_DECIMAL)}, '{_WHOLE}') AS {t}))"
    if source is not None and source == to:
        return c
    return f"try_cast({c} AS {t})"


def typed_null(to: DataType) -> Column:
    """A NULL literal of the given type."""
    return F.lit(None).cast(to)
