"""Rule-driven recoding: code → label maps, period rules, membership groups.

All builders return plain ``CASE WHEN`` expressions, so they stay inside
whole-stage codegen and need no join.  The mappings are small literal
dictionaries whose size is known when the plan is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from lakemart.functions.casts import _as_col
from lakemart.functions.sqlexpr import ident, literal


def map_codes(col, mapping: Mapping, default=None) -> Column:
    """Simple CASE: ``CASE col WHEN k THEN v ... [ELSE default] END``, for a code book of any size.

    Codes are compared in the column's own type (a DOUBLE 2.0 meets the code
    ``'2'``, an INT 1 the code ``'01'``).  Unmapped codes give ``default``
    (NULL when omitted); a NULL code also takes ``default``, exactly as a
    simple CASE with ELSE does.  With a column *name* the CASE is sent as one SQL expression.
    """
    if isinstance(col, str) and not isinstance(default, Column) and mapping:
        whens = " ".join(f"WHEN {ident(col)} = {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
        tail = f" ELSE {literal(default)}" if default is not None else ""
        return F.expr(f"CASE {whens}{tail} END")
    c = _as_col(col)
    expr = None
    for code, label in mapping.items():
        cond = c == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def lookup_text(name: str, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """The same result for a column *declared as text* with text codes, as one map
    literal: much less generated code than a long CASE.  A column of another type is
    refused by the analyzer (the map's keys are text), so the answer never depends on a hidden cast."""
    entries = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items())
    probe = f"try_element_at(map({entries}), {ident(name)})"
    return F.expr(f"coalesce({probe}, {literal(default)})" if default is not None else probe)


def lookup_dense(name: str, mapping: Mapping[int, str], default: str | None = None) -> Column:
    """The same result for an integer column and a book of consecutive integer codes, as one array
    literal and an index.  Codes that are not consecutive integers are refused."""
    first, codes = min(mapping), sorted(mapping)
    if any(type(c) is not int for c in codes) or codes != list(range(first, first + len(codes))):
        raise ValueError("codes must be consecutive integers")
    pick = f"get(array({', '.join(literal(mapping[c]) for c in codes)}), try_cast({ident(name)} - {first} AS INT))"
    return F.expr(f"coalesce({pick}, {literal(default)})" if default is not None else pick)


def members(groups: Mapping[str, Iterable]) -> dict:
    """``{member: label}`` of a grouping; the first group that holds a member wins."""
    out: dict = {}
    for label, ms in groups.items():
        for m in ms:
            out.setdefault(m, label)
    return out


def harmonize(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """Searched CASE: first rule whose condition is true wins.

    ``rules`` is a sequence of ``(condition, value)``; values may be literals
    or Columns (e.g. the column that holds the variable in that period).
    A NULL condition counts as not matched.
    """
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if expr is None:
        return F.lit(default)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def by_period(period_col, values: Mapping, default=None) -> Column:
    """Pick a value or column per period: ``CASE WHEN p = k THEN v ... END``."""
    p = _as_col(period_col)
    return harmonize([(p == F.lit(k), v) for k, v in values.items()], default)


def code_to_bool(col, true_code=1, false_code=0) -> Column:
    """``true_code`` → true, ``false_code`` → false, anything else → NULL."""
    return map_codes(col, {true_code: True, false_code: False})


def bucket_by_membership(col, groups: Mapping[str, Iterable], default=None) -> Column:
    """Label a value by the first group whose member list contains it."""
    if isinstance(col, str) and not isinstance(default, Column) and groups:
        whens = " ".join(f"WHEN {ident(col)} IN ({', '.join(literal(m) for m in members)}) THEN {literal(label)}"
                         for label, members in groups.items())
        tail = f" ELSE {literal(default)}" if default is not None else ""
        return F.expr(f"CASE {whens}{tail} END")
    c = _as_col(col)
    return harmonize([(c.isin(list(members)), label) for label, members in groups.items()], default)
