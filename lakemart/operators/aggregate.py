"""Grouped reports, ratio columns and observed counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakemart.functions.numeric import safe_ratio


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_report(df: DataFrame, by: Sequence, measures: Mapping[str, Column],
                   labels: Mapping[str, Column] | None = None,
                   order: Sequence | None = None) -> DataFrame:
    """GROUP BY ``by`` with aliased ``measures``.

    * ``by`` — names or aliased Columns.  Grouping on an expression (e.g. a
      code→band mapping) merges the codes that share a band (A09).
    * ``labels`` — optional output columns computed *after* aggregation from
      the group keys; when given, they replace the raw keys in the output.
      Grouping stays on the raw code, so two unknown codes stay two
      NULL-labelled rows (A08).
    * ``order`` — optional sort, evaluated before the final projection so it
      may use keys that are not projected (O03).
    """
    keys = [_col(k) for k in by]
    agg = df.groupBy(*keys).agg(*[m.alias(a) for a, m in measures.items()])
    if order:
        agg = agg.orderBy(*[_col(o) for o in order])
    if labels is not None:
        agg = agg.select(*[e.alias(a) for a, e in labels.items()], *measures.keys())
    return agg


def ratios(df: DataFrame, parts: Mapping[str, str], total: str) -> DataFrame:
    """Keep every column and add ``alias = part / total`` (NULL when total is 0)."""
    return df.select("*", *[safe_ratio(p, total).alias(a) for a, p in parts.items()])


def observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in during the next action on the result.

    Counting this way costs no extra scan; read it with ``obs.get["rows"]``
    after the write/collect.
    """
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for several inputs in one job (A10)."""
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
