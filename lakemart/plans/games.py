"""The games notebook flows (M10–M12): inferred CSV tables, a top-k list, ratio
columns and a standardised CSV export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lakemart.operators.aggregate import ratios
from lakemart.operators.ordering import top_k
from lakemart.sources.files import read_inferred, write_csv


def load_tables(spark, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Read each named CSV with header and inferred types."""
    return {name: read_inferred(spark, p) for name, p in paths.items()}


def top_list(df: DataFrame, by: str, label: str, k: int = 20, tie_break=()) -> DataFrame:
    """Highest ``k`` rows by ``by`` projected to ``(label, by)``."""
    return top_k(df, by, k, tie_break=list(tie_break) or [label], cols=[label, by])


def entry_ratios(df: DataFrame, parts: Mapping[str, str], total: str) -> DataFrame:
    """Every column plus ``part / total`` per part."""
    return ratios(df, parts, total)


def export_csv(tables: Mapping[str, DataFrame], root: str, files: int | None = None) -> dict[str, str]:
    """Write each table as header CSV under ``root/<name>`` (M12); returns paths."""
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        write_csv(df, path, files=files)
        out[name] = path
    return out
