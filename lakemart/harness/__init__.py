"""Query registry binding every operator ID to the supplied tables, with
an independently written DuckDB SQL oracle for each (where SQL can say it)."""

from lakemart.harness.registry import ORACLE, QUERIES, load_all

__all__ = ["ORACLE", "QUERIES", "load_all"]
