"""Small helpers to emit Spark SQL expression text.

Wide projections (a 79-column conform, a 17-entry code book) are sent to
the JVM as one ``selectExpr`` / ``expr`` string instead of hundreds of
Column-builder calls; the optimizer sees exactly the same expressions.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """Back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(v) -> str:
    """SQL literal for str / bool / int / float / None."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"unsupported literal {v!r}")
