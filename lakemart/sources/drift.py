"""Schema drift of a partitioned Parquet data set, from the footers alone.

A declared schema is never re-inferred, so a period whose files carry another type is noticed only when a query reads that column, and then as a
failed task that names no period.  Here the files are listed (no body is read), tasks open the footers, one row per file and column that differs
comes back, and ``register_table(..., check=True)`` refuses the table before any of its partitions is added.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Footers that one task opens.
FOOTERS = 256
#: Differences named in an error; the table of all is :func:`schema_drift`'s result.
NAMED = 20
_DRIFT = "path string, column string, declared string, found string, problem string"
_SPARK_KEY = b"org.apache.spark.sql.parquet.row.metadata"


class SchemaDrift(ValueError):
    """Files differ from the declared schema; the message names periods, columns and both types."""


def open_uri(uri: str):
    """An input file for pyarrow, by the path as Spark lists it (not percent-encoded): a mounted one, or any scheme that pyarrow's
    file systems know (hdfs, s3, gs, abfs)."""
    from urllib.parse import quote

    from pyarrow import fs
    scheme, path = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", uri, re.S).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem().open_input_file(re.sub("^//[^/]*", "", path))
    where, path = fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', scheme)}:{quote(path, safe='/=:@')}")
    return where.open_input_file(path)


def footer_types(uri: str) -> dict[str, str]:
    """Top-level columns and their types (as ``simpleString``) by the footer of one Parquet file."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type
    with open_uri(uri) as f:
        meta = pq.ParquetFile(f)
        own = (meta.metadata.metadata or {}).get(_SPARK_KEY)
        if own:                                                     # written by Spark: its types as they were
            return {x.name: x.dataType.simpleString() for x in StructType.fromJson(json.loads(own)).fields}
        old_time = {c.path for c in map(meta.schema.column, range(len(meta.schema))) if c.physical_type == "INT96"}
        found = {}
        for x in meta.schema_arrow:
            try:
                found[x.name] = "timestamp" if x.name in old_time else from_arrow_type(x.type).simpleString()
            except Exception:                                       # a type Spark has no name for
                found[x.name] = str(x.type)
        return found


def compare(found: dict[str, str], declared: dict[str, str]) -> list[tuple[str, str | None, str | None, str]]:
    """(column, declared, found, problem) of every difference; names are compared without case, as Spark resolves them."""
    by_name = {n.lower(): t for n, t in found.items()}
    out = [(n, t, by_name.get(n.lower()), "missing" if n.lower() not in by_name else "type")
           for n, t in declared.items() if by_name.get(n.lower()) != t]
    known = {n.lower() for n in declared}
    return out + [(n, None, t, "extra") for n, t in found.items() if n.lower() not in known]


def schema_drift(spark: SparkSession, path: str, schema: StructType, partition_by=()) -> DataFrame:
    """One row per data file below ``path`` and column that differs from ``schema``: the partition columns (as text, null where the folder names none),
    ``path``, ``column``, ``declared``, ``found`` and ``problem`` (``type``, ``missing``, ``extra``, or ``footer`` for a file that cannot be opened as Parquet).

    Partition columns live in folder names and are not looked for in files.  Files and folders whose names begin with ``_`` or ``.``
    are no data.  A folder without data files gives no rows.
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    declared = {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in keys}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for uri in b.column(0).to_pylist():
                try:
                    rows += [(uri, *x) for x in compare(footer_types(uri), declared)]
                except (pa.ArrowInvalid, EOFError) as e:            # no Parquet file; other errors (access) are raised
                    rows.append((uri, None, None, str(e)[:200], "footer"))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["path", "column", "declared", "found", "problem"])

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .where("length > 0").select("path"))                   # the listing only: column `content` is pruned
    drift = files.repartition(max(1, -(-files.count() // FOOTERS)), "path").mapInArrow(read, _DRIFT)
    values = [F.nullif(F.url_decode(F.regexp_extract("path", rf"/{re.escape(k)}=([^/]+)/", 1)), F.lit("")).alias(k) for k in keys]
    return drift.select(*values, *[f"`{c}`" for c in drift.columns])


def require_no_drift(spark: SparkSession, path: str, schema: StructType, partition_by=(), refuse=("type", "footer")) -> None:
    """Raise :class:`SchemaDrift` if a file differs by one of ``refuse`` (a missing column reads as null and an extra one is not read, so
    both are allowed unless named)."""
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    bad = schema_drift(spark, path, schema, keys).where(F.col("problem").isin(list(refuse)))
    groups = [F.col(f"`{c}`") for c in [*keys, "column", "declared", "found", "problem"]]
    rows = bad.groupBy(*groups).agg(F.count(F.lit(1)).alias("files")).orderBy(*groups).limit(NAMED + 1).collect()
    if rows:
        said = [" ".join([*(f"{k}={r[k]}" for k in keys), f"{r['column']}: declared {r['declared']}, found {r['found']} ({r['problem']}, {r['files']} files)"])
                for r in rows[:NAMED]]
        raise SchemaDrift(f"{path}: " + "; ".join(said) + ("; and more" if len(rows) > NAMED else ""))
