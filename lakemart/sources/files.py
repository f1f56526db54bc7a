"""File sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from lakemart.functions.sqlexpr import literal


def read_delimited(spark: SparkSession, path, sep: str = ";", encoding: str = "ISO-8859-1",
                   header: bool = True) -> DataFrame:
    """Delimited text, every column a string, no type inference.

    Types are applied afterwards by ``conform``; the encoding is always
    explicit because the default charset corrupts Latin-1 accents.
    """
    return (spark.read.option("header", header).option("sep", sep)
            .option("encoding", encoding).option("inferSchema", False)
            .option("multiLine", False).csv(path))


def read_inferred(spark: SparkSession, path, schema: StructType | str | None = None,
                  sampling_ratio: float | None = None, sep: str = ",") -> DataFrame:
    """Header CSV with inferred column types.

    Inference costs one extra pass over the input; at scale pass a pinned
    ``schema`` (e.g. inferred once on a sample) or a ``sampling_ratio``.
    """
    r = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return r.schema(schema).csv(path)
    r = r.option("inferSchema", True)
    if sampling_ratio is not None:
        r = r.option("samplingRatio", sampling_ratio)
    return r.csv(path)


def period_path(root: str, period, file: str | None = None, key: str = "ano") -> str:
    """``{root}/{key}={period}[/{file}]``."""
    base = f"{root.rstrip('/')}/{key}={period}"
    return f"{base}/{file}" if file else base


def read_period(spark: SparkSession, root: str, period, file: str | None = None,
                key: str = "ano", fmt: str = "delimited", **options) -> DataFrame:
    """Read the input of one period from its year directory."""
    path = period_path(root, period, file, key)
    if fmt == "delimited":
        return read_delimited(spark, path, **options)
    return spark.read.format(fmt).options(**options).load(path)


def write_partitioned(df: DataFrame, path: str, by, mode: str = "overwrite",
                      dynamic: bool = False, max_records_per_file: int | None = None,
                      fmt: str = "parquet") -> None:
    """Columnar dataset partitioned by ``by``.

    ``dynamic=True`` replaces only the partitions present in ``df`` (one-period
    reload); the default static overwrite replaces the whole dataset.  Data
    keeps its input partitioning: hash-clustering by a low-cardinality
    period key would put a whole period into one task, so each task writes
    its share of every period instead (``max_records_per_file`` bounds file size).
    """
    cols = [by] if isinstance(by, str) else list(by)
    w = df.write.mode(mode).partitionBy(*cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.format(fmt).save(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, header: bool = True,
              sep: str = ",", encoding: str | None = None, mode: str = "overwrite") -> None:
    """CSV export with header.

    ``files=None`` writes in parallel (one file per task).  ``files=n``
    reproduces an n-file layout; the upstream work stays parallel (a
    ``repartition``, not a ``coalesce`` that would narrow the whole stage) and
    only the write runs in n tasks — use small n only for small tables.
    """
    out = df.repartition(files) if files else df
    w = out.write.mode(mode).option("header", header).option("sep", sep)
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)


def raw_inventory(spark: SparkSession, root: str, suffix: str = ".csv", period_key: str = "ano",
                  require: bool = True, folder: str | None = None) -> DataFrame:
    """List raw files under ``root`` (recursively) that end in ``suffix``,
    case-insensitively (S10); with ``folder`` only files whose path *inside
    the release* — below ``root`` and its period directory — begins with that folder (case-insensitive).

    Output ``(period, path, name, length)``; ``name`` is the lower-cased base
    name and ``period`` the ``{period_key}=`` directory value (NULL if none).
    Only the listing and file lengths are used — the ``content`` column is
    pruned, so no file body is read.  An empty inventory raises unless ``require`` is off.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length"))
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath().rstrip("/")
    # what follows the root in the file's URI, whatever the scheme part looks like
    inside = F.expr(f"substring(path, locate({literal(base + '/')}, path) + {len(base) + 1})")
    period = F.nullif(F.regexp_extract("inside", rf"^{re.escape(period_key)}=([^/]+)/", 1), F.lit(""))
    release = F.regexp_replace("inside", rf"^{re.escape(period_key)}=[^/]+/", "")
    keep = F.lower("inside").endswith(suffix.lower())
    if folder:
        keep = keep & F.lower("release").startswith(folder.strip("/").lower() + "/")
    inv = (files.withColumn("inside", inside).withColumn("release", release).where(keep)
           .select(period.alias("period"), F.col("path"),
                   F.lower(F.regexp_extract("path", r"([^/]+)$", 1)).alias("name"),
                   F.col("length").cast(LongType()).alias("length")))
    if require and inv.isEmpty():
        raise FileNotFoundError(f"no {suffix} files under {root}")
    return inv


def preview(df: DataFrame, n: int = 20, by=None) -> DataFrame:
    """First ``n`` rows (as a DataFrame, not printed); ``by`` makes it deterministic."""
    if by is not None:
        keys = [by] if isinstance(by, str) else list(by)
        df = df.orderBy(*keys)
    return df.limit(n)
