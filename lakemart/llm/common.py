"""Shared pieces: reading tables, text conventions and bounded Arrow batches."""

from __future__ import annotations

import contextlib
import contextvars
import os
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

import lakemart
from lakemart import session

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that one Arrow batch may hold, whatever the length of the texts in it.
BATCH_BYTES = 8 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_scope: contextvars.ContextVar[session.Scratch | None] = contextvars.ContextVar("scratch scope", default=None)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Work tables of operators called inside the block go when it ends; write what is to stay within it, with
    :func:`lakemart.session.materialize`."""
    with session.Scratch(spark) as scope:
        token = _scope.set(scope)
        try:
            yield scope
        finally:
            _scope.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """A work table on shared storage; it stays until the scope around the call ends (without one: for a result that is
    still to be read)."""
    return session.materialize(df, name, _scope.get())


def materialize_by(df: DataFrame, name: str, by: str) -> DataFrame:
    """Like :func:`materialize`, with a folder per value of ``by``, whose files tasks can open by themselves (:func:`files_by`)."""
    path = session.scratch_path(df.sparkSession, name, _scope.get())
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_by(table: DataFrame, by: str) -> dict[str, list[str]]:
    """Files of each folder ``by=value`` of a table that :func:`materialize_by` wrote."""
    found: dict[str, list[str]] = {}
    for f in sorted(map(unquote, table.inputFiles())):
        found.setdefault(f.rsplit(f"/{by}=", 1)[1].split("/", 1)[0], []).append(f)
    return found


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would fold every script)."""
    return F.translate(c, _UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; null counts as the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes as well as in rows, so a run
    of very long texts cannot exceed a worker's memory."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    _workers_find_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def _workers_find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did (on a cluster it is
    installed or sent with ``--py-files`` like any other; the extra path does no harm there)."""
    env, root = spark.sparkContext.environment, str(Path(lakemart.__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Inside the block, shuffle files go as soon as the query that wrote them has ended
    (everything kept is written to tables), instead of waiting for the driver's garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def own_names(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns whose names (in any case) an operator needs for its result or its work: the
    operator's columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


__all__ = ["WORD", "BATCH_BYTES", "load", "ascii_lower", "word_count", "utf8_bytes", "text_crc32", "map_arrow",
           "own_names", "scratch_scope", "shuffle_cleanup", "materialize",
           "materialize_by", "files_by"]
