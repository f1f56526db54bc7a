"""Write, audit, publish: a partitioned dataset changes only after its new data passed its checks.

1. **Write.**  The new partitions go to ``<root>/_staged-<version>/`` (hidden from readers of ``root``, on the same storage).
2. **Audit.**  The caller judges what was written, not what was meant to be written.  If it raises, the staged folder goes and
   ``root`` is as it was.
3. **Publish.**  A log ``<root>/_publish-<version>`` names the partitions; each live folder moves to ``<root>/_retired-<version>/`` and its
   successor into its place (renames only).  The log goes last.  A driver lost in between leaves the log: the next
   :func:`recover` (every :func:`stage` begins with it) carries the remaining moves out, so a dataset is never left half old and half
   new.  Staged folders without a log never passed their audit and are dropped.

One writer per dataset at a time; a reader that has listed the old files when they move must list them again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakemart.sources.files import write_partitioned


@dataclass(frozen=True)
class Staged:
    """New partitions of ``root``, written but not yet visible."""
    root: str
    version: str
    by: str

    @property
    def path(self) -> str:
        return f"{self.root}/_staged-{self.version}"


class _Files:
    """The few file operations needed, on whatever storage holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path + ".part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(path + ".part", path)                     # the log is there as a whole or not at all

    def read(self, path: str) -> str:
        p = self._path(path)
        size = self._fs.getFileStatus(p).getLen()
        src = self._fs.open(p)
        try:
            return bytes(src.readNBytes(int(size))).decode()
        finally:
            src.close()


def stage(df: DataFrame, root: str, by: str, max_records_per_file: int | None = None) -> Staged:
    """Step 1: write ``df`` beside the live partitions of ``root``."""
    root = root.rstrip("/")
    recover(df.sparkSession, root)
    staged = Staged(root, uuid.uuid4().hex[:12], by)
    write_partitioned(df, staged.path, by, mode="errorifexists", max_records_per_file=max_records_per_file)
    return staged


def staged_rows(spark: SparkSession, staged: Staged) -> dict[str, int]:
    """Rows of each staged partition, counted in the files themselves (no column is read)."""
    if not any(n.startswith(f"{staged.by}=") for n in _Files(spark, staged.root).names(staged.path)):
        return {}
    counted = spark.read.parquet(staged.path).groupBy(staged.by).count().collect()       # one row per partition
    return {str(r[0]): r[1] for r in counted}


def discard(spark: SparkSession, staged: Staged) -> None:
    """Drop what did not pass."""
    _Files(spark, staged.root).drop(staged.path)


def publish(spark: SparkSession, staged: Staged, dynamic: bool = False) -> list[str]:
    """Step 3: the staged partitions become the live ones; returns their folder names.

    ``dynamic`` leaves the other partitions alone, else they are retired too."""
    files = _Files(spark, staged.root)
    new = sorted(n for n in files.names(staged.path) if n.startswith(f"{staged.by}="))
    gone = [] if dynamic else sorted(n for n in files.names(staged.root) if n.startswith(f"{staged.by}=") and n not in new)
    files.write(f"{staged.root}/_publish-{staged.version}", json.dumps({"new": new, "gone": gone}))
    _carry_out(files, staged.root, staged.version)
    return new


def _carry_out(files: _Files, root: str, version: str) -> None:
    """The moves of a log, as far as they are still to be done; may be repeated any number of times."""
    log = json.loads(files.read(f"{root}/_publish-{version}"))
    staged, retired = f"{root}/_staged-{version}", f"{root}/_retired-{version}"
    for name in log["new"]:
        if files.exists(f"{staged}/{name}"):
            if files.exists(f"{root}/{name}"):
                files.move(f"{root}/{name}", f"{retired}/{name}")
            files.move(f"{staged}/{name}", f"{root}/{name}")
    for name in log["gone"]:
        if files.exists(f"{root}/{name}"):
            files.move(f"{root}/{name}", f"{retired}/{name}")
    files.drop(retired)
    files.drop(staged)
    files.drop(f"{root}/_publish-{version}")


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish publications that were cut short and drop what was staged without one; returns the finished versions."""
    root = root.rstrip("/")
    files = _Files(spark, root)
    names = files.names(root)
    done = sorted(n.removeprefix("_publish-") for n in names if n.startswith("_publish-") and not n.endswith(".part"))
    for version in done:
        _carry_out(files, root, version)
    for n in files.names(root):
        if n.startswith(("_staged-", "_publish-")):
            files.drop(f"{root}/{n}")
    return done
