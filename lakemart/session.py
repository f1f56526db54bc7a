"""Session construction and shared-storage scratch locations.

Intermediate outputs (round trips, lineage cuts) always go below the
checkpoint directory the cluster names in ``spark.checkpoint.dir`` — a
shared filesystem on a real cluster.  Only when that setting is absent and
the master is local (unit tests) do we create a local temporary one.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lakemart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    AQE stays on so shuffle partitions are coalesced at runtime and skewed
    join partitions are split; the UI stays off (no listening port).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # coalesce shuffles to the advisory size, not to "as many tasks as cores":
        # fewer tiny post-shuffle tasks (Spark's advice for busy clusters)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # partition columns such as the period key stay strings unless a schema says otherwise
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a wide
        # report projection fused into one generated method would then run
        # interpreted (~3x slower).  Above this size Spark falls back to
        # per-expression generated code instead (Spark's documented setting).
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    Order: the SparkContext's directory, else ``spark.checkpoint.dir`` from
    the session, else (local master only) a fresh local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


class Scratch:
    """Owner of scratch folders: those made through it are deleted when its block ends.

    Use it around work whose *output is written* within the block (e.g. a
    bronze build) and hand it to the operators that need intermediate tables.
    Scopes are independent objects, so builds that overlap in one driver (or
    worker threads of one build) never delete each other's tables.  Do not
    return a lazy DataFrame that reads them.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths, self._lock = spark, [], threading.Lock()

    def add(self, path: str) -> str:
        with self._lock:
            self._paths.append(path)
        return path

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def release(self) -> None:
        """Delete what the scope holds by now."""
        with self._lock:
            paths, self._paths = self._paths, []
        for path in paths:
            _delete(self._spark, path)


def scratch_path(spark: SparkSession, name: str, scope: Scratch | None = None) -> str:
    """A fresh, unique folder below the shared checkpoint directory; with ``scope`` it goes when the scope ends."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base.rstrip("/"), "lakemart-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
    return scope.add(path) if scope else path


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame, name: str, scope: Scratch | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet below the shared checkpoint
    folder and return the re-read table.  One job (``checkpoint()`` would
    compute an un-persisted plan twice); survives executor loss because the
    files live on shared storage."""
    spark = df.sparkSession
    path = scratch_path(spark, name, scope)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer-inference job
