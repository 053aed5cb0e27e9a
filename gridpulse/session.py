"""Session settings the library relies on, and lineage cutting.

The caller owns the session. Two settings matter for results or robustness:

* ``spark.sql.session.timeZone`` -- dates and hours are computed in it.
* ``spark.checkpoint.dir`` -- a shared, reliable folder (HDFS, object store)
  named by the cluster; :func:`cut_lineage` writes there. It is read from the
  session and set here only when it is unset (local runs and tests).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder; if none is configured, set
    ``fallback`` (or a new scratch folder, for local runs only)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF)
    one_process = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if not (configured or fallback) and not one_process:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; name a shared folder for the cluster")
    target = configured or fallback or tempfile.mkdtemp(prefix="gridpulse-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the session's checkpoint folder.

    Lost executors then recompute from the checkpoint, not from the sources.
    """
    if not checkpoint_dir(df.sparkSession):
        raise RuntimeError(f"set {CHECKPOINT_CONF} (a shared folder) before cutting lineage")
    return df.checkpoint(eager=True)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` (spilling to disk) while several queries read it, then
    release it. Lost blocks are recomputed from the lineage."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def local_session(app_name: str = "gridpulse", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks: UTC, AQE on, UI off."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
