"""Small helpers of the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Folders that this driver has staged and not removed, in order.
_STAGED: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back, so
    that later steps and lost executors start from the files.  The folder stays
    until :func:`remove_staged`."""
    path = shared_folder(df.sparkSession, name)
    _STAGED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_folders() -> list[str]:
    return list(_STAGED)


def remove_staged(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete staged folders (all of this driver's, or ``paths``), once the results that
    read them have been written or collected; returns their number."""
    gone = [p for p in _STAGED if paths is None or p in paths]
    for p in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(p)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _STAGED.remove(p)
    return len(gone)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (longs): rows ``node, component``
    (smallest node reachable), one per node that has an edge.

    Alternates large-star and small-star steps, each one shuffle; a node with
    many neighbours is only ever aggregated by ``min`` (partially, before the
    shuffle) and joined (split by adaptive execution if skewed).  Edges are
    staged after each round.  Null ends are ignored.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("m"))
        if large:
            both = both.union(e.select(F.col("v").alias("n"), F.col("u").alias("m")))
        low = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        linked = both.join(low, "n")
        if large:
            return linked.where("m > n").select(F.col("m").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        kept = linked.select(F.col("m").alias("u"), F.col("low").alias("v"))
        return kept.union(low.select(F.col("n").alias("u"), F.col("low").alias("v"))).where("u <> v").distinct()

    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    e = staged(pairs.distinct(), "edges")
    for _ in range(max_rounds):
        e = staged(star(star(e, True), False), "edges")
        tops = e.select(F.col("v").alias("u")).distinct()
        if e.groupBy("u").count().where("count > 1").isEmpty() and e.join(tops, "u", "left_semi").isEmpty():
            break  # every node points at one node that points at none
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def ragged_offsets(lengths: np.ndarray) -> np.ndarray:
    """Start offsets (with the total as last entry) of consecutive pieces."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
