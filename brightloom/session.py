"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_fallback_dir: str | None = None
_stages: list[str] = []  # folders that `measured` has written outside of any `stages` block
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=(_stages,))  # per thread, as queries may run side by side


def get_session(app: str = "brightloom", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session it provides."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only where none is set and the master is local."""
    global _fallback_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="brightloom-")
    return _fallback_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, unique per call."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def measured(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    The written size is known to the optimizer, so a join with it is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold`` and sorted (with skew splitting) above. Raw rows on the other
    side are then not shuffled just because the size of an aggregate was unknown at planning time. Lost
    executors cost no recomputation of the table either. With ``keep`` it outlives the ``stages`` block it is written in.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    blocks = _blocks.get()
    blocks[max(0, len(blocks) - 2) if keep else -1].append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = True
    return out


def written(df: DataFrame) -> DataFrame:
    """``df`` itself if ``measured`` has just returned it, else its written copy."""
    return df if getattr(df, "_written", False) is True else measured(df)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``measured`` wrote inside, but for kept tables: these belong to the block around.

    For operators that write many tables on the way to one: the result must not read any of the others.
    """
    written: list[str] = []
    before = _blocks.set((*_blocks.get(), written))
    try:
        yield
    finally:
        _blocks.reset(before)
        _remove(spark, written)


def _remove(spark: SparkSession, paths: list[str]) -> int:
    removed = 0
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def _is_small(df: DataFrame, bytes_per_core: int) -> bool:
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return cores > 1 and size < cores * bytes_per_core


def spread(df: DataFrame, bytes_per_core: int = 16 << 20) -> DataFrame:
    """``df`` dealt to all cores if its input is small, for work that costs far more per row than moving it.

    A small file is often one partition, and all work above it one task. Larger inputs are read in as many partitions as
    there is work for, and are left as they are.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if _is_small(df, bytes_per_core) else df


def small_in_parallel(df: DataFrame, bytes_per_core: int = 16 << 20) -> DataFrame:
    """``df`` written in as many parts as there are cores if its input is small, for several passes over it; larger inputs stay."""
    return measured(spread(df, bytes_per_core)) if _is_small(df, bytes_per_core) else df


def release_stages(spark: SparkSession) -> int:
    """Remove what ``measured`` has written in this process outside of ``stages`` blocks; call it when results that read it are used up."""
    return _remove(spark, _stages)
