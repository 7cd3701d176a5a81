"""Shared scratch space for intermediate tables and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without that setting (tests) falls back to a
    temporary folder; a cluster without it is refused, since a machine-local
    folder there would lose data with its executor.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="salesmart-")
    return _local_scratch


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the scratch root."""
    return f"{scratch_root(spark)}/salesmart/{label}-{uuid.uuid4().hex}"


def concurrently(**jobs: Callable[[], object]) -> dict[str, object]:
    """Run independent builders at the same time, so that their Spark jobs share the cluster.

    Their threads have the job group, pool and other local properties of the caller.
    """
    spark = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(spark) if spark else (lambda job: job)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


def write_table(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return path


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet and return the stored table.

    Used where a reduced frame feeds several passes (quantiles, medians, model
    input): the heavy lineage runs once, later passes read only the columns they
    need, and a lost executor costs a re-read instead of a re-computation.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, label))
