"""Sources, sinks and bounded runs shared by the streaming operators."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from salesmart.storage import new_path


def read_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet file stream; ``max_files`` bounds a micro-batch so state grows in steps."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the duration of one run."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def run_append(stream: DataFrame, label: str, folder: str | None = None) -> tuple[DataFrame, StreamingQuery]:
    """Drain the available input into a Parquet table (append mode) and return it.

    With ``folder`` the table and the checkpoint are kept there: a later call goes on where this one ended or failed.
    """
    spark = stream.sparkSession
    root = folder or new_path(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows"), query


def run_batches(stream: DataFrame, label: str, write: Callable[[DataFrame, int], None], mode: str = "append", folder: str | None = None) -> StreamingQuery:
    """Drain the available input through ``write(batch, batch_id)``; with ``folder`` the checkpoint is kept there, so that runs resume."""
    root = folder or new_path(stream.sparkSession, label)
    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def replace_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Sink writing each micro-batch to its own folder, so a replayed batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def stored_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches that ``replace_batch`` has written, without their numbers."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path).drop("batch")


def run_update(stream: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Drain an update-mode aggregation; the latest state of each key is the result."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    run_batches(stream, label, replace_batch(path), mode="update")
    stored = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    newest = stored.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return stored.join(newest, [*keys, "batch"]).drop("batch")


class LateRows(StreamingQueryListener):
    """Rows that the watermark dropped, added up by run as batches end: one number a run, however many batches there are."""

    def __init__(self) -> None:
        self._dropped: dict[str, int] = defaultdict(int)
        self._ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._dropped[str(event.progress.runId)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def total(self, query: StreamingQuery, seconds: float = 60) -> int:
        """Dropped rows of an ended run; events come in order, so all of its batches are counted when its end is told."""
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the end of the streaming run was not told")
        return self._dropped[str(query.runId)]


@contextmanager
def late_rows(spark: SparkSession) -> Iterator[LateRows]:
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
