"""Streaming indicators over the event stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import columns as c
from salesmart.operators.cleaning import REASON, mark
from salesmart.sources.files import folder_numbers, path_exists
from salesmart.storage import new_path
from salesmart.streaming.runs import late_rows, read_files, replace_batch, run_append, run_batches, run_update, setting, stored_batches


def windowed(events: DataFrame, width: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events and value per type and (tumbling or sliding) window."""
    span = F.window("ts", width, slide) if slide else F.window("ts", width)
    sums = events.withWatermark("ts", delay).groupBy(span.alias("w"), "event_type").agg(
        F.count("*").alias("events"), c.exact_sum("value").alias("total_value"))
    return sums.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", "total_value")


def stream_windows(events: DataFrame, width: str, slide: str | None = None) -> DataFrame:
    return run_update(windowed(events, width, slide), "windows", ["window_start", "event_type"])


DELAY = "1 hour"


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = DELAY) -> DataFrame:
    """Activity sessions per user."""
    s = events.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.count("*").alias("events"), c.exact_sum("value").alias("total_value"))
    return s.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "events", "total_value")


def stream_sessions(events: DataFrame) -> DataFrame:
    """Sessions closed by the watermark; open ones stay in state for the next run.

    Rows of a batch merge into sessions before the shuffle, so a very active user
    arrives as a few partial sessions.
    """
    with setting(events.sparkSession, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        return run_append(sessions(events), "sessions")[0]


def resumed_sessions(events: DataFrame, folder: str, flush_at: str | None = None, write=None) -> DataFrame:
    """All sessions closed so far over any number of runs with the same ``folder``.

    Open sessions stay in the state store below the kept checkpoint, and the next run goes on with
    them; a batch that failed is repeated and overwrites itself. ``flush_at`` (an instant as text)
    declares that no earlier event will come: a marker row, read as part of the stream, moves the
    watermark there, so every session that ends before it is closed. Later events go on as usual.
    Events without a user make no session.
    ``write`` takes the place of the sink's writer.
    """
    spark = events.sparkSession
    marks, rows = f"{folder}/marks", f"{folder}/sessions"
    empty = spark.createDataFrame([], events.schema)
    if not path_exists(spark, marks):
        empty.write.parquet(marks)
    if flush_at:
        # The watermark trails the latest instant by the delay.
        at = F.lit(flush_at).cast("timestamp") + F.expr(f"interval {DELAY}")
        cells = [at.alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields]
        spark.range(1).select(*cells).coalesce(1).write.mode("append").parquet(marks)
    stream = sessions(events.unionByName(read_files(spark, marks, events.schema)), delay=DELAY)
    with setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        run_batches(stream, "sessions", write or replace_batch(rows), folder=folder)
    # Not in the stream: there the filter would move below the watermark and take the markers away.
    return stored_batches(spark, rows, stream.schema).where("user_id is not null")


def dedup(events: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """First event per key; the key is forgotten once the watermark passes it."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def stream_quarantine(events: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Validated ingest: each micro-batch goes to a good and a quarantine table.

    Both writes of a batch are keyed by its id, so a restart repeats them safely.
    """
    spark = events.sparkSession
    good, bad = new_path(spark, "stream-good"), new_path(spark, "stream-bad")

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = mark(batch, rules)
        marked.where(F.col(REASON).isNull()).drop(REASON).write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
        marked.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")

    run_batches(events, "quarantine", write)
    return spark.read.parquet(good), spark.read.parquet(bad)


def baseline(events: DataFrame) -> DataFrame:
    """Mean and deviation per event type from exact power sums, the static side of the alerts."""
    v = F.col("value")
    s = events.groupBy("event_type").agg(F.count("*").alias("n"), c.exact_sum(v, 2).alias("s1"), c.exact_sum(v * v, 4).alias("s2"))
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / (F.col("n") - 1)
    return s.select("event_type", (F.col("s1") / F.col("n")).alias("mu"), F.sqrt(variance).alias("sigma"))


class Baselines:
    """Stored baselines by version. A micro-batch takes the newest one and remembers which, so that a repeated batch takes the same again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def versions(self) -> list[int]:
        return folder_numbers(self.spark, f"{self.folder}/baselines", "v=")

    def add(self, base: DataFrame) -> int:
        version = max(self.versions(), default=0) + 1
        base.coalesce(1).write.parquet(f"{self.folder}/baselines/v={version}")  # one row a type
        return version

    def of_batch(self, batch_id: int) -> tuple[int, DataFrame]:
        chosen = f"{self.folder}/chosen/batch={batch_id}"
        if path_exists(self.spark, f"{chosen}/_SUCCESS"):
            version = self.spark.read.schema("version long").parquet(chosen).first()["version"]
        else:
            version = max(self.versions())
            self.spark.range(1).select(F.lit(version).cast("long").alias("version")).write.mode("overwrite").parquet(chosen)
        return version, self.spark.read.schema("event_type string, mu double, sigma double").parquet(f"{self.folder}/baselines/v={version}")


def above_baseline(events: DataFrame, base: DataFrame, limit: float) -> DataFrame:
    z = F.round((F.col("value") - F.col("mu")) / F.col("sigma"), 6)
    flagged = events.join(base, "event_type").where(F.col("sigma") > 0).withColumn("z_score", z).where(F.col("z_score") > limit)
    return flagged.select("event_id", "event_type", "value", "z_score")


def stream_anomaly(events: DataFrame, baselines: Baselines, limit: float = 3.0, after=None) -> DataFrame:
    """Events far above the stored baseline of their type, with the version each batch was held against.

    The baseline is read from its table, a row for each type, and never computed in the stream. The folder of
    ``baselines`` also keeps the checkpoint: a later run goes on with new events and the newest version.
    ``after`` is called with each batch's number when it is written.
    """
    rows = f"{baselines.folder}/alerts"

    def write(batch: DataFrame, batch_id: int) -> None:
        version, base = baselines.of_batch(batch_id)
        alerts = above_baseline(batch, base, limit).withColumn("baseline_version", F.lit(version).cast("long"))
        alerts.write.mode("overwrite").parquet(f"{rows}/batch={batch_id}")
        if after:
            after(batch_id)

    run_batches(events, "alerts", write, folder=baselines.folder)
    schema = T.StructType.fromDDL("event_id long, event_type string, value double, z_score double, baseline_version long")
    return stored_batches(events.sparkSession, rows, schema)


def stream_score(rows: DataFrame, model: PipelineModel, key: str) -> DataFrame:
    """Score a feature stream with a stored model."""
    return run_append(model.transform(rows).select(key, F.col("prediction").cast("long").alias("predicted")), "scores")[0]


def stream_late(events: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """De-duplicated events and the number of rows the watermark dropped, added up as batches end."""
    with late_rows(events.sparkSession) as late:
        out, query = run_append(dedup(events, keys), "late")
        return out, late.total(query)
