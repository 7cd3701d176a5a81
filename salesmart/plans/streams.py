"""Streaming queries; each drains the event table as a stream and returns the written result."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import models
from salesmart.operators.models import CHURN_TASK
from salesmart.plans.models import churn_split
from salesmart.plans.registry import query
from salesmart.storage import new_path
from salesmart.streaming import kpis
from salesmart.streaming.runs import read_files, run_append


def event_time(rows):
    """Watermarks need an instant, so the zone-less event time is read in the session zone."""
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(d):
    # A file stream takes folders or patterns; the pattern matches the table whether it is a file or a folder.
    return event_time(read_files(d.spark, f"{d.path}/[e]vents.parquet", d.table("events").schema))


WINDOW = """SELECT {start} AS window_start, event_type, count(*) AS events, sum(value::DECIMAL(18,4))::DOUBLE AS total_value FROM {rows} GROUP BY 1, 2"""


@query("stream_tumbling", WINDOW.format(start="date_trunc('hour', ts)", rows="events"))
def _(d):
    return kpis.stream_windows(event_stream(d), "1 hour")


@query("stream_sliding", WINDOW.format(start="date_trunc('hour', ts) - to_hours(h)", rows="events, (SELECT unnest(range(24)) AS h)"))
def _(d):
    return kpis.stream_windows(event_stream(d), "1 day", "1 hour")


@query("stream_sessions", """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events, sum(value::DECIMAL(18,4))::DOUBLE AS total_value
    FROM (SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE
      THEN 0 ELSE 1 END AS is_new FROM events)) GROUP BY user_id, s HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR""")
def _(d):
    return kpis.stream_sessions(event_stream(d))


SESSIONS = """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events, sum(value::DECIMAL(18,4))::DOUBLE AS total_value
    FROM (SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE
      THEN 0 ELSE 1 END AS is_new FROM events)) GROUP BY user_id, s"""


@query("stream_sessions_resumed", SESSIONS)
def _(d):
    """All sessions: the month arrives in two halves, each drained by a run of its own, and the end is declared."""
    source, folder, events = new_path(d.spark, "halves"), new_path(d.spark, "sessions"), d.table("events")
    for half in ("ts < timestamp_ntz'2024-01-16 00:00:00'", "ts >= timestamp_ntz'2024-01-16 00:00:00'"):
        events.where(half).write.mode("append").parquet(source)
        kpis.resumed_sessions(event_time(read_files(d.spark, source, events.schema)), folder)
    return kpis.resumed_sessions(event_time(read_files(d.spark, source, events.schema)), folder, flush_at="2024-03-01 00:00:00")


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def _(d):
    twice = event_stream(d).unionByName(event_stream(d))
    return run_append(kpis.dedup(twice, ["event_id"]), "dedup")[0].select("event_id", "user_id", "event_type", "value")


@query("stream_quarantine", """SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS rows FROM (SELECT CASE WHEN event_type = 'error' THEN 'error event'
    WHEN value < 1 THEN 'value below minimum' END AS reason FROM events) GROUP BY 1""")
def _(d):
    good, bad = kpis.stream_quarantine(event_stream(d), [("error event", F.col("event_type") == "error"), ("value below minimum", F.col("value") < 1)])
    accepted = good.agg(F.count("*").alias("rows")).select(F.lit("accepted").alias("outcome"), "rows")
    return accepted.unionByName(bad.groupBy(F.col("quarantine_reason").alias("outcome")).agg(F.count("*").alias("rows")))


@query("stream_anomaly", """SELECT e.event_id, e.event_type, e.value, round((e.value - mu) / sigma, 6) AS z_score FROM events e JOIN (
      SELECT event_type, s1 / n AS mu, sqrt((s2 - s1 * s1 / n) / (n - 1)) AS sigma FROM (SELECT event_type, count(*) AS n, sum(value::DECIMAL(12,2))::DOUBLE AS s1,
        sum((value::DECIMAL(12,2) * value::DECIMAL(12,2))::DECIMAL(24,4))::DOUBLE AS s2 FROM events GROUP BY 1)) b ON e.event_type = b.event_type
    WHERE sigma > 0 AND round((e.value - mu) / sigma, 6) > 3""")
def _(d):
    baselines = kpis.Baselines(d.spark, new_path(d.spark, "alerts"))
    baselines.add(kpis.baseline(d.table("events")))
    return kpis.stream_anomaly(event_stream(d), baselines).drop("baseline_version")


@query("stream_score")
def _(d):
    split = churn_split(d)
    model = models.train(CHURN_TASK, split, "logistic")
    root = new_path(d.spark, "models")
    models.save_model(d.spark, root, CHURN_TASK, "logistic", model, models.evaluate(models.score(model, split.where("side = 'test'"), CHURN_TASK), CHURN_TASK))
    source = new_path(d.spark, "feature-stream")
    split.write.parquet(source)
    return kpis.stream_score(read_files(d.spark, source, split.schema), models.load_latest(d.spark, root, CHURN_TASK.name), "customer_id")


@query("stream_late", """SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS kept_rows, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS late_rows FROM events""")
def _(d):
    # The second half of the month is delivered first, in two parts, then the first half arrives
    # late. A batch drops by the watermark of the batch before the last, so the late part has to
    # come third or later: no batch reads more files than the smaller of the first two parts.
    source, events = new_path(d.spark, "late-events"), d.table("events")
    since = lambda day: F.col("ts") >= F.expr(f"timestamp_ntz'{day} 00:00:00'")
    parts = [since("2024-01-16") & ~since("2024-01-23"), since("2024-01-23"), ~since("2024-01-16")]
    files = [0]
    for part in parts:
        events.where(part).write.mode("append").parquet(source)
        files.append(len(d.spark.read.parquet(source).inputFiles()))
    first_files = min(files[1], files[2] - files[1])
    kept, dropped = kpis.stream_late(event_time(read_files(d.spark, source, events.schema, first_files)), ["event_id"])
    return kept.agg(F.count("*").alias("kept_rows")).withColumn("late_rows", F.lit(dropped).cast("long"))
