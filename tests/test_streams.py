"""Streams that stop, fail and go on."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from salesmart.streaming import kpis
from salesmart.streaming.runs import read_files, replace_batch, run_batches

DDL = "event_id long, user_id long, event_type string, value double, ts timestamp"
START = datetime(2024, 1, 1)


def minute(k):
    return START + timedelta(minutes=k)


def events(n, users=7, seed=2):
    """Events of some users in the order of time, about two hours of gaps between some of them."""
    rng, at, out = random.Random(seed), {u: 0 for u in range(users)}, []
    for k in range(n):
        u = rng.randrange(users)
        at[u] = max(at[u] + rng.choice([1, 5, 20, 29, 31, 90]), 3 * k)
        out.append((k, u, "a" if u % 2 else "b", float(rng.randrange(100)), minute(at[u])))
    return sorted(out, key=lambda r: r[4])


def plain_sessions(rows):
    """(user, start, end, events) by walking through each user's events."""
    out = {}
    for _, u, _, _, ts in sorted(rows, key=lambda r: (r[1], r[4])):
        last = out.get(u, [])
        if last and ts <= last[-1][1] + timedelta(minutes=30):
            last[-1][1], last[-1][2] = ts, last[-1][2] + 1
        else:
            out[u] = [*last, [ts, ts, 1]]
    return sorted((u, a, b + timedelta(minutes=30), n) for u, found in out.items() for a, b, n in found)


def found(df):
    return sorted((r["user_id"], r["session_start"], r["session_end"], r["events"]) for r in df.collect())


def add(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def test_a_stopped_run_goes_on_with_its_open_sessions(spark, tmp_path):
    source, folder, rows = str(tmp_path / "in"), str(tmp_path / "kept"), events(400)
    seen = []
    for k in range(4):
        add(spark, source, rows[100 * k : 100 * k + 100])
        closed = found(kpis.resumed_sessions(read_files(spark, source, spark.createDataFrame([], DDL).schema), folder))
        assert len(closed) == len(set(closed)) and set(seen) <= set(closed)  # each once, none taken back
        seen = closed
    want = plain_sessions(rows)
    end = max(r[4] for r in rows)
    assert seen == [s for s in want if s[2] <= end - timedelta(hours=1)]
    flushed = found(kpis.resumed_sessions(read_files(spark, source, spark.createDataFrame([], DDL).schema), folder, flush_at=str(end + timedelta(days=1))))
    assert flushed == want


def test_a_failed_batch_is_repeated_and_counted_once(spark, tmp_path):
    source, folder, rows = str(tmp_path / "in"), str(tmp_path / "kept"), events(300, seed=3)
    for k in range(6):
        add(spark, source, rows[50 * k : 50 * k + 50])
    schema, written = spark.createDataFrame([], DDL).schema, []

    def fails_late(batch, batch_id):
        replace_batch(f"{folder}/sessions")(batch, batch_id)  # written, then lost before it is committed
        written.append(batch_id)
        if batch_id == 3:
            raise RuntimeError("executor lost")

    with pytest.raises(StreamingQueryException):
        kpis.resumed_sessions(read_files(spark, source, schema, 1), folder, write=fails_late)
    assert written[-1] == 3
    end = max(r[4] for r in rows)
    assert found(kpis.resumed_sessions(read_files(spark, source, schema, 1), folder, flush_at=str(end + timedelta(days=1)))) == plain_sessions(rows)


def test_events_after_a_flush_go_on(spark, tmp_path):
    source, folder, rows = str(tmp_path / "in"), str(tmp_path / "kept"), events(60, seed=4)
    schema, end = spark.createDataFrame([], DDL).schema, max(r[4] for r in rows)
    add(spark, source, rows)
    kpis.resumed_sessions(read_files(spark, source, schema), folder, flush_at=str(end + timedelta(days=1)))
    later = [(i + 1000, u, t, v, ts + timedelta(days=3)) for i, u, t, v, ts in rows]
    add(spark, source, later)
    done = kpis.resumed_sessions(read_files(spark, source, schema), folder, flush_at=str(end + timedelta(days=9)))
    assert found(done) == plain_sessions(rows + later)


def test_each_batch_keeps_its_version_of_the_baseline(spark, tmp_path):
    source, schema = str(tmp_path / "in"), spark.createDataFrame([], DDL).schema
    baselines = kpis.Baselines(spark, str(tmp_path / "kept"))
    base = lambda mu: spark.createDataFrame([("a", mu, 1.0)], "event_type string, mu double, sigma double")
    baselines.add(base(0.0))
    add(spark, source, [(1, 1, "a", 10.0, START), (2, 1, "a", 1.0, START)])

    def fail(batch_id):
        baselines.add(base(100.0))
        raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):  # the new version comes before the first batch is repeated
        kpis.stream_anomaly(read_files(spark, source, schema), baselines, after=fail)
    add(spark, source, [(3, 1, "a", 10.0, START), (4, 1, "a", 110.0, START)])
    got = kpis.stream_anomaly(read_files(spark, source, schema), baselines)
    assert sorted((r["event_id"], r["z_score"], r["baseline_version"]) for r in got.collect()) == [(1, 10.0, 1), (4, 10.0, 2)]


def test_late_rows_are_added_up_over_many_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), spark.createDataFrame([], DDL).schema
    add(spark, source, [(0, 1, "a", 1.0, minute(10_000))])
    add(spark, source, [(1, 1, "a", 1.0, minute(10_001))])
    for k in range(2, 8):
        add(spark, source, [(k, 1, "a", 1.0, minute(k)), (k + 100, 1, "a", 1.0, minute(10_000 + k))])
    out, dropped = kpis.stream_late(read_files(spark, source, schema, 1), ["event_id"])
    assert (out.count(), dropped) == (8, 6)


def test_kept_checkpoint_reads_each_file_once(spark, tmp_path):
    source, folder, schema = str(tmp_path / "in"), str(tmp_path / "kept"), spark.createDataFrame([], DDL).schema
    for k in range(2):
        add(spark, source, [(k, 1, "a", 1.0, START)])
        run_batches(read_files(spark, source, schema), "x", replace_batch(f"{folder}/rows"), folder=folder)
    assert spark.read.parquet(f"{folder}/rows").agg(F.count("*"), F.count_distinct("event_id")).first() == (2, 2)
