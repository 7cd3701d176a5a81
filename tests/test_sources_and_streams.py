from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from salesmart import storage
from salesmart.operators import models
from salesmart.sources import contracts, files
from salesmart.sources.bindings import Dataset
from salesmart.streaming import kpis
from salesmart.streaming.runs import read_files, replace_batch, run_append


def test_csv_cells_empty_quoted_and_malformed(spark, tmp_path):
    text = 'location_id,city_area\n1,North\n2,\n3,""\nfour,South\n'
    (tmp_path / "locations.csv").write_text(text)
    got = files.load_table(spark, str(tmp_path / "locations.csv"), contracts.schema("locations")).cache()
    rows = {r["location_id"]: r["city_area"] for r in got.collect()}
    assert rows[1] == "North" and rows[2] is None and rows[3] is None
    assert [r["_corrupt"] for r in got.where("_corrupt is not null").collect()] == ["four,South"]


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    files.write_partitioned(df, path, ["p"])
    files.write_partitioned(df.where("p = 'a'").withColumn("id", F.col("id") + 10), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(2, "b"), (11, "a")]
    with pytest.raises(ValueError):
        files.write_partitioned(df, path, ["missing"])


def test_schema_drift_lists_names_and_types(spark):
    found = spark.createDataFrame([], "location_id string, extra int").schema
    got = {(r["check"], r["column_name"]) for r in files.schema_drift(spark, found, contracts.schema("locations"), "locations").collect()}
    assert got == {("type_drift", "location_id"), ("missing_column", "city_area"), ("extra_column", "extra")}


def fake_session(master, settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session_setting():
    shared = fake_session("spark://cluster", {"spark.checkpoint.dir": "hdfs:///scratch/"})
    assert storage.new_path(shared, "x").startswith("hdfs:///scratch/salesmart/x-")
    with pytest.raises(RuntimeError):  # a cluster without the setting must not use a machine-local folder
        storage.scratch_root(fake_session("spark://cluster", {}))
    assert storage.scratch_root(fake_session("local[2]", {}))


def test_replaced_tables_are_seen(spark, tmp_path):
    folder = str(tmp_path)
    part = lambda *kinds: spark.createDataFrame([(k, t) for k, t in enumerate(kinds)], "p_partkey long, p_type string").write.mode("overwrite").parquet(f"{folder}/part.parquet")
    part("a", "b")
    assert [r["category_name"] for r in Dataset(spark, folder).categories.orderBy("category_id").collect()] == ["a", "b"]
    part("b", "c", "d")
    assert [r["category_name"] for r in Dataset(spark, folder).categories.orderBy("category_id").collect()] == ["b", "c", "d"]


def test_threads_inherit_the_job_group(spark):
    spark.sparkContext.setLocalProperty("spark.job.description", "outer")
    found = storage.concurrently(a=lambda: spark.sparkContext.getLocalProperty("spark.job.description"), b=lambda: spark.sparkContext.getLocalProperty("spark.job.description"))
    spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert found == {"a": "outer", "b": "outer"}


def test_materialized_frame_is_a_table(spark):
    stored = storage.materialize(spark.range(5).withColumn("x", F.col("id") / 2))
    assert stored.count() == 5 and stored.inputFiles()


def test_export_allow_list_and_nested_cells(spark):
    df = spark.sql("select 1L as id, array(named_struct('a', 1)) as cells")
    assert files.export_dataset({"d": df}, "d", ["id"]).first()["cells"] == '[{"a":1}]'
    with pytest.raises(ValueError):
        files.export_dataset({"d": df}, "other", ["id"])


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    write = replace_batch(str(tmp_path / "sink"))
    for _ in range(2):
        write(spark.range(3), 0)
    write(spark.range(4), 1)
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 7


def test_windows_over_many_batches_equal_one_batch(spark, data, tmp_path):
    source = str(tmp_path / "events")
    data.table("events").withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(5, "ts").write.parquet(source)
    schema = spark.read.parquet(source).schema
    many = kpis.stream_windows(read_files(spark, source, schema, max_files=5), "1 hour")
    batch = spark.read.parquet(source).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    assert many.agg(F.sum("events")).first()[0] == batch.agg(F.sum("n")).first()[0]
    assert many.count() == batch.count()


def test_duplicates_within_the_watermark_go(spark, data, tmp_path):
    source = str(tmp_path / "twice")
    events = data.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.unionByName(events).write.parquet(source)
    out, _ = run_append(kpis.dedup(read_files(spark, source, events.schema), ["event_id"]), "dedup")
    assert out.count() == events.count()


def test_stored_versions_and_reload(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("customer_id"), (F.col("id") % 2).alias("churned"),
                                   *[(F.col("id") % 7 + F.col("id") % 2 * 3).cast("double").alias(n) for n in models.CHURN_TASK.features])
    split = models.prepared_split(rows, "customer_id")
    root = str(tmp_path / "models")
    for want in (1, 2):
        model = models.train(models.CHURN_TASK, split, "logistic")
        scored = models.score(model, split.where("side = 'test'"), models.CHURN_TASK)
        assert models.save_model(spark, root, models.CHURN_TASK, "logistic", model, models.evaluate(scored, models.CHURN_TASK)) == want
    again = models.score(models.load_latest(spark, root, "customer_churn"), split.where("side = 'test'"), models.CHURN_TASK)
    assert again.exceptAll(scored).count() == 0
    assert {(r["version"], r["status"]) for r in models.model_catalog(spark, root).collect()} == {(1, "archived"), (2, "active")}
