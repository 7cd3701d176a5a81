"""The three classifiers: floors on documents that training did not see, and rows that must not break them."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import langid, quality, toxicity
from salesmart.llm.convnet import ConvNet
from salesmart.llm.queries import op6_toxicity, op8_language_id, remainder

FOLDER = "/root/testdata/sf0.01"
ROWS = [(900_001, None), (900_002, ""), (None, "no id at all"), (None, None), (900_003, "12 34 | ... 中"), (900_004, "word " * 60_000), (900_005, "same words twice"), (900_005, "same words twice")]


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_language_of_unseen_documents(spark, given):
    out = op8_language_id(spark, FOLDER)
    both = out.join(given[0].select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("hit"))
    assert out.count() == given[0].count() and both.count() > 100
    assert both.agg(F.avg("hit")).first()[0] > 0.97


def test_toxicity_of_unseen_documents(spark, given):
    out = op6_toxicity(spark, FOLDER).join(given[1], "doc_id").filter("held_out AND toxic IS NOT NULL").select("toxic", "predicted", "score").collect()
    hits = [r for r in out if r["toxic"] == 1]
    clean = [r for r in out if r["toxic"] == 0]
    assert len(hits) >= 5 and sum(r["predicted"] for r in hits) >= 0.8 * len(hits)
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_folds_follow_the_id(spark, given):
    held = {r["doc_id"]: r["held"] for r in given[0].select("doc_id", (remainder(3) == 1).alias("held")).collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in held.items())


def test_quality_of_unseen_documents(given):
    docs, labels = given
    fold = remainder(2) == 0
    out = quality.classify(docs, labels.filter(fold)).select(F.col("doc.doc_id").alias("doc_id"), "keep").join(labels.filter(~fold), "doc_id").filter("quality IS NOT NULL")
    good, bad = (out.filter(f"quality = {q}").agg(F.avg(F.col("keep").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.97 and bad < 0.1


def test_odd_rows(spark, given, documents):
    docs = documents(ROWS, clash=True)
    known, labels = given
    model = langid.train(known, F.lit(True))
    out = langid.identify(docs, model).collect()
    assert len(out) == len(ROWS) and {r["lang_pred"] for r in out if r["doc_id"] in (900_001, 900_002)} == {"und"} and all(0 <= r["score"] <= 1 for r in out)
    scores = toxicity.score(docs, toxicity.train(known, labels, F.lit(True)), cut=0.7).collect()
    assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scores)
    judged = quality.classify(docs, labels)
    assert judged.count() == len(ROWS) and judged.select("doc.*").columns == docs.columns


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.classify(documents([]), labels).collect() == []
    assert [r["keep"] for r in quality.classify(documents([(1, "a b")]), labels).collect()] == [True]


def test_toxicity_learns_from_every_labelled_document(spark, documents):
    """Each document teaches a word; long ones do too, and several shards come to one network."""
    rows = [(k, f"{'vile ' if k % 3 == 0 else 'kind '}{' '.join(f'w{(k * 7 + j) % 50}' for j in range(8))} only{k}") for k in range(5000)]
    rows += [(9000 + k, "plain " * 2000 + ("grim " if k % 2 else "fair ")) for k in range(60)]
    docs = documents(rows, clash=True)
    toxic = {i: int("vile" in t or "grim" in t) for i, t in rows}
    labels = spark.createDataFrame([(i, 0, y) for i, y in toxic.items()] + [(0, 0, 0), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    known = toxicity.labelled(docs, labels, F.lit(True))
    assert known.count() == len(rows) and known.agg(F.max("words")).first()[0] == 2001
    counts = toxicity.bucket_counts(known).to_pylist()
    assert sum(r["n"] for r in counts if r["lang"] is None and r["bucket"] < toxicity.BUCKETS) == sum(len(set(t.split())) for _, t in rows)
    model = toxicity.train(docs, labels, F.lit(True))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert sum(got[i] == y for i, y in toxic.items()) > 0.98 * len(rows) and sum(got[9000 + k] == k % 2 for k in range(60)) > 50


def test_long_rows_train_as_short_ones_do():
    """A row that goes through the network in parts has the winners that it has as a whole."""
    rng = np.random.default_rng(2)
    net = ConvNet(50, 4, (1, 2, 3), 5, 2, top=3, stretch=16)
    for n in (1, 31, 64, 1000):
        ids = rng.integers(1, 50, (2, n))
        responses = net._responses(ids)
        whole, parts = net._winners(responses), net._found(ids, most=128)
        real = np.isfinite(whole[0])
        assert np.allclose(whole[0][real], parts[0][real]) and np.allclose(np.take_along_axis(responses, parts[1], 1)[real], parts[0][real])
