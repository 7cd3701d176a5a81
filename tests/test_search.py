"""The posting index gives the rows of a plain scan."""

import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators import search

TERMS = ["ab", "abc", "ABCA", "cab", "bcabc", "x", "ü", "äöü", "%_", "zzzz", " ", "a b"]


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(8)
    text = lambda: rng.choice([None, "", "".join(rng.choice("abcABC ") for _ in range(rng.randrange(12))), "xÄÖÜ%_", "aa"])
    a = spark.createDataFrame([(k, text(), text()) for k in range(300)] + [(900 + k, "same value here", "abcabc") for k in range(200)], "id long, s string, t string")
    b = spark.createDataFrame([(f"k{k}", k, text()) for k in range(80)], "id string, no long, s string")
    return {"a": a, "b": b}


COLUMNS, KEYS = {"a": ["s", "t"], "b": ["s"]}, {"a": ["id"], "b": ["id", "no"]}


def plain(frames, terms):
    out = []
    for term in terms:
        for name, df in frames.items():
            for r in df.collect():
                hit = sorted(c for c in COLUMNS[name] if term.strip() and term.lower() in (r[c] or "").lower())
                if hit:
                    key = f'{{"id":{r["id"]}}}' if name == "a" else f'{{"id":"{r["id"]}","no":{r["no"]}}}'
                    out.append((term, name, key, ",".join(hit)))
    return sorted(out)


def test_hits_are_those_of_a_scan(frames):
    index = search.SearchIndex.build(frames, COLUMNS)
    assert sorted(map(tuple, index.search(TERMS, frames, KEYS).collect())) == plain(frames, TERMS)
    assert index.search(["nothing like it"], frames, KEYS).isEmpty() and index.search([], frames, KEYS).isEmpty()


def test_only_different_values_are_indexed(frames):
    index = search.SearchIndex.build(frames, COLUMNS)
    assert index.values.where("value = 'same value here'").count() == 1
    assert index.postings.where("value = 'same value here'").count() == len({"same value here"[k : k + 3] for k in range(13)})


def test_a_search_reads_its_own_buckets(frames):
    index = search.SearchIndex.build(frames, COLUMNS)
    plan = index._values_of(["abcabc"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "bucket" in plan.split("PartitionFilters")[1][:80]


def test_pages_cover_all_hits_once(frames):
    index = search.SearchIndex.build(frames, COLUMNS)
    hits = index.search(["ab", "a"], frames, KEYS)
    n = hits.count()
    pages = [r for k in range(1, n // 40 + 2) for r in map(tuple, search.page_of(hits, k, 40).collect())]
    assert pages == sorted(pages, key=lambda r: r[:3]) and len(pages) == len(set(pages)) == n
    with pytest.raises(ValueError):
        search.page_of(hits, 0)


def test_segments_follow_the_median_cluster(spark):
    import numpy as np

    from salesmart.operators.customers import segment_labels

    centres = np.array([[-5.0, 3.0, 1.0], [-4.0, 2.0, 1.0], [-3.0, 0.5, 1.0], [-2.0, 2.5, 1.0], [-1.0, 0.2, 1.0]])
    assert segment_labels(centres) == ["Champions", "Loyal Customers", "Potential Loyalist", "At Risk - High Value", "Hibernating"]
    assert segment_labels(np.array([[0.0, 0.0, 0.0]])) == ["Champions"]


def test_registered_segments_cover_every_customer(spark, data):
    from oracle import DATA

    from salesmart.plans.registry import spark_queries

    rows = spark_queries()["rfm_segments"](spark, DATA)
    scores = spark_queries()["rfm_scores"](spark, DATA)
    assert rows.count() == scores.count() and rows.groupBy("cluster").agg(F.count_distinct("segment").alias("n")).where("n <> 1").isEmpty()
    assert rows.where("segment is null").isEmpty() and rows.select("segment").distinct().count() >= 3
