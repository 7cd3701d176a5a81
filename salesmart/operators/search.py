"""Keyword search over the text columns of many tables with a posting index of letter triples.

Only distinct values are indexed: a column of few different texts costs a few postings however
many rows it has. A posting is (gram, dataset, column, value); the index is stored by gram bucket,
so a search reads the buckets of its own grams. Values that hold all grams of a term are then
compared literally, and the values found are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.storage import new_path

GRAM = 3
BUCKETS = 64


def grams(text: Column) -> Column:
    """All different letter triples; none for a shorter text."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


class SearchIndex:
    """Stored values and postings of the allowed columns of several tables."""

    def __init__(self, spark: SparkSession, folder: str, columns: Mapping[str, list[str]]):
        self.spark, self.folder, self.columns = spark, folder, columns

    @classmethod
    def build(cls, frames: Mapping[str, DataFrame], columns: Mapping[str, list[str]], folder: str | None = None) -> "SearchIndex":
        """Index ``columns`` (dataset -> text columns) of ``frames``; equal texts are one value before they are shuffled."""
        spark = next(iter(frames.values())).sparkSession
        index = cls(spark, folder or new_path(spark, "search"), columns)
        parts = []
        for dataset, names in columns.items():
            cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.lower(F.col(n).cast("string")).alias("value")) for n in names]))
            parts.append(frames[dataset].select(F.lit(dataset).alias("dataset"), cells.alias("cell")).select("dataset", "cell.column", "cell.value"))
        values = reduce(DataFrame.unionByName, parts).where("value <> ''").distinct()
        values.write.parquet(f"{index.folder}/values")
        postings = index.values.withColumn("gram", F.explode(grams(F.col("value"))))
        postings.withColumn("bucket", bucket(F.col("gram"))).repartition("bucket").write.partitionBy("bucket").parquet(f"{index.folder}/postings")
        return index

    @property
    def values(self) -> DataFrame:
        return self.spark.read.schema("dataset string, column string, value string").parquet(f"{self.folder}/values")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema("dataset string, column string, value string, gram string, bucket int").parquet(f"{self.folder}/postings")

    def _values_of(self, terms: list[str]) -> DataFrame:
        """``term, dataset, column, value`` for values that hold a term, without regard to case."""
        wanted = {t: t.lower() for t in terms if t.strip()}
        split = {t: sorted({low[k : k + GRAM] for k in range(len(low) - GRAM + 1)}) for t, low in wanted.items()}
        rows = [(t, wanted[t], g, len(split[t])) for t in wanted for g in split[t]]
        found = self.values.select(F.lit(None).cast("string").alias("term"), "dataset", "column", "value").limit(0)
        if rows:
            asked = self.spark.createDataFrame(rows, "term string, text string, gram string, grams int").withColumn("bucket", bucket(F.col("gram")))
            buckets = sorted({r["bucket"] for r in asked.select("bucket").distinct().collect()})  # of the terms' own grams
            met = self.postings.where(F.col("bucket").isin(buckets)).join(F.broadcast(asked), ["bucket", "gram"])
            whole = met.groupBy("term", "text", "dataset", "column", "value", "grams").agg(F.count("*").alias("n")).where("n = grams")
            found = found.unionByName(whole.where(F.col("value").contains(F.col("text"))).select("term", "dataset", "column", "value"))
        for t in wanted:
            if not split[t]:  # shorter than a gram: look through the different values
                found = found.unionByName(self.values.where(F.col("value").contains(wanted[t])).select(F.lit(t).alias("term"), "dataset", "column", "value"))
        return found

    def search(self, terms: list[str], frames: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> DataFrame:
        """``term, dataset, key, columns`` of every row that holds a term: ``key`` as JSON, ``columns`` the matching ones in order.

        All hits are given; ``page_of`` cuts them into pages.
        """
        values = self._values_of(terms)
        parts = []
        for dataset, names in self.columns.items():
            cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.lower(F.col(n).cast("string")).alias("value")) for n in names]))
            rows = frames[dataset].select(F.to_json(F.struct(*keys[dataset])).alias("key"), cells.alias("cell")).select("key", "cell.column", "cell.value")
            hits = rows.join(values.where(F.col("dataset") == dataset).drop("dataset"), ["column", "value"])
            parts.append(hits.groupBy("term", "key").agg(F.array_join(F.array_sort(F.collect_set("column")), ",").alias("columns")).withColumn("dataset", F.lit(dataset)))
        return reduce(DataFrame.unionByName, parts).select("term", "dataset", "key", "columns")


def page_of(hits: DataFrame, page: int, size: int = 25) -> DataFrame:
    """One page of hits in the order of term, table and key."""
    if page < 1 or size < 1:
        raise ValueError("pages count from 1 and have a row at least")
    return hits.orderBy("term", "dataset", "key").offset((page - 1) * size).limit(size)
