"""Line deduplication with levelled sorted runs of line hashes.

A run is a stored table with one row per line key (128-bit hash): in how many
documents it was met and the largest of their ids. Runs are bucketed and sorted
by key, so that joining runs needs no shuffle. Each new batch of
documents merge-anti-joins the runs to learn which of its keys are new, and adds
a run of its own at level 0. When a level holds ``fan_in`` runs they are merged
into one run of the next level, so the number of runs grows with the logarithm of
the number of batches.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.shared import ASCII_LOWER, freed, slices
from salesmart.storage import materialize, new_path

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
NO_ID = -(2**63)
KEYS = "doc bigint, hi bigint, lo bigint"


def line_key(line: str, least: int) -> bytes | None:
    """128-bit hash of a line stripped and lower-cased, or None when shorter than ``least``."""
    key = line.strip(SPACE)
    if len(key) < least:
        return None
    return xxhash.xxh3_128_digest(key.translate(ASCII_LOWER).encode("utf-8", "surrogatepass"))


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """One row per document and distinct line key; a null id stands below all others."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = {k for line in (text or "").split("\n") if (k := line_key(line, least))}
                out += [(NO_ID if doc is None else doc, *halves(k)) for k in keys]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc", "hi", "lo"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(freed(run), KEYS)


class LineRuns:
    """Levelled runs of line keys (key, number of documents), stored below the scratch folder.

    Batches come in descending order of document id, so the largest id that holds a
    key is found by the batch that meets the key first.
    """

    def __init__(self, spark: SparkSession, fan_in: int = 4):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        self.keepers: list[DataFrame] = []

    def _store(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, name)
        run.write.bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").option("path", self.paths[name]).saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> None:
        """Take a batch of distinct (doc, hi, lo); no document may come in two batches."""
        own = self._store(batch.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc").alias("doc")))
        fresh = self.spark.table(own)
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run).select("hi", "lo").hint("merge"), ["hi", "lo"], "left_anti")
        self.keepers.append(materialize(fresh.select("hi", "lo", "doc"), "line-keepers"))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(own)
        self._compact()

    def _compact(self) -> None:
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fan_in:
                merged = self._store(self._merged(self.levels[k]))
                self._drop(self.levels[k])
                self.levels[k] = []
                self.levels += [[]] * (k + 1 == len(self.levels))
                self.levels[k + 1] = [*self.levels[k + 1], merged]

    def _merged(self, names: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 groups a union of bucketed tables within buckets of one table only.
        every = self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*[self.paths[n] for n in names])
        return every.groupBy("hi", "lo").agg(F.sum("n_docs").alias("n_docs"), F.max("doc").alias("doc"))

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")

    def runs(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def frequent(self, least_docs: int) -> DataFrame:
        """Keys (hi, lo) found in ``least_docs`` documents or more, over all batches."""
        return self._merged(self.runs()).filter(F.col("n_docs") >= least_docs).select("hi", "lo")

    def first_holders(self) -> DataFrame:
        """(hi, lo, doc): the largest document id of every key."""
        return reduce(DataFrame.unionByName, self.keepers)


def repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, batches: int = 4) -> DataFrame:
    """(doc, hi, lo): the line keys that each document loses."""
    spark = docs.sparkSession
    keys = materialize(line_keys(docs, least_chars).distinct(), "line-keys")
    edges = keys.approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(e) for e in edges}, reverse=True)
    runs = LineRuns(spark)
    for low, high in zip([*cuts, None], [None, *cuts], strict=True):
        part = keys
        part = part if low is None else part.filter(F.col("doc") >= low)
        part = part if high is None else part.filter(F.col("doc") < high)
        runs.add(part)
    often = materialize(runs.frequent(least_docs), "line-frequent")
    lost = keys.join(often, ["hi", "lo"]).join(runs.first_holders(), ["hi", "lo", "doc"], "left_anti")
    lost = materialize(lost, "line-lost")
    runs._drop(runs.runs())
    return lost


def without_lines(lost: list | None, text: str | None, least_chars: int) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    if not lost:
        return len(lines), 0, text or ""
    gone = {(x["hi"], x["lo"]) for x in lost}
    kept = [line for line in lines if (k := line_key(line, least_chars)) is None or halves(k) not in gone]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, batches: int = 4) -> DataFrame:
    """The documents as ``doc`` (the row as given), ``kept_text``, ``n_lines``, ``n_dropped``.

    A line's key is the line stripped of ASCII white space and lower-cased (A-Z). A key
    of ``least_chars`` code points or more that ``least_docs`` documents or more hold
    loses all its lines except those in the document of the largest id. A null or empty
    text is one empty line. Rows of one id are one document; a null id is a document
    below all others. An empty table gives no rows.
    """
    lost = repeated_lines(docs, least_chars, least_docs, batches).groupBy("doc").agg(F.collect_list(F.struct("hi", "lo")).alias("lost"))
    lost = lost.withColumnRenamed("doc", "_id")
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("_id"))
    joined = rows.join(lost, "_id", "left").select("doc", "lost")

    def run(batches):
        for batch in slices(batches):
            done = [without_lines(gone, text, least_chars) for gone, text in zip(batch.column(1).to_pylist(), batch.column(0).field("text").to_pylist(), strict=True)]
            n_lines, n_dropped, kept = map(list, zip(*done, strict=True)) if done else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["doc", "kept_text", "n_lines", "n_dropped"])

    schema = joined.select("doc", F.lit("").alias("kept_text"), F.lit(0).cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_dropped")).schema
    return joined.mapInArrow(freed(run), schema)
