"""Importance resampling toward a target distribution.

Words and pairs of words fall into hash buckets. The logarithm of a bucket's share in the
target texts over its share in the corpus is the bucket's gain, kept in one array; a
document's weight is the mean gain of its features. Gumbel noise that depends on the
document's id alone is added, and the highest scores are drawn: a sample without
replacement in proportion to the weights.

The order comes from a distributed LSD radix sort over the digits of the composite key
(score, id). Rows lie in blocks of equal size. A pass counts digits by block, turns the
counts into global prefix offsets, computes each row's destination from its digit's offset
and its place among equal digits of its block, and moves it there. Every pass is stable,
so after the last digit a row's destination is its final rank.
"""

from __future__ import annotations

import hashlib
import math
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import slices
from salesmart.storage import materialize

BUCKETS = 10_000
#: Bytes 0x30 to 0x39, a to z and all above 0x7F make words; capitals count as small letters, all else separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LOWEST = -(2**63)


def features(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of every word and of every two words in a row joined by a space."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    n = len(words)
    out = np.empty(max(0, 2 * n - 1), np.int64)
    first = list(map(crc32, words))
    out[:n] = first
    out[n:] = list(map(crc32, words[1:], map(crc32, repeat(b" "), first[:-1])))
    return n, out


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. A task adds up all its texts first, so ``buckets`` rows at most leave it."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts += np.bincount(features(text)[1] % buckets, minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares of each bucket."""
    whole, wanted, n = int(corpus.sum()), int(target.sum()), len(corpus)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(whole + n) / (float(s + 1) * float(wanted + n)))) for s, t in pairs], np.int64)


def noise(seed: int, doc: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 7) -> DataFrame:
    """``row`` (task and place, unique), ``shard``, ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` of each row."""

    def run(batches):
        shard, place = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, codes = features(text)
                weight = int(gain[codes % len(gain)].sum()) // len(codes) if n else 0
                rows.append(((shard << 40) + place, shard, doc, n, len(codes), weight, weight + noise(seed, doc)))
                place += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=NAMES)

    NAMES = ["row", "shard", "doc_id", "n_words", "n_features", "weight", "score"]
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ", ".join(f"{c} bigint" for c in NAMES))


def digit(column: str, shift: int, bits: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def digits_of(low: int, high: int, most: int) -> list[tuple[int, int]]:
    """(shift, bits) of the digits that differ between two unsigned keys, lowest first, of up to ``most`` bits."""
    whole = ((low ^ high) & (2**64 - 1)).bit_length()
    passes = -(-whole // most)
    bits = -(-whole // passes) if passes else 0
    return [(k * bits, min(bits, 64 - k * bits)) for k in range(passes)]


def offsets(rows: DataFrame, column: str, shift: int, bits: int) -> DataFrame:
    """``block``, and for each digit met there where its first row goes: prefix sums over digits, then over blocks."""
    counts = rows.groupBy("block", digit(column, shift, bits).alias("digit")).agg(F.count("*").alias("n"))
    counts = materialize(counts, "digit-counts")
    before = {}
    total = 0
    for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).orderBy("digit").collect():  # at most 2^bits rows
        before[r["digit"]] = total
        total += r["n"]
    starts = rows.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "digit int, start bigint")
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return counts.join(F.broadcast(starts), "digit").select("block", "digit", (F.col("start") + F.col("earlier")).alias("base"))


def radix_pass(rows: DataFrame, column: str, shift: int, bits: int, size: int) -> DataFrame:
    """One stable counting-sort pass: the rows of each block, in their order, go to the places their digits' offsets name."""
    schema = rows.schema
    names = rows.columns

    def move(mine: pa.Table, bases: pa.Table) -> pa.Table:
        place = mine.column("place").to_numpy()
        order = np.empty(len(place), np.int64)
        order[place - place.min()] = np.arange(len(place))  # a block holds consecutive places, each once
        keys = mine.column(column).to_numpy()[order].view(np.uint64)
        digits = ((keys >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        base = np.zeros(1 << bits, np.int64)
        base[bases.column("digit").to_numpy()] = bases.column("base").to_numpy()
        by_digit = np.argsort(digits.astype(np.uint16), kind="stable")  # a counting sort for 16 bits
        counts = np.bincount(digits, minlength=1 << bits)
        within = np.arange(len(digits)) - (np.cumsum(counts) - counts)[digits[by_digit]]
        target = np.empty(len(digits), np.int64)
        target[by_digit] = base[digits[by_digit]] + within
        new = {"block": target // size, "place": target}
        return pa.table([pa.array(new[c]) if c in new else mine.column(c).take(order) for c in names], names=names)

    return rows.groupBy("block").cogroup(offsets(rows, column, shift, bits).groupBy("block")).applyInArrow(move, schema)


def radix_ranked(rows: DataFrame, keys: list[str], block_rows: int = 1 << 18, digit_bits: int = 11) -> DataFrame:
    """``rows`` (a stored table of ``row``, ``shard`` and bigint ``keys``) with ``rank`` from 1: by the unsigned keys, first one first, then as stored.

    Blocks hold up to ``block_rows`` rows, and are as many as shuffle partitions at least.
    """
    spark = rows.sparkSession
    ends = rows.agg(F.count("*").alias("n"), *[f(F.col(k).bitwiseXOR(F.lit(LOWEST))).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max))]).first()
    per_shard = rows.groupBy("shard").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row for each task
    starts = per_shard.select(F.col("shard").alias("_shard"), F.coalesce(earlier, F.lit(0)).alias("_start"))
    size = max(1, min(block_rows, -(-ends["n"] // max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    within = F.row_number().over(Window.partitionBy("shard").orderBy("row")) - 1
    placed = rows.withColumn("_within", within).join(F.broadcast(starts), F.col("shard") == F.col("_shard"))
    placed = placed.select("row", *keys, (F.col("_start") + F.col("_within")).alias("place"))
    now = materialize(placed.select((F.expr(f"place div {size}")).alias("block"), "place", "row", *keys), "radix")
    for key in reversed(keys):
        for shift, bits in digits_of(ends[f"low_{key}"] or 0, ends[f"high_{key}"] or 0, digit_bits):
            now = materialize(radix_pass(now, key, shift, bits, size), "radix")
    return now.select("row", (F.col("place") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null where it is not drawn.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn: the highest scores,
    ties to smaller ids, then in the order of the table; rows without an id come behind all others. Null and
    empty texts have no features and weight 0. Repeated rows take part each. Very long texts are counted
    whole, in one task. Empty tables give no rows, an empty target gives the gains of no evidence. Only ``doc_id``
    and ``text`` are read, so other columns may have any names.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = materialize(scored(docs, gain, seed), "scored")
    able = rows.filter(F.col("n_words") >= least_words)
    keys = able.select("row", "shard", F.bitwise_not("score").bitwiseXOR(F.lit(LOWEST)).alias("by_score"), F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).bitwiseXOR(F.lit(LOWEST)).alias("by_id"))
    keys = materialize(keys, "radix-keys")
    drawn = percent * keys.count() // 100
    ranks = radix_ranked(keys, ["by_score", "by_id"]).filter(F.col("rank") <= drawn)
    return rows.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"))
