"""Toxicity scores from a convolutional text classifier.

Words are hashed to embeddings, rare ones by their first letters; filters of several widths slide over the whole text
and each keeps its three largest responses after max pooling over short stretches;
a softmax layer gives the probability. The
network is trained in numpy on all labelled documents: they are dealt into shards of
about ``SHARD`` words, each shard trains a copy of the network in a task of its own, and
after each round Spark averages the copies. Word counts come from all of them too. Decision
thresholds are calibrated for each language on the fifth of the labelled documents that
training leaves out; the language is recognised from the words of the text itself,
never read from a column. A score is the probability rescaled so that the threshold
of its language falls on ``cut``.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.convnet import ConvNet
from salesmart.llm.shared import WordHashes, freed, slices
from salesmart.storage import materialize

#: Buckets of words, and as many of stems (the first letters of a word).
BUCKETS, STEM = 1 << 16, 5
TOKEN = re.compile(r"\w+")
#: Words of a text that go through the network at once; neighbours overlap by the widest filter less one.
CHUNK = 2048
#: Words of a shard (about), words of a training batch with its padding (or one text), probabilities told apart by calibration, documents of either class for a threshold of its own.
SHARD, BATCH, BINS, ENOUGH = 1_000_000, 1 << 16, 10_000, 10


@dataclass(frozen=True)
class ToxicityModel:
    net: ConvNet
    known: np.ndarray  # bucket of a word, or BUCKETS + that of a stem -> symbol of the network; 1 for those that are too rare
    language_words: np.ndarray  # bucket x language: log-probabilities
    thresholds: np.ndarray  # by language


class WordsAndStems(WordHashes):
    """The bucket of a word times ``BUCKETS``, and the bucket of its stem."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        of_word, of_stem = (xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in (word, f"{word[:STEM]}*"))
        self[word] = of_word * BUCKETS + of_stem
        return self[word]


def buckets(text: str | None, hashes: WordsAndStems) -> np.ndarray:
    return hashes.of(TOKEN.findall((text or "").lower())).astype(np.uint32)


def features(ids: np.ndarray) -> np.ndarray:
    """The distinct word buckets and ``BUCKETS`` + stem buckets of a text."""
    return np.concatenate([np.unique(ids >> 16), np.unique(ids & 0xFFFF) + BUCKETS])


def symbols(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """What the network reads for each word: the word, or its stem if the word is rare."""
    words = known[ids >> 16]
    return np.where(words > 1, words, known[(ids & 0xFFFF) + BUCKETS])


def labelled(docs: DataFrame, labels: DataFrame, chosen: Column) -> DataFrame:
    """``toxic, lang, ids, words, order, checked`` of every labelled document that has words; ``ids`` are 32-bit bucket ids.

    A document with several labels is toxic if one says so. ``checked`` marks about a fifth of the documents, by id.
    """

    def run(batches):
        hashes = WordsAndStems()
        for batch in slices(batches):
            toxic, lang, text, order, checked = batch.columns
            ids = [buckets(t, hashes) for t in text.to_pylist()]
            words = pa.array([len(x) for x in ids], pa.int64())
            out = pa.RecordBatch.from_arrays([toxic, lang, pa.array([x.tobytes() for x in ids], pa.binary()), words, order, checked], names=["toxic", "lang", "ids", "words", "order", "checked"])
            yield out.filter(pa.array([len(x) > 0 for x in ids], pa.bool_()))

    truth = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_label_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    able = docs.filter(chosen & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    rows = able.join(truth, able["doc_id"] == truth["_label_id"])
    order = F.xxhash64("doc_id")
    rows = rows.select("_toxic", "lang", "text", order.alias("order"), (F.pmod(order, F.lit(5)) == 0).alias("checked"))
    return materialize(rows.mapInArrow(freed(run), "toxic int, lang string, ids binary, words bigint, order bigint, checked boolean"), "labelled")


def bucket_counts(rows: DataFrame) -> pa.Table:
    """How many documents hold each word or stem, by ``toxic`` and ``checked`` (``lang`` null), and how often each language has a word (``toxic`` null)."""
    names, types = ["toxic", "checked", "lang", "bucket", "n"], [pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.int64()]

    def run(batches):
        counts: dict[tuple, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for key, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([*(pa.array([x] * len(at), t) for x, t in zip(key, types)), pa.array(at, pa.int32()), pa.array(n[at])], names=names)
            counts.clear()

        def of(*key) -> np.ndarray:
            return counts.setdefault(key, np.zeros(2 * BUCKETS, np.int64))

        for batch in batches:
            for toxic, lang, ids, checked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(ids, "<u4")
                of(toxic, checked, None)[features(x)] += 1
                if lang is not None:
                    np.add.at(of(None, None, lang), x >> 16, 1)
            if len(counts) > 200:
                yield from flushed()
        yield from flushed()

    each = rows.select("toxic", "lang", "ids", "checked").mapInArrow(freed(run), "toxic int, checked boolean, lang string, bucket int, n bigint")
    return each.groupBy("toxic", "checked", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # a row for each bucket at most, by language and class


def padded(ids: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(ids), max(map(len, ids))), np.int64)
    for row, x in zip(out, ids, strict=True):
        row[: len(x)] = x
    return out


def packed(net: ConvNet) -> np.ndarray:
    """All numbers of a network in training, one after the other: parameters and both moments."""
    return np.concatenate([x.ravel() for k in PARAMETERS for x in (getattr(net, k), *net.moments[k])])


def unpack(net: ConvNet, numbers: np.ndarray) -> None:
    at = 0
    for k in PARAMETERS:
        for x in (getattr(net, k), *net.moments[k]):
            x[...] = numbers[at : at + x.size].reshape(x.shape)
            at += x.size


PARAMETERS = ("embedding", "weights", "bias", "head", "offset")


def sweep(net: ConvNet, ids: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float, decay: float, rng: np.random.Generator) -> None:
    """One pass of training over some documents; those of like length share a batch."""
    order = rng.permutation(len(y))
    for start in range(0, len(order), 512):
        batches: list[list[int]] = [[]]
        for k in sorted(order[start : start + 512].tolist(), key=lambda k: len(ids[k])):
            if len(batches[-1]) == 16 or batches[-1] and (len(batches[-1]) + 1) * len(ids[k]) > BATCH:
                batches.append([])
            batches[-1].append(k)
        for part in (batches[k] for k in rng.permutation(len(batches))):
            net.step(padded([ids[k] for k in part]), y[part], weight[y[part]], rate, decay)


def averaged_round(rows: DataFrame, net: ConvNet, known: np.ndarray, weight: np.ndarray, rate: float, decay: float, seed: int, piece: int = 4096) -> None:
    """Every shard of ``rows`` trains a copy of ``net``; ``net`` becomes the copies' mean, weighted by documents."""

    def run(shard: tuple, table: pa.Table) -> pa.Table:
        mine = copy.deepcopy(net)
        table = table.sort_by([("order", "ascending"), ("ids", "ascending")])
        ids = [symbols(np.frombuffer(x, "<u4"), known) for x in table.column("ids").to_pylist()]
        sweep(mine, ids, table.column("toxic").to_numpy().astype(np.int64), weight, rate, decay, np.random.default_rng([seed, shard[0].as_py()]))
        numbers = packed(mine)
        parts = [numbers[k : k + piece].astype("<f4").tobytes() for k in range(0, len(numbers), piece)]
        return pa.table({"part": pa.array(range(len(parts)), pa.int32()), "shard": [shard[0].as_py()] * len(parts), "n": [len(ids)] * len(parts), "steps": [mine.steps] * len(parts), "numbers": pa.array(parts, pa.binary())})

    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        n = table.column("n").to_numpy().astype(np.float64)
        total = sum(k * np.frombuffer(x.as_buffer(), "<f4").astype(np.float64) for k, x in zip(n, table.column("numbers"), strict=True))
        return pa.table({"part": table.column("part").slice(0, 1), "steps": [max(table.column("steps").to_pylist())], "numbers": pa.array([(total / n.sum()).astype("<f4").tobytes()], pa.binary())})

    copies = rows.select("shard", "toxic", "ids", "order").groupBy("shard").applyInArrow(run, "part int, shard bigint, n bigint, steps bigint, numbers binary")
    found = copies.groupBy("part").applyInArrow(mean, "part int, steps bigint, numbers binary").collect()  # one network
    if found:
        unpack(net, np.frombuffer(b"".join(bytes(r["numbers"]) for r in sorted(found, key=lambda r: r["part"])), "<f4"))
        net.steps = max(r["steps"] for r in found)


def judged(rows: DataFrame, model: ToxicityModel) -> pa.Table:
    """``toxic, lang, bin, n``: how many documents of each class and recognised language have which probability, in ``BINS`` steps."""

    def run(batches):
        for batch in slices(batches):
            p, lang = probabilities(model, [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang.astype(np.int32)), pa.array(np.rint(p * BINS).astype(np.int32))], names=["toxic", "lang", "bin"])

    return rows.select("toxic", "ids").mapInArrow(freed(run), "toxic int, lang int, bin int").groupBy("toxic", "lang", "bin").agg(F.count("*").alias("n")).toArrow()


def train(docs: DataFrame, labels: DataFrame, chosen: Column, least_docs: int = 4, presentations: int = 24_000, decay: float = 1e-4, filters: int = 12) -> ToxicityModel | None:
    """A model of all labelled documents in ``chosen``, whatever their length; None when a class is missing.

    Documents are swept 12 times, or less often (but twice) when there are more than ``presentations`` in 12 sweeps.
    Words and stems in fewer than ``least_docs`` documents (or half a percent of either class) are too rare.
    """
    rows = labelled(docs, labels, chosen)
    sizes = rows.groupBy("toxic", "checked").agg(F.count("*").alias("n"), F.sum("words").alias("words")).collect()
    of_class = np.array([sum(r["n"] for r in sizes if r["toxic"] == k) for k in (0, 1)])
    if not of_class.all():
        return None
    found = bucket_counts(rows)
    toxic, checked, bucket, n = (found.column(c).to_numpy() for c in ("toxic", "checked", "bucket", "n"))
    spoken = found.column("lang").to_pylist()
    langs = sorted({x for x in spoken if x is not None}) or [""]
    in_docs, hits, counts = np.zeros((2, 2 * BUCKETS)), np.zeros((2, 2 * BUCKETS)), np.full((BUCKETS, len(langs)), 0.1)
    for k in (0, 1):
        np.add.at(in_docs[k], bucket[toxic == k], n[toxic == k])
        use = (toxic == k) & (checked == False)  # noqa: E712
        np.add.at(hits[k], bucket[use], n[use])
    place = {x: k for k, x in enumerate(langs)}
    column = np.array([place.get(x, -1) for x in spoken])
    counts[bucket[column >= 0], column[column >= 0]] += n[column >= 0]
    language_words = np.log(counts / counts.sum(0)).astype(np.float32)
    often = np.flatnonzero((in_docs.sum(0) >= least_docs) & (in_docs >= of_class[:, None] // 200).any(0))
    known = np.ones(2 * BUCKETS, np.int32)
    known[often] = np.arange(2, 2 + len(often))

    docs_used, words = (sum(r[c] for r in sizes if not r["checked"]) for c in ("n", "words"))
    share = np.array([sum(r["n"] for r in sizes if not r["checked"] and r["toxic"] == k) for k in (0, 1)]) / max(1, docs_used)
    weight = np.sqrt(0.5 / np.maximum(share, 1e-9)).astype(np.float32)
    net = ConvNet(2 + len(often), 16, (1, 2, 3), filters, 2, top=3, stretch=16)
    # A word or stem starts at how far its documents depart from the classes' shares, in standard deviations.
    expected = hits.sum(0) * share[1]
    net.embedding *= 0.2
    net.embedding[2:, 0] = np.clip((hits[1] - expected) / np.sqrt(expected * share[0] + 1), -4, 12)[often] / 4
    net.moments, net.steps = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in PARAMETERS}, 0
    shards = -(-words // SHARD)
    turns = min(4, shards)  # rounds of a sweep
    dealt = rows.filter(~F.col("checked")).withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)))
    apart = rows.filter("checked")

    best, lowest = copy.deepcopy(net), np.inf
    sweeps = min(12, max(2, -(-presentations // max(1, docs_used))))
    for k in range(sweeps if docs_used else 0):
        for turn in range(turns):
            some = dealt.filter(F.col("shard") % turns == turn)
            averaged_round(some, net, known, weight, 0.01 if k < sweeps // 2 else 0.003, decay, k * turns + turn)
        seen = judged(apart, ToxicityModel(net, known, language_words, np.zeros(0)))
        y, p = seen.column("toxic").to_numpy(), seen.column("bin").to_numpy() / BINS
        loss = -(weight[y] * np.log(np.maximum(np.where(y == 1, p, 1 - p), 1e-6)) * seen.column("n").to_numpy()).sum()
        if loss < lowest or not len(y):  # labels hold errors; later sweeps learn them by heart
            best, lowest, calibration = copy.deepcopy(net), loss, seen
    if not docs_used:
        calibration = judged(apart, ToxicityModel(best, known, language_words, np.zeros(0)))
    at, y, lang, n = (calibration.column(c).to_numpy() for c in ("bin", "toxic", "lang", "n"))
    tables = np.zeros((len(langs), 2, BINS + 1), np.int64)
    np.add.at(tables, (lang, y, at), n)
    thresholds = np.array([border(t if t.sum(1).min() >= ENOUGH else tables.sum(0)) for t in tables])
    return ToxicityModel(best.trained(), known, language_words, thresholds)


def border(counts: np.ndarray) -> float:
    """The threshold of the fewest class-weighted errors, in the middle of its gap and within 0.2 to 0.9; ``counts`` by class and probability in ``BINS`` steps.

    It is drawn towards one half as long as toxic documents are few.
    """
    if not counts.sum(1).all():
        return 0.5
    met = np.flatnonzero(counts.sum(0))
    clean, toxic = counts[:, met]
    missed = np.concatenate([[0], np.cumsum(toxic)]) / toxic.sum()
    false = 1 - np.concatenate([[0], np.cumsum(clean)]) / clean.sum()
    cost = missed + 2 * false
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    edges = np.concatenate([[0.0], met / BINS, [1.0]])
    widest = max(best.tolist(), key=lambda k: edges[k + 1] - edges[k])
    found, sure = np.clip((edges[widest] + edges[widest + 1]) / 2, 0.2, 0.9), toxic.sum() / (toxic.sum() + 2 * ENOUGH)
    return float(sure * found + (1 - sure) * 0.5)


def probabilities(model: ToxicityModel, raw: list[np.ndarray], together: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Probability of toxicity and recognised language of each text (its bucket ids)."""
    step = CHUNK - model.net.widest + 1
    chunks = [(k, symbols(x[at : at + CHUNK], model.known)) for k, x in enumerate(raw) for at in range(0, max(1, len(x) - model.net.widest + 1), step)]
    chunks.sort(key=lambda c: len(c[1]))
    pooled = np.zeros((len(raw), model.net.top, model.net.weights.shape[1]), np.float32)
    for start in range(0, len(chunks), together):
        part = chunks[start : start + together]
        ids = padded([c[1] for c in part])
        ids = ids if ids.shape[1] else np.zeros((len(part), 1), np.int64)
        for (k, _), found in zip(part, model.net.pooled(ids), strict=True):
            pooled[k] = model.net.strongest(np.concatenate([pooled[k], found])[None])[0]
    lang = np.array([int(model.language_words[x >> 16].sum(0).argmax()) for x in raw], np.int64)
    return np.exp(model.net.log_probabilities(pooled)[:, 1].astype(np.float64)), lang


def score(docs: DataFrame, model: ToxicityModel | None, cut: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for every document, from its whole text alone.

    ``score`` is in 0 to 1 and ``predicted`` is 1 from ``cut`` on. A null or empty text is
    scored as a text without words; without a model all scores are 0. Repeated rows are
    answered each, null ids stay null.
    """

    def run(batches):
        hashes = WordsAndStems()
        for batch in slices(batches, 128):
            scores = np.zeros(batch.num_rows)
            if model and batch.num_rows:
                p, lang = probabilities(model, [buckets(t, hashes) for t in batch.column(1).to_pylist()])
                t = model.thresholds[lang]
                scores = np.clip(np.where(p < t, cut * p / t, cut + (1 - cut) * (p - t) / (1 - t)), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= cut).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(freed(run), "doc_id bigint, score double, predicted int")
