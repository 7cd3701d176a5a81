"""Quality classifier with hierarchical empirical Bayes.

Evidence of a document: log-odds from a logistic model of simple text measures, fitted
in numpy on a bounded sample of labelled documents. Evidence is combined with where the
document comes from: the share of good documents of its host (``source``) and of its
path (host and language section). Hosts are shrunk toward the global share and paths
toward their host, as far as the spread between groups tells (method of moments), so
sparse sites lean on their parents. Sites are aggregated as sums; the small table of
sites is stored, and Spark decides by its size how to join it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import freed, hash_sample, slices
from salesmart.storage import materialize

#: By code point (the last entry stands for all above): 1 letter, 2 capital, 4 white space, 8 symbol that does not end a clause.
KINDS = np.array([c.isalpha() + 2 * c.isupper() + 4 * c.isspace() + 8 * (not c.isalnum() and not c.isspace() and c not in ".,;:)]}\"'»”’-_") for c in map(chr, range(0x3000))] + [1], np.uint8)
LIMIT = 12.0


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    offset: float
    center: np.ndarray
    scale: np.ndarray
    base: float  # log-odds of a good document in the sample


def measures(text: str | None) -> list[float]:
    """Shares in 0 to 1 that do not depend on the language."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 10 + [1.0, 0.0]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = KINDS[np.minimum(codes, len(KINDS) - 1)]
    letters = np.count_nonzero(kinds & 1)
    pairs = (kinds[1:] & kinds[:-1] & 8) > 0
    symbols = np.count_nonzero(pairs[:-1] & ((kinds[2:] & 4) > 0)) + bool(len(pairs) and pairs[-1])
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    first = max(counts.values())
    adjoining = sum(map(str.__eq__, words, words[1:]))
    bars = counts["|"]
    return [
        bars / n, min(1.0, 10 * bars / n), symbols / n, min(1.0, 5 * symbols / n), adjoining / n, min(1.0, 5 * adjoining / n),
        first / n if n >= 20 else 0.0, 1 - len(set(lines)) / max(1, len(lines)), np.count_nonzero(kinds & 2) / max(1, letters), 1 - letters / len(codes),
        len(counts) / n if n >= 20 else 0.8, min(1.0, n / 20),
    ]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 1.0) -> QualityModel:
    """Logistic regression by Newton steps."""
    center, scale = x.mean(0), x.std(0) + 1e-3
    z = np.column_stack([np.clip((x - center) / scale, -6, 6), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    return QualityModel(w[:-1], float(w[-1]), center, scale, float(np.log(share / (1 - share))))


def evidence_of(model: QualityModel | None, texts: list[str | None]) -> np.ndarray:
    """Log-likelihood ratio of good against bad; 0 without a model."""
    if model is None or not texts:
        return np.zeros(len(texts))
    x = np.array([measures(t) for t in texts])
    return np.clip(np.clip((x - model.center) / model.scale, -6, 6) @ model.weights + model.offset - model.base, -LIMIT, LIMIT)


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> QualityModel | None:
    """A model from about ``most`` labelled documents (of the smallest id hashes) at most; None when a class is missing."""
    truth = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("_quality"))
    picked = hash_sample(materialize(truth, "labelled"), "_id", most).collect()
    if not picked:
        return None
    small = F.broadcast(docs.sparkSession.createDataFrame(picked, truth.schema))  # about ``most`` rows at most

    def run(batches):
        for batch in slices(batches):
            x = [measures(t) for t in batch.column(1).to_pylist()]
            if x:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["quality", "x"])

    docs = docs.select("doc_id", "text")
    rows = docs.join(small, docs["doc_id"] == small["_id"]).select("_quality", "text").mapInArrow(freed(run), "quality int, x array<double>").collect()
    rows.sort(key=lambda r: (r["x"], r["quality"]))
    y = np.array([r["quality"] for r in rows], float)
    return fit(np.array([r["x"] for r in rows]), y) if 0 < y.sum() < len(y) else None


def with_evidence(rows: DataFrame, model: QualityModel | None) -> DataFrame:
    """``rows`` with ``evidence``. The text is the column ``text``, which is left out, or a field of ``doc``, so that it travels once."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text") if "text" in batch.schema.names else batch.column("doc").field("text")
            evidence = pa.array(evidence_of(model, texts.to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), evidence], names=[*kept, "evidence"])

    return rows.mapInArrow(freed(run), rows.select(*kept, F.lit(0.0).alias("evidence")).schema)


def shrunk(groups: DataFrame, parent: str, out: str, n: str, s: str, least: float = 1.0, most: float = 1e6) -> DataFrame:
    """``groups`` with ``out``, the share s / n pulled toward the column ``parent``.

    The strength of the pull is the method-of-moments estimate of a beta prior around the
    parent: within-group variance over the spread between groups that chance does not explain.
    """
    m = F.col(parent)
    stats = groups.agg(
        F.sum(F.col(n) * m * (1 - m)).alias("within"), F.sum(F.col(n) * (F.col(s) / F.col(n) - m) ** 2).alias("between"),
        F.sum(m * (1 - m)).alias("noise"), F.sum(n).alias("total"),
    ).first()  # one row
    pull = least
    if stats["total"]:
        spread = max(0.0, (stats["between"] - stats["noise"]) / stats["total"])
        pull = min(most, max(least, stats["within"] / stats["total"] / max(spread, 1e-9) - 1))
    return groups.withColumn(out, (F.col(s) + pull * m) / (F.col(n) + pull))


def site_shares(scored: DataFrame, base: float) -> DataFrame:
    """``host, path, host_share, path_share`` from (host, path, evidence) of all documents."""
    good = F.lit(1.0) / (1 + F.exp(-(F.col("evidence") + base)))
    paths = materialize(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("s")), "paths")
    whole = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()  # one row
    share = ((whole["s"] or 0) + 1) / ((whole["n"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), F.sum("s").alias("s_host")).withColumn("all_share", F.lit(share))
    hosts = shrunk(hosts, "all_share", "host_share", "n_host", "s_host")
    below = materialize(paths.join(hosts.select("host", "host_share"), "host"), "paths")
    return materialize(shrunk(below, "host_share", "path_share", "n", "s").select("host", "path", "host_share", "path_share"), "sites")


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.5, most: int = 20_000) -> DataFrame:
    """``doc`` (the row as given), ``evidence``, ``host_share``, ``path_share``, ``p_good`` and ``keep``.

    A document stays when its posterior probability of being good is ``cut`` or more. Null
    sources and languages are sites of their own; a null or empty text is judged as a text
    without words; without labels of both classes everything stays. An empty table gives no rows.
    """
    host = F.coalesce(F.col("source").cast("string"), F.lit(""))
    path = F.concat_ws("/", host, F.coalesce(F.col("lang").cast("string"), F.lit("")))
    model = train(docs, labels, most)
    base = model.base if model else LIMIT
    sites = site_shares(with_evidence(docs.select(host.alias("host"), path.alias("path"), "text"), model), base)
    scored = with_evidence(docs.select(F.struct("*").alias("doc"), host.alias("host"), path.alias("path")), model)
    odds = F.col("evidence") + F.log(F.col("path_share") / (1 - F.col("path_share")))
    p = F.lit(1.0) / (1 + F.exp(-odds))
    return scored.join(sites, ["host", "path"]).select("doc", "evidence", "host_share", "path_share", p.alias("p_good"), (p >= cut).alias("keep"))
