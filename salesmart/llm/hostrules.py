"""Quality rules judged with the help of the host a document comes from.

Every document is measured once; only its few numbers go on. Failures are added up
by host, and each host's failure rate of each rule is pulled toward the corpus rate:
the empirical beta prior has the corpus rate as its mean and a strength that follows
from how much hosts differ beyond chance (analysis of variance of the counts). A host
whose shrunk rate of failing documents reaches ``block`` loses all its documents; one
whose rate under a rule's narrow limit reaches ``watch`` is held to that narrow limit; both
only where the rate is twice that of the corpus, so that no host falls for being usual.
All other documents are held to the wide limits only. Verdicts of hosts are joined
back: only hosts that are not trusted take part in that join.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import WORD, freed, slices
from salesmart.storage import materialize

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)"
LINE_WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Rule:
    """A document fails when ``part`` exceeds so many hundredths of ``whole``."""

    name: str
    part: str
    whole: str
    narrow: int
    wide: int | None  # None: no document fails by itself

    def fails(self, percent: int | None) -> Column:
        return F.lit(False) if percent is None else 100 * F.col(self.part) > percent * F.col(self.whole)


RULES = (
    Rule("symbols", "n_symbols", "n_words", narrow=5, wide=10),
    Rule("dup_lines", "n_dup_lines", "n_lines", narrow=30, wide=50),
    Rule("long_words", "word_chars", "n_words", narrow=1200, wide=None),
    Rule("short_words", "n_words", "word_chars", narrow=40, wide=None),
)


def repeated_words(ids: np.ndarray, size: int = 5) -> int:
    """How many words lie in runs of ``size`` words that the text holds twice or more.

    Runs are numbered exactly, by sorting pairs of shorter runs, so nothing is hashed.
    """
    n = len(ids) - size + 1
    if n < 2:
        return 0
    code, width = ids.astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        joined = code[:-step] * (int(code.max()) + 1) + code[step:]  # runs of width words, step apart
        found, code = np.unique(joined, return_inverse=True)
        width += step
        if len(found) == len(code):
            return 0
    again = np.bincount(code)[code] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + size, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measures(text: str | None) -> tuple[int, ...]:
    """The numbers of ``MEASURES`` for one whole text."""
    text = text or ""
    words = WORD.findall(text)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if LINE_WORD.search(x)]
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids), len(lines)


def measured(docs: DataFrame, *kept: Column) -> DataFrame:
    """The columns ``kept``, ``_host`` (null without a source) and the ``MEASURES`` of each row of ``docs``."""
    host = F.lower(F.regexp_extract(F.trim(F.col("source").cast("string")), HOST, 1))
    rows = docs.select(*kept, F.when(host != "", host).alias("_host"), "text")
    names = [*rows.columns[:-1], *MEASURES]

    def run(batches):
        for batch in slices(batches):
            found = np.array([measures(t) for t in batch.columns[-1].to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found.T)], names=names)

    types = ", ".join(f"{m} bigint" for m in MEASURES)
    schema = docs.sparkSession.createDataFrame([], types).schema
    return rows.mapInArrow(freed(run), type(schema)([*rows.schema.fields[:-1], *schema.fields]))


def base_failed(least_words: int = 10, most_repeated: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def any_of(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def prior(hosts: int, rows: int, squares: float, failed: int, spread: float, least: float, most: float) -> tuple[float, float]:
    """Mean and strength of the beta prior of one rule.

    ``squares`` is the sum of n^2 over hosts, ``spread`` that of failures^2 / n. The strength is
    1 / rho - 1 for the intra-class correlation rho, kept between ``least`` and ``most``;
    hosts that differ no more than by chance take ``most``.
    """
    mean = failed / rows if rows else 0.0
    if hosts < 2 or rows <= hosts:
        return mean, most
    between = (spread - failed * failed / rows) / (hosts - 1)
    within = (failed - spread) / (rows - hosts)
    usual = (rows - squares / rows) / (hosts - 1)
    whole = between + (usual - 1) * within
    rho = (between - within) / whole if whole > 0 else 0.0
    return mean, min(most, max(least, 1 / rho - 1)) if rho > 0 else most


def host_verdicts(rows: DataFrame, block: float = 0.5, watch: float = 0.25, least: float = 1.0, most: float = 1000.0) -> DataFrame:
    """``_host, host_docs, host_rate, host_verdict, watched`` of every host in ``rows`` (as given by ``measured``).

    Failures are summed in the tasks before the shuffle, so a host with a third of all rows is a
    few partial sums. ``watched`` holds the names of the rules whose narrow limit holds there.
    """
    outright = base_failed() | any_of(r.fails(r.wide) for r in RULES)
    counts = {"_failed": outright} | {f"_{r.name}": r.fails(r.narrow) for r in RULES}
    sums = [F.sum(c.cast("bigint")).alias(name) for name, c in counts.items()]
    hosts = materialize(rows.filter(F.col("_host").isNotNull()).groupBy("_host").agg(F.count("*").alias("host_docs"), *sums), "hosts")
    n = F.col("host_docs").cast("double")
    moments = [x for name in counts for x in (F.sum(name).alias(f"sum{name}"), F.sum(F.col(name).cast("double") ** 2 / n).alias(f"spread{name}"))]
    whole = hosts.agg(F.count("*").alias("hosts"), F.sum("host_docs").alias("rows"), F.sum(n * n).alias("squares"), *moments).first()  # one row

    priors = {name: prior(whole["hosts"], whole["rows"] or 0, whole["squares"] or 0.0, whole[f"sum{name}"] or 0, whole[f"spread{name}"] or 0.0, least, most) for name in counts}

    def rate(name: str) -> Column:
        mean, strength = priors[name]
        return F.round((F.col(name) + strength * mean) / (n + strength), 9)

    def reaches(name: str, cut: float) -> Column:
        return rate(name) >= max(cut, 2 * priors[name][0])

    watched = F.filter(F.array(*[F.when(reaches(f"_{r.name}", watch), F.lit(r.name)) for r in RULES]), lambda x: x.isNotNull())
    judged = hosts.select("_host", "host_docs", rate("_failed").alias("host_rate"), reaches("_failed", block).alias("_blocked"), watched.alias("watched"))
    verdict = F.when(F.col("_blocked"), "blocked").when(F.size("watched") > 0, "watched").otherwise("trusted")
    return judged.select("_host", "host_docs", "host_rate", verdict.alias("host_verdict"), "watched")


def with_verdicts(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with ``base_failed``, ``host_verdict`` and ``kept``.

    Hosts that are not trusted are few, so Spark mostly broadcasts them, by their size; where it
    does not, a host with a third of all rows is split by adaptive execution.
    """
    judged = hosts.filter(F.col("host_verdict") != "trusted").select(F.col("_host").alias("_judged_host"), "host_verdict", F.col("watched").alias("_watched"))
    joined = rows.join(judged, F.col("_host") == F.col("_judged_host"), "left")
    narrow = any_of(F.coalesce(F.array_contains("_watched", r.name), F.lit(False)) & r.fails(r.narrow) for r in RULES)
    wide = any_of(r.fails(r.wide) for r in RULES)
    verdict = F.coalesce("host_verdict", F.when(F.col("_host").isNotNull(), "trusted"))
    kept = ~base_failed() & ~wide & ~narrow & ~F.coalesce(verdict == "blocked", F.lit(False))
    return joined.withColumns({"base_failed": base_failed(), "kept": kept, "host_verdict": verdict}).drop("_judged_host", "_watched")


def judge(docs: DataFrame, **limits: float) -> DataFrame:
    """``doc_id``, ``host``, the ``MEASURES``, ``base_failed``, ``host_verdict`` and ``kept`` of every row.

    A null or empty text has no words and fails. A row without a source has no host: it is judged
    by itself, and ``host`` and ``host_verdict`` are null. Null ids and repeated rows are rows like
    others. A very long text is measured whole, in one task. An empty table gives no rows; other
    columns, whatever their names, are not touched.
    """
    rows = materialize(measured(docs, F.col("doc_id")), "measures")
    return with_verdicts(rows, host_verdicts(rows, **limits)).withColumnRenamed("_host", "host")


def keep_documents(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; texts are measured twice and stored nowhere."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    hosts = materialize(host_verdicts(measured(docs), **limits), "host-verdicts")
    return with_verdicts(measured(docs, whole), hosts).filter("kept").select("_doc.*")
