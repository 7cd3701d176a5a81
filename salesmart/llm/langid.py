"""Language identification with a byte convolutional network.

Texts are cut into fixed windows of UTF-8 bytes. A numpy network (several filter
widths, max pooling, softmax) is trained on windows of a bounded sample of labelled
documents and applied to every window of every text, in batches; a document takes
the language of the highest mean log-probability over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.convnet import ConvNet
from salesmart.llm.shared import slices

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    net: ConvNet
    languages: tuple[str, ...]
    window: int


def windows_of(text: str, window: int) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // window))
    out = np.zeros(rows * window, np.uint8)
    out[: len(data)] = data
    return out.reshape(rows, window)


def by_language(able: DataFrame, most_docs: int, least_docs: int) -> DataFrame:
    """About ``most_docs`` rows of the smallest id hashes, and of each language ``least_docs`` at least, or all it has.

    The cuts follow from one count by language, so no language is missed for being rare.
    """
    counts = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    whole = sum(counts.values())
    part = {lang: max(most_docs / whole, least_docs / n) for lang, n in counts.items()}
    cuts = {lang: -(2**63) + int(2**64 * share) for lang, share in part.items() if share < 1}
    if not cuts:
        return able
    cut = F.create_map(*[x for lang, at in cuts.items() for x in (F.lit(lang), F.lit(at))])
    return able.filter(F.coalesce(F.xxhash64("doc_id") < F.try_element_at(cut, F.col("lang")), F.lit(True)))


def training_windows(docs: DataFrame, chosen: Column, most_docs: int, least_docs: int, window: int, each: int) -> list:
    """(lang, windows as bytes) of a sample of labelled documents, ``each`` windows at most of one."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for lang, text, order in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = windows_of(text, window)
                picked = rows[np.unique(np.linspace(0, len(rows) - 1, each).astype(int))]
                out.append((lang, picked.tobytes(), order))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "windows", "order"])

    able = docs.filter(chosen & F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = by_language(able, most_docs, least_docs).select("lang", "text", F.xxhash64("doc_id").alias("order"))
    return sorted(picked.mapInArrow(run, "lang string, windows binary, order bigint").collect(), key=lambda r: (r["order"], bytes(r["windows"])))


def train(docs: DataFrame, chosen: Column, most_docs: int = 3000, least_docs: int = 100, window: int = 256, each: int = 3, epochs: int = 4) -> LanguageModel | None:
    """A model of the documents in ``chosen``; None when none has a text and a language.

    The labelled sample is bounded: ``most_docs`` documents are expected in it, those of the smallest id hashes, and
    ``least_docs`` more at most of a rare language.
    """
    sample = training_windows(docs, chosen, most_docs, least_docs, window, each)
    if not sample:
        return None
    languages = tuple(sorted({r["lang"] for r in sample}))
    at = {x: k for k, x in enumerate(languages)}
    rows = [np.frombuffer(bytes(r["windows"]), np.uint8).reshape(-1, window) for r in sample]
    labels = np.repeat([at[r["lang"]] for r in sample], [len(x) for x in rows])
    data = np.concatenate(rows).astype(np.int64)
    share = np.bincount(labels, minlength=len(languages)) / len(labels)
    weight = (1 / np.sqrt(share))[labels].astype(np.float32)
    net, rng = ConvNet(256, 8, (2, 3, 4), 8, len(languages)), np.random.default_rng(1)
    batch = 64
    for epoch in range(max(epochs, -(-1200 * batch // len(labels)) if len(labels) < 300 * batch else epochs)):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            net.step(data[part], labels[part], weight[part], 0.005 if epoch else 0.01, 1e-5)
    return LanguageModel(net.trained(), languages, window)


def predictions(model: LanguageModel, texts: list[str], together: int = 512) -> Iterator[tuple[str, float]]:
    """Language and its probability for each text."""
    rows = [windows_of(t, model.window) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
    every = np.concatenate(rows) if rows else np.empty((0, model.window), np.uint8)
    total, bytes_in = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for start in range(0, len(every), together):
        part, own = every[start : start + together], owner[start : start + together]
        size = np.count_nonzero(part, axis=1)
        np.add.at(total, own, model.net.log_probabilities(model.net.pooled(part)) * size[:, None])
        np.add.at(bytes_in, own, size)
    mean = total / np.maximum(bytes_in, 1)[:, None]
    for row in mean:
        p = np.exp(row - row.max())
        yield model.languages[int(row.argmax())], float(p.max() / p.sum())


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every document, from its whole text alone.

    A text that is null or has no letter, and any text when there is no model, gives
    ``und`` with score 0. Repeated rows are answered each, null ids stay null. Very long texts are read whole, window
    by window; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, so other columns may have any names.
    """

    def run(batches):
        for batch in slices(batches, 128):
            texts = batch.column(1).to_pylist()
            able = [k for k, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for k, (lang, score) in zip(able, predictions(model, [texts[k] for k in able]) if able else (), strict=True):
                langs[k], scores[k] = lang, score
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
