"""Substring deduplication by hashed windows that are grouped under anchor words.

This is not the Lempel-Ziv factoring its first version was named for: no longest match
is sought and no factor extended. What has to be removed is every window of 20 words
that starts earlier in the corpus too, and one lookup per window says just that, whatever
factors a parse would choose.

Every document is cut into phrases at anchor words: the grams of ``GRAM`` words with the
smallest hash among their neighbours, so equal passages are cut alike. A phrase holds
the consecutive 20-word windows that share an anchor. Phrases are dealt out by anchor and
sorted in corpus order; under each anchor the hash of every window is looked up among
those before. Adjoining repeated windows join up to spans of repeated words.

Phrases that a task meets again whole are settled there, before the shuffle, so copies
send one row per task. Anchors that hold an outstanding share of all phrases (a common
line amid different text) are found by a first pass; their phrases are cut into single
windows and dealt out by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import WORD, TextHashes, gram_hashes, mixed, signed, slices
from salesmart.storage import materialize

#: Below every id: rows without an id form one document that comes first.
NO_ID = -(2**63)
GRAM = 6
#: Words whose phrases are settled together inside a task.
CHUNK_WORDS = 2_000_000
#: An anchor with more than this share of all phrases is cut into windows; at most 1 / SHARE anchors can have it.
SHARE = 1 / 10_000
#: Bytes of a window's hash that are kept beside the 64 bits of its anchor.
KEPT = 6
PHRASES = "anchor bigint, doc bigint, row bigint, first int, last int, windows binary"
SPANS = "doc bigint, row bigint, first int, last int"


def anchors_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The anchor of every window: the smallest hash of the grams inside it."""
    n = len(hashes) - size + 1
    grams = gram_hashes(hashes, GRAM)
    least = grams[:n].copy()
    for k in range(1, size - GRAM + 1):
        np.minimum(least, grams[k : k + n], out=least)
    return least


def phrases_of(hashes: np.ndarray, size: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window of each phrase, and the hashes of all windows; ``hot`` is sorted."""
    windows, least = gram_hashes(hashes, size), anchors_of(hashes, size)
    new = np.concatenate([[True], least[1:] != least[:-1]])
    if len(hot):
        single = hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least
        least = np.where(single, mixed(least ^ windows), least)
        new |= single
    if len(np.unique(windows)) < len(windows):  # a phrase that repeats a window of its own is cut into windows
        phrase = np.cumsum(new)
        order = np.lexsort((windows, phrase))
        twice = (phrase[order][1:] == phrase[order][:-1]) & (windows[order][1:] == windows[order][:-1])
        new |= np.isin(phrase, phrase[order][1:][twice])
    firsts = np.flatnonzero(new)
    lasts = np.concatenate([firsts[1:], [len(windows)]]) - 1
    return least[firsts], firsts, lasts, windows


def joined_spans(starts: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining stretches of the same owner as one; inputs are sorted."""
    new = np.concatenate([[True], (starts[1:] != starts[:-1]) | (firsts[1:] != lasts[:-1] + 1)])
    at = np.flatnonzero(new)
    ends = np.concatenate([at[1:], [len(starts)]]) - 1
    return starts[at], firsts[at], lasts[ends]


class Chunk:
    """Phrases of the documents read last by a task."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.docs: list[tuple[int, int]] = []
        self.words = 0

    def add(self, doc: int, row: int, hashes: np.ndarray, size: int, hot: np.ndarray) -> None:
        self.words += len(hashes)
        if len(hashes) >= size:
            anchors, firsts, lasts, windows = phrases_of(hashes, size, hot)
            whole = np.add.reduceat(mixed(windows + np.uint64(0x9E3779B97F4A7C15) * (np.arange(len(windows)) - np.repeat(firsts, lasts - firsts + 1)).astype(np.uint64)), firsts)
            self.parts.append((np.full(len(anchors), len(self.docs)), anchors, firsts, lasts, mixed(whole ^ anchors) + (lasts - firsts).astype(np.uint64), windows))
            self.docs.append((doc, row))

    def rows(self) -> pa.RecordBatch | None:
        """Spans that repeat inside the chunk (without windows), and the other phrases with their windows."""
        if not self.parts:
            return None
        docs = np.array(self.docs, np.int64)
        offsets = np.cumsum([0] + [len(p[5]) for p in self.parts])
        owner, anchors, firsts, lasts, whole = (np.concatenate([p[k] for p in self.parts]) for k in range(5))
        windows = np.concatenate([p[5] for p in self.parts])
        place = np.lexsort((firsts, docs[owner, 0], whole))
        same = np.concatenate([[False], whole[place][1:] == whole[place][:-1]])
        # A later place of an equal phrase repeats the first one of its group, unless both start at the same place of one id.
        group = np.maximum.accumulate(np.where(same, 0, np.arange(len(place))))
        head = place[group]
        repeats = np.zeros(len(place), bool)
        repeats[place] = same & ((docs[owner[place], 0] != docs[owner[head], 0]) | (firsts[place] != firsts[head]))
        again = np.zeros(len(place), bool)
        again[place] = same
        spans = joined_spans(owner[repeats], firsts[repeats], lasts[repeats]) if repeats.any() else (np.empty(0, np.int64),) * 3
        first_rows = np.flatnonzero(~again | ~repeats)
        begin = offsets[owner[first_rows]] + firsts[first_rows]
        lengths = lasts[first_rows] - firsts[first_rows] + 1
        raw = windows.view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()
        blobs = [None] * len(spans[0]) + [raw[KEPT * b : KEPT * (b + n)] for b, n in zip(begin.tolist(), lengths.tolist(), strict=True)]
        own = np.concatenate([spans[0], owner[first_rows]]).astype(np.int64)
        keys = np.concatenate([mixed(docs[spans[0], 0].view(np.uint64)) if len(spans[0]) else np.empty(0, np.uint64), anchors[first_rows]])
        columns = [signed(keys), docs[own, 0], docs[own, 1], np.concatenate([spans[1], firsts[first_rows]]).astype(np.int32), np.concatenate([spans[2], lasts[first_rows]]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(blobs, pa.binary())], names=["anchor", "doc", "row", "first", "last", "windows"])


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("row"), "text")


def hot_anchors(docs: DataFrame, size: int) -> np.ndarray:
    """Anchors with more than ``SHARE`` of all phrases, counted by each task among its distinct phrases."""

    def run(batches):
        known = TextHashes()
        counts: list[np.ndarray] = []
        phrases = 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                hashes = known.of((text or "").encode("utf-8"))
                if len(hashes) >= size:
                    least = anchors_of(hashes, size)
                    counts.append(least[np.concatenate([[True], least[1:] != least[:-1]])])
                    phrases += len(counts[-1])
            if phrases >= CHUNK_WORDS // 8:
                yield counted(counts)
                counts, phrases = [], 0
        if phrases:
            yield counted(counts)

    def counted(parts):
        anchors, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n > max(1, n.sum() * SHARE / 2)
        return pa.RecordBatch.from_arrays([pa.array([0, *signed(anchors[often]).tolist()], pa.int64()), pa.array([int(n.sum()), *n[often].tolist()], pa.int64()), pa.array([True] + [False] * int(often.sum()))], names=["anchor", "n", "total"])

    met = docs.select("text").mapInArrow(run, "anchor bigint, n bigint, total boolean").groupBy("total", "anchor").agg(F.sum("n").alias("n"))
    met = materialize(met, "anchor-counts")
    total = met.filter("total").agg(F.sum("n")).first()[0] or 0
    rows = met.filter(~F.col("total") & (F.col("n") > total * SHARE / 2)).select("anchor").collect()  # at most 2 / SHARE rows
    return np.sort(np.array([r["anchor"] for r in rows], np.int64).view(np.uint64))


def phrases(docs: DataFrame, size: int, hot: np.ndarray) -> DataFrame:
    def run(batches):
        known, chunk = TextHashes(), Chunk()
        for batch in slices(batches):
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(doc, row, known.of((text or "").encode("utf-8")), size, hot)
                if chunk.words >= CHUNK_WORDS:
                    if (rows := chunk.rows()) is not None:
                        yield from slices([rows], 100_000)
                    chunk = Chunk()
        if (rows := chunk.rows()) is not None:
            yield from slices([rows], 100_000)

    return rows_of(docs).mapInArrow(run, PHRASES)


def unpacked(data) -> list[int]:
    out = np.zeros((len(data) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(data, np.uint8).reshape(-1, KEPT)
    return out.view(np.uint64)[:, 0].tolist()


def factored(rows: DataFrame) -> DataFrame:
    """Spans of windows that start earlier in the corpus; ``rows`` are sorted by anchor, document and place."""

    def run(batches):
        anchor, held = None, {}
        for batch in slices(batches, 20_000):
            anchors, docs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            versions, firsts, lasts = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4))
            blank = batch.column(5).is_null().to_numpy(zero_copy_only=False)
            given = np.flatnonzero(blank)
            out = [(docs[given], versions[given], firsts[given], lasts[given])]
            real = np.flatnonzero(~blank)
            a = anchors[real]
            met = np.zeros(len(real), bool)
            if len(real):
                met[1:] = a[1:] == a[:-1]
                met[:-1] |= met[1:]
                met |= a == anchor if anchor is not None else False
                met[-1] = True  # the next batch may go on with this anchor
            found: list[tuple[int, int, int, int]] = []
            for k in real[met].tolist():
                if anchors[k] != anchor:
                    anchor, held = anchors[k], {}
                doc, row, first = int(docs[k]), int(versions[k]), int(firsts[k])
                begin = None
                for j, window in enumerate(unpacked(batch.column(5)[k].as_buffer())):
                    place = (doc, first + j)
                    earlier = held.setdefault(window, place)
                    if earlier < place:
                        begin = j if begin is None else begin
                    elif begin is not None:
                        found.append((doc, row, first + begin, first + j - 1))
                        begin = None
                if begin is not None:
                    found.append((doc, row, first + begin, int(lasts[k])))
            if found:
                out.append(tuple(np.array(c) for c in zip(*found, strict=True)))
            cols = [np.concatenate([o[k] for o in out]) for k in range(4)]
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.int32)), pa.array(cols[3].astype(np.int32))], names=["doc", "row", "first", "last"])

    return rows.mapInArrow(run, SPANS)


def repeated_spans(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc, row, first, last``: stretches of window starts whose words also start earlier."""
    dealt = phrases(docs, size, hot_anchors(docs, size)).repartition("anchor").sortWithinPartitions("anchor", "doc", "first")
    return factored(dealt)


def without_spans(text: str | None, firsts: list[int] | None, lasts: list[int] | None, size: int) -> tuple[int, int, str]:
    words = WORD.findall(text or "")
    if not firsts:
        return len(words), 0, " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, firsts, 1)
    np.add.at(edge, np.minimum(np.array(lasts) + size, len(words)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    return len(words), int(gone.sum()), " ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def dedup_substrings(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every document.

    A window is ``size`` consecutive words of one document; a word goes when a window over
    it has the same words as a window that starts earlier: in a document of smaller id, or
    earlier in the same document. Rows of one id count as one document, rows without an id
    as one document before all others; repeated rows have equal results. A null or empty
    text has no words. An empty table gives no rows.
    """
    spans = repeated_spans(docs, size).groupBy("doc", "row").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    joined = rows_of(docs).join(spans, ["doc", "row"], "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text", "firsts", "lasts")

    def run(batches):
        for batch in slices(batches):
            done = [without_spans(t, f, n, size) for _, t, f, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if done:
                n_words, n_removed, kept = map(list, zip(*done, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
