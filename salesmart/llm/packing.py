"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces
of each length reaches the driver (at most ``capacity`` numbers). Best-fit
decreasing runs over these counts: equal lengths are placed together into groups
of equal sequences. The plan lists ranges of slots by (length, first rank within that length), and
pieces take their slots by joining on the length and the range their rank lies in.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import freed, kept, slices, uncollected
from salesmart.storage import materialize

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, shard int, shard_rank bigint"
#: A special token of the vocabulary that separates words while they are encoded together.
BREAK, BREAK_ID = "<|endoftext|>", 49407

#: Letters and then ASCII marks: the vocabulary's rule cuts between them, and lower case is taken letter by letter
#: (words with a capital sigma or dotted I, whose lower case depends on their place or length, are left whole).
LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
#: The same marks behind a letter and before a space or the end, found in texts.
MARKS_AFTER_LETTER = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[^\W\d_].)[!-&(-/:-@\[-`{-~]*(?= |\Z)")


def lowered(text: str) -> str:
    """``text`` in lower case where that cannot change its ids, else as it is.

    The vocabulary composes characters (NFC) before it takes lower case, so a text must be composed before and after.
    Special tokens are looked for in the text as given.
    """
    if "<|" in text or not text.isascii() and ("\u03a3" in text or "\u0130" in text or not unicodedata.is_normalized("NFC", text)):
        return text
    low = text.lower()
    return low if unicodedata.is_normalized("NFC", low) else text


def words_of(text: str) -> list[str]:
    """The stretches of a text between spaces and line ends, marks behind letters apart; empty ones have no ids."""
    low = lowered(text.replace("\n", " "))
    return (low if "<|" in low else MARKS_AFTER_LETTER.sub(r" \g<0>", low)).split(" ")


class WordEncoder:
    """Token ids of texts for a vocabulary whose tokens never span white space.

    Each stretch between spaces or line ends has the same ids wherever it stands, so
    its ids are remembered as little-endian bytes, for about ``most`` stretches: those met
    since the last change of ``older``, and in ``older`` those met before, since the change before it.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older, self.most = Tokenizer.from_file(path), {}, {}, most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, words: list[str], ids: np.ndarray, ends: np.ndarray, skip: int = 0) -> None:
        data, bounds = ids.tobytes(), [-4 * skip, *(4 * ends).tolist()]
        self.known.update((w, data[a + 4 * skip : b]) for w, a, b in zip(words, bounds[:-1], bounds[1:], strict=True))

    def _learn_plain(self, words: list[str], together: int = 1000) -> None:
        for start in range(0, len(words), together):
            some = words[start : start + together]
            (ids,) = self._ids([f" {BREAK} ".join(some)])
            self._learn_parts(some, ids, np.append(np.flatnonzero(ids == BREAK_ID), len(ids)), skip=1)

    def _learn_letters(self, words: list[str], together: int = 1000) -> None:
        """Words of letters alone are one word each to the vocabulary's rule, so they are told apart by word ends."""
        for start in range(0, len(words), together):
            some = words[start : start + together]
            (ids,) = self._ids([" ".join(some)])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self._learn_parts(some, ids, ends)
            else:
                self._learn_plain(some)

    def learn(self, words: set[str]) -> None:
        known, plain, letters, odd, same, joined = self.known, set(), set(), [], [], []
        for w in words:
            if BREAK in w:
                odd.append(w)
            elif not w.isascii() and ("\u03a3" in w or "\u0130" in w):
                plain.add(w)
            elif w.isalpha():
                core = w.lower()
                if core != w:
                    same.append((w, core))
                if core not in known:
                    letters.add(core)
            elif m := LETTERS_THEN_MARKS.fullmatch(w):
                core, marks = m[1].lower(), m[2]
                joined.append((w, core, marks))
                if core not in known:
                    (letters if core.isalpha() else plain).add(core)
                if marks not in known:
                    plain.add(marks)
            else:
                plain.add(w)
        self._learn_plain(list(plain))
        self._learn_letters(list(letters))
        known.update((w, known[core]) for w, core in same)
        known.update((w, known[core] + known[marks]) for w, core, marks in joined)
        known.update((w, ids.tobytes()) for w, ids in zip(odd, self._ids(odd), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = list(map(words_of, texts))
        met = set().union(*split)
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        new = met.difference(self.known)
        back = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in back)
        with uncollected():
            self.learn(new.difference(back))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The pieces of every document, ranked among the pieces of equal length of their task."""
    last, name = np.array([end_id], "<u4").tobytes(), f"words {vocabulary}"

    def run(batches):
        encoder, shard, ranks = kept(name, lambda: WordEncoder(vocabulary)), TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(part), shard, ranks[n]))
                    ranks[n] += 1
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "shard_rank"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(freed(run, keeps=name), PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, slots, slots a sequence, first sequence, first offset).

    Open sequences are kept in groups of equal free space and equal content; a group
    that takes fewer items than it could is split. Every length adds a few groups at most.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> [(first sequence, sequences)]
    spaces: list[int] = []  # the keys of free that are in use, ascending
    used = 0

    def give_back(space: int, first: int, n: int) -> None:
        if space > 0 and n > 0:
            if not free[space]:
                bisect.insort(spaces, space)
            free[space].append((first, n))

    def place(length: int, rank: int, left: int, space: int, first: int, n: int) -> int:
        """Put up to ``left`` items into ``n`` equal sequences; returns how many went in."""
        each = space // length
        full, rest = min(n, left // each), 0
        if full:
            slots.append((length, rank, full * each, each, first, capacity - space))
        if full < n and left > full * each:
            rest = min(each, left - full * each)
            slots.append((length, rank + full * each, rest, rest, first + full, capacity - space))
        give_back(space - each * length, first, full)
        if rest:
            give_back(space - rest * length, first + full, 1)
        give_back(space, first + full + bool(rest), n - full - bool(rest))
        return full * each + rest

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = free[space].pop()
                if not free[space]:
                    spaces.pop(at)
            else:
                space, first = capacity, used
                n = -(-left // (capacity // length))
                used += n
            done = place(length, rank, left, space, first, n)
            rank, left = rank + done, left - done
    return slots


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    A document's ids are those of its text (null: empty) and then ``end_id``; only
    documents longer than ``capacity`` are cut. Repeated rows are packed each. Null ids
    stay null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = materialize(pieces_of(docs, vocabulary, capacity, end_id), "pieces")
    per_shard = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(per_shard.select("length", "shard", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-ranks")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    # Every group of sequences shrinks by half at least when it is used and three at most come of one, so the plan has
    # less than 36 * capacity rows of 48 bytes, however many pieces there are.
    slots = spark.createDataFrame(plan(counts, capacity), "length bigint, first_rank bigint, n bigint, each bigint, first_sequence bigint, first_offset bigint")
    ranked = pieces.join(starts.select("length", "shard", "base"), ["length", "shard"]).withColumn("rank", F.col("base") + F.col("shard_rank"))
    k = F.col("rank") - F.col("first_rank")
    placed = ranked.join(F.broadcast(slots), "length").filter((k >= 0) & (k < F.col("n")))
    sequence = (F.col("first_sequence") + F.expr("(rank - first_rank) div each")).alias("sequence_id")
    offset = (F.col("first_offset") + k % F.col("each") * F.col("length")).alias("offset")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence, offset)
