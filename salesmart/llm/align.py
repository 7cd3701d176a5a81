"""Alignment of the tokens of two tokenizers over the same texts.

A is a byte-level BPE (tokenizers), which reports character offsets; B is a sentencepiece
model, whose proto (``return_type="proto"``, which took the place of the immutable proto in
the installed release) reports spans of bytes. Offsets and spans are the coarse cuts: where
a token has characters of its own, its byte range follows from them. Tokens that share a
character with a neighbour (parts of a multi-byte character, byte-fallback pieces) are
refined with the bytes they decode to. The decoded bytes of all tokens must give the text again.

Texts are cut into stretches in front of spaces that follow a letter, digit or ASCII mark:
neither tokenizer has tokens across such a place (checked when the models are loaded),
so each distinct stretch is aligned once and remembered, within a bound.

Corpus-wide counts of linked id pairs come in blocks of documents. A task counts in how
many documents of its block a pair is met; blocks are summed by pair; each block gets back
the counts of its own pairs and adds them up for its documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import freed, kept, slices, uncollected
from salesmart.storage import materialize

CUT = re.compile(r"(?<=[\w!-/:-@\[-`{-~])(?= )")
#: What CUT looks for besides letters and digits.
MARKS = frozenset("_" + "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))))
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
SPACE = "▁"


def byte_of_symbol() -> dict[str, int]:
    """The byte each symbol of a byte-level vocabulary stands for: printable Latin-1 itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_ends(spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where tokens end in the bytes of a text.

    ``spans`` are the tokens' whole characters as byte ranges. A token that fills its range, which the one
    before it does not touch, ends with it; a run of others, which share characters, is cut by the lengths of
    their decoded bytes, counted from the last such end.
    """
    first, last = spans[:, 0], spans[:, 1]
    own = (last - first == lengths) & (first >= np.concatenate([[0], last[:-1]]))
    at = np.maximum.accumulate(np.where(own, np.arange(len(own)) + 1, 0))  # the last token before with an end of its own
    whole = np.concatenate([[0], np.cumsum(lengths)])
    return np.concatenate([[0], last])[at] + whole[1:] - whole[at]


def character_starts(text: str) -> np.ndarray:
    """The byte each character of ``text`` starts at, and the end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])


class Aligner:
    """Aligned stretches of texts; about ``most`` of them (or ``most`` times 128 bytes) are remembered.

    ``known`` has those met since the last change of ``older``, which has those met between that change and the one before it.
    """

    def __init__(self, path_a: str, path_b: str, most: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        symbols = byte_of_symbol()
        tokens = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = {i: bytes(symbols[c] for c in t) if all(c in symbols for c in t) else t.encode() for i, t in tokens}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = dict(enumerate(bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(x)) else x.replace(SPACE, " ").encode() for x in names))
        rule = re.sub(r"\s", "", self.a.to_str()[:4000])
        self.cuttable = '"type":"ByteLevel"' in rule and '"use_regex":true' in rule and not any(SPACE in x.lstrip(SPACE) for x in names)
        self.sizes_a, self.sizes_b = (np.array([len(x.get(i, b"")) for i in range(max(x) + 1)]) for x in (self.bytes_a, self.bytes_b))
        self.said = [f"{i}{sign}" for i in range(max(len(self.sizes_a), len(self.sizes_b))) for sign in ",|;"]
        self.said_sizes = np.array(list(map(len, self.said)))
        self.most = most
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.bytes = 0

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and ends in bytes by A and by B, for a text that starts with a space; None when bytes are lost."""
        data, code = text.encode("utf-8", "surrogatepass"), self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids_a, found_b = np.array(code.ids, np.int64), [(p.id, p.begin, p.end) for p in pieces]
        found_b = np.fromiter(chain.from_iterable(found_b), np.int64, 3 * len(found_b)).reshape(-1, 3)
        ids_b, spans_b = found_b[:, 0], found_b[:, 1:] + 1  # B adds the space in front by itself and counts from behind it
        if b"".join(map(self.bytes_a.__getitem__, code.ids)) != data or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != data:
            return None
        spans_a = character_starts(text)[np.fromiter(chain.from_iterable(code.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)]
        spans_b[0, 0] = 0
        return ids_a, ids_b, byte_ends(spans_a, self.sizes_a[ids_a]), byte_ends(spans_b, self.sizes_b[ids_b])

    def aligned(self, stretches: list[str]) -> list[tuple | None]:
        """For each stretch: A tokens, B tokens, groups, text of the groups, links as bytes of A id * 2^16 + B id."""
        found = self.tokens("".join(stretches))
        if found is None:
            half = len(stretches) // 2
            return [None] if not half else self.aligned(stretches[:half]) + self.aligned(stretches[half:])
        ids_a, ids_b, ends_a, ends_b = found
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        twice = ends[1:] == ends[:-1]
        cuts, parts = ends[1:][twice], ends[np.append(~twice, True)]
        to_a, to_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1  # tokens up to each cut
        # Each part between two ends lies in one token of each: a link.
        links = ids_a.astype(np.uint32)[np.searchsorted(ends_a, parts)] << np.uint32(16) | ids_b.astype(np.uint32)[np.searchsorted(ends_b, parts)]
        links = links.astype("<u4").tobytes()
        # Tokens in the order they are said in, each with the sign behind it: those of A in a group, then those of B.
        say_a, say_b = 3 * ids_a, 3 * ids_b
        say_a[to_a - 1] += 1
        say_b[to_b - 1] += 2
        said = np.empty(len(ids_a) + len(ids_b), np.int64)
        said[np.arange(len(ids_a)) + np.concatenate([[0], to_b])[np.searchsorted(cuts, ends_a)]] = say_a
        said[np.arange(len(ids_b)) + to_a[np.searchsorted(cuts, ends_b)]] = say_b
        groups, said_ends = "".join(map(self.said.__getitem__, said.tolist())), np.cumsum(self.said_sizes[said])
        bounds = np.cumsum([len(s.encode("utf-8", "surrogatepass")) for s in stretches])
        at = np.searchsorted(cuts, bounds)
        n_a, n_b = to_a[at], to_b[at]
        last_sign, last_link = said_ends[n_a + n_b - 1].tolist(), (4 * np.searchsorted(parts, bounds) + 4).tolist()
        out, s0, l0 = [], 0, 0
        for a, b, g, s1, l1 in zip(*(np.diff(x, prepend=0).tolist() for x in (n_a, n_b, at + 1)), last_sign, last_link, strict=True):
            out.append((a, b, g, groups[s0 : s1 - 1], links[l0:l1]))
            s0, l0 = s1, l1
        return out

    def learn(self, stretches: list[str]) -> None:
        # Only behind the signs that CUT names may another stretch follow.
        joined = [s for s in stretches if s[-1] in MARKS or s[-1].isalnum()]
        parts = [joined[k : k + 4096] for k in range(0, len(joined), 4096)]
        if len(joined) < len(stretches):
            parts += [[s] for s in stretches if not (s[-1] in MARKS or s[-1].isalnum())]
        for part in parts:
            self.remember(dict(zip(part, self.aligned(part), strict=True)))

    def remember(self, found: dict[str, tuple | None]) -> None:
        self.known.update(found)
        self.bytes += 2 * sum(map(len, found)) + sum(len(x[3]) + len(x[4]) for x in found.values() if x)

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """For each text: A tokens, B tokens, groups, digest of the groups, links in order."""
        split = [(CUT.split(f" {t}") if self.cuttable else [f" {t}"]) if t else [] for t in texts]
        met = set().union(*split)
        if len(self.known) > self.most // 2 or self.bytes > 64 * self.most:
            self.known, self.older, self.bytes = {}, self.known, 0
        new = met.difference(self.known)
        back = new.intersection(self.older)
        self.remember({s: self.older[s] for s in back})
        with uncollected():
            self.learn(sorted(new.difference(back)))
        for stretches in split:
            parts = list(map(self.known.__getitem__, stretches))
            if None in parts and len(parts) > 1:  # then the text as a whole decides
                parts = self.aligned(["".join(stretches)])
            if not parts or None in parts:
                yield NOTHING
                continue
            n_a, n_b, n_groups, groups, links = zip(*parts, strict=True)
            yield sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), np.frombuffer(b"".join(links), "<u4")


NOTHING = (0, 0, 0, "", np.empty(0, np.uint32))
ALIGNED = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary, codes array<bigint>, docs array<bigint>"


def aligned(docs: DataFrame, path_a: str, path_b: str, block_pairs: int = 4_000_000, together: int = 50_000) -> DataFrame:
    """One row a document with its distinct linked pairs and how often each is met, and rows with the pairs of each block.

    A block ends with ``block_pairs`` distinct pairs of its documents, all told. Rows of blocks have ``codes`` (A id times
    2^16 plus B id) and ``docs`` (documents of the block that hold the pair), ``together`` at most in a row.
    """
    types = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    name = f"aligner {path_a} {path_b}"

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def summed(block: int, met: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, n = np.unique(np.concatenate(met), return_counts=True)
        for start in range(0, len(codes), together):
            yield batch_of([(block, *[None] * 8, codes[start : start + together].astype(np.int64), n[start : start + together])])

    def run(batches):
        aligner, block = kept(name, lambda: Aligner(path_a, path_b)), TaskContext.get().partitionId() << 32
        met, held = [], 0
        for batch in slices(batches, rows=128, size=1 << 20):
            rows = []
            for doc, (n_a, n_b, n_groups, digest, links) in zip(batch.column(0).to_pylist(), aligner.align(batch.column(1).to_pylist()), strict=True):
                pairs, times = np.unique(links, return_counts=True)
                rows.append((block, doc, n_a, n_b, n_groups, len(links), digest, pairs.tobytes(), times.astype(np.uint32).tobytes(), None, None))
                if len(pairs):
                    met.append(pairs)
                    held += len(pairs)
                if held >= block_pairs:
                    yield from summed(block, met)
                    block, met, held = block + 1, [], 0
            if rows:
                yield batch_of(rows)
        if met:
            yield from summed(block, met)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(freed(run, keeps=name), ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``code, count, best`` of every linked pair: in how many documents it is met, and whether no pair of its A id is met in more."""
    counts = rows.groupBy("code").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("code", 16))
    counts = materialize(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))


OUT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def align(docs: DataFrame, path_a: str, path_b: str, block_pairs: int = 4_000_000) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    Null and empty texts, and those that one of the tokenizers does not give back byte by byte, have no
    tokens: zeros and an empty digest. Null ids and repeated rows are rows like others, and repeated rows
    count as documents each. A very long text is one task's work and a block of its own. An empty table gives no
    rows. Only ``doc_id`` and ``text`` are read, so other columns may have any names.
    """
    rows = materialize(aligned(docs, path_a, path_b, block_pairs), "aligned")
    pairs = rows.filter(F.col("codes").isNotNull()).select("block", F.explode(F.arrays_zip("codes", "docs")).alias("p")).select("block", F.col("p.codes").alias("code"), F.col("p.docs").alias("docs"))
    pairs = materialize(pairs, "block-pairs")
    known = pairs.join(pair_counts(pairs), "code").select("block", "code", "count", "best")
    names = [c.split()[0] for c in OUT.split(", ")]

    def add_up(mine: pa.Table, counts: pa.Table) -> pa.Table:
        codes = counts.column("code").to_numpy().astype(np.uint32)
        order = np.argsort(codes)
        codes, count = codes[order], counts.column("count").to_numpy()[order]
        best = counts.column("best").to_numpy()[order].astype(np.int64)
        n_best, total = [], []
        for held, often in zip(mine.column("pairs"), mine.column("times"), strict=True):
            at = np.searchsorted(codes, np.frombuffer(held.as_buffer(), np.uint32))
            times = np.frombuffer(often.as_buffer(), np.uint32).astype(np.int64)
            n_best.append(int(times @ best[at]) if len(at) else 0)
            total.append(int(times @ count[at]) if len(at) else 0)
        new = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
        return pa.table([new[c] if c in new else mine.column(c) for c in names], names=names)

    each = rows.filter(F.col("codes").isNull()).drop("codes", "docs")
    return each.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(add_up, OUT)
