"""Small helpers that several operators use."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """All rows when there are up to ``most``, else those of the smallest hashes of ``key``, ``most`` as expected.

    The cut follows from a count, so no task sends more than its share to the driver.
    """
    rows = df.count()
    if rows <= most:
        return df
    return df.filter(F.xxhash64(key) < -(2**63) + int(2**64 * most / rows))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of up to ``rows`` rows and ``size`` bytes (or one row), so that few texts are Python objects at once."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            n = min(rows, batch.num_rows - start)
            while n > 1 and batch.slice(start, n).nbytes > size:
                n //= 2
            yield batch.slice(start, n)
            start += n


def trim() -> None:
    """Gives memory that this process does not use back to the system."""
    pa.default_memory_pool().release_unused()
    of_heap = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
    if of_heap:
        of_heap(0)


def freed(run: Callable, keeps: str | None = None) -> Callable:
    """``run`` for ``mapInArrow``; when a task ends, memory its process does not use goes back to the system.

    Python workers live on from stage to stage, so each would else keep the peak of its largest task, and
    what earlier stages have :func:`kept` there: all but ``keeps`` is forgotten when a task begins.
    """

    def all_of(batches):
        store = worker_objects()
        others = [name for name in store if name != keeps]
        for name in others:
            del store[name]
        if others:
            trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return all_of


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles of garbage meanwhile: making many small objects at once would set it off again and again, and find none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def worker_objects() -> dict:
    """What :func:`kept` has made in this process. Functions travel to workers by value, so a module variable would be new in each task."""
    module = sys.modules.setdefault("salesmart_worker_objects", types.ModuleType("salesmart_worker_objects"))
    return module.__dict__.setdefault("objects", {})


def kept(name: str, make: Callable):
    """An object that a worker process makes once and its later tasks use again."""
    store = worker_objects()
    if name not in store:
        store[name] = make()
    return store[name]


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15 | 3
BLANK = re.compile(rb"[\x20\x09-\x0D]")
IS_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTE_VALUES = mixed(np.arange(1, 257).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... (mod 2^64)."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class TextHashes:
    """64-bit hashes of the words of a text, all at once: differences of running polynomial sums over its bytes.

    Such sums can agree for different long words of a regular build, so words of more than ``LONG`` bytes are
    hashed whole. Long texts are taken in pieces that end at white space, so memory follows ``most`` or the longest word.
    """

    LONG = 64

    def __init__(self, most: int = 1 << 18):
        self.most = most
        self.up, self.down = powers(BASE, most), powers(pow(BASE, -1, 2**64), most)

    def _of_piece(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            up, down = powers(BASE, len(data)), powers(pow(BASE, -1, 2**64), len(data))
        else:
            up, down = self.up, self.down
        solid = np.zeros(len(data) + 2, np.int8)
        solid[1:-1] = ~IS_BLANK[data]
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        out = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        for k in np.flatnonzero(ends - starts > self.LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
        return out

    def of(self, data: bytes) -> np.ndarray:
        out, at = [], 0
        while at < len(data):
            end = at + self.most
            cut = BLANK.search(data, end) if end < len(data) else None
            end = cut.start() if cut else len(data)
            out.append(self._of_piece(np.frombuffer(data, np.uint8, end - at, at)))
            at = end
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes, order-sensitive."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the folder ``SALESMART_TOKENIZERS`` names, or of the installed public ones."""
    folder = os.environ.get("SALESMART_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary() -> str:
    """``SALESMART_VOCABULARY``, or the installed public file."""
    return os.environ.get("SALESMART_VOCABULARY") or tokenizer_file("word_bpe_49k.json")
