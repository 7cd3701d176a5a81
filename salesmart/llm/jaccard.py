"""N-gram Jaccard join with parity sketches.

A document's shingles are XOR-hashed into a sketch: every shingle flips bits in one of
``m`` blocks, so each shingle that only one of two documents holds changes one block at
most. Documents of Jaccard similarity 0.8 or more, of joint size s, differ in at most
s / 9 shingles; with more than that many blocks they agree in some. Inside each band of
sizes documents meet through equal blocks (pigeonhole). Of its blocks a document offers
only as many as the bound asks for, fullest first, an order that both sides share.

Equal shingle sets form one class, classes are the nodes of the join. In each meeting
place every class is first paired with one common partner. In large places the closest
pairs between components follow, fewer than there are classes. Whatever these leave
in different components is compared in full, in blocks of bounded size: Hamming distance
of bit sketches first, as it never exceeds the symmetric difference, then the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.components import components
from salesmart.llm.shared import TextHashes, freed, gram_hashes, mixed, signed, slices
from salesmart.storage import materialize

NO_ID = -(2**63)
SIZE = 5
#: Documents link when SHARE[1] * intersection >= SHARE[0] * union.
SHARE = (80, 100)
#: Ids of at most so many rows are sent to all executors; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Classes of one meeting place that are compared in one task at a time.
CELL = 1500
#: Meeting places of at most so many classes have their pairs listed before sketches are looked at.
SMALL = 32
ROWS = "token bigint, cls bigint, n int, row bigint"


def shingles(text: str | None, known: TextHashes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``size`` are one shingle."""
    words = known.of((text or "").encode("utf-8").lower())
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(size, len(words))) + np.uint64(len(words) if len(words) < size else 0))


def class_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def most_apart(joint: int) -> int:
    """Largest symmetric difference of linked sets whose sizes add up to ``joint``."""
    return joint * (SHARE[1] - SHARE[0]) // (SHARE[1] + SHARE[0])


def band_edges(n: int) -> tuple[int, int, int]:
    """Number of the band that holds size ``n``, its first size and the first size of the next band."""
    number, low = 0, 1
    while True:
        high = low * SHARE[1] // SHARE[0] + 1
        if n < high:
            return number, low, high
        number, low = number + 1, high


PLACES = mixed(np.arange(1, 1 << 14).astype(np.uint64))


def places(blocks: int) -> np.ndarray:
    """A hash of each block's place."""
    return PLACES[:blocks] if blocks <= len(PLACES) else mixed(np.arange(1, blocks + 1).astype(np.uint64))


def block_tokens(hashes: np.ndarray) -> np.ndarray:
    """The blocks that a class offers: in the join of its own band, and in that of the band below."""
    n = len(hashes)
    band, low, high = band_edges(n)
    upper, scrambled = hashes >> np.uint64(32), mixed(hashes)
    out = []
    for group, first_above, offered in ((band, high, most_apart(n + n * SHARE[1] // SHARE[0]) + 1), (band - 1, low, most_apart(n + low - 1) + 1)):
        if group < 0:
            continue
        largest = first_above - 1
        blocks = (most_apart(largest + largest * SHARE[1] // SHARE[0]) + 1) * 5 // 4 + 1
        where = (upper * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        content = np.zeros(blocks, np.uint64)
        np.bitwise_xor.at(content, where, scrambled)
        full = np.minimum(np.bincount(where, minlength=blocks), 4)
        tokens = mixed(content ^ places(blocks) ^ mixed(np.array([group + 1], np.uint64)))
        if offered < blocks:
            first = (4 - full).astype(np.uint64) << np.uint64(61) | tokens >> np.uint64(3)
            tokens = tokens[np.argpartition(first, offered)[:offered]]
        out.append(tokens)
    return np.concatenate(out)


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Every shingle flips the bit at its hash; two bits a shingle at least, a power of two in all."""
    bits = 1 << max(9, (2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches, the longer one folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    least = min(len(x), len(y))
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, least), 0) ^ np.bitwise_xor.reduce(y.reshape(-1, least), 0)).sum())


def source_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("row"), "text")


def offered(docs: DataFrame) -> DataFrame:
    """Block tokens of every class a task meets (row null), and one row per document with its id as token."""

    def run(batches):
        known, seen = TextHashes(), set()
        for batch in slices(batches):
            tokens, owners, lengths, heads = [], [], [], []
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = shingles(text, known)
                cls = class_of(hashes) if len(hashes) else None
                heads.append((doc, cls, len(hashes), row))
                if cls is not None and cls not in seen:
                    seen.add(cls)
                    tokens.append(block_tokens(hashes))
                    owners.append(cls)
                    lengths.append(len(tokens[-1]))
            if heads:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*heads, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["token", "cls", "n", "row"])
            if tokens:
                token, cls = signed(np.concatenate(tokens)), np.repeat(np.array(owners, np.int64), lengths)
                yield from slices([pa.RecordBatch.from_arrays([pa.array(token), pa.array(cls), pa.nulls(len(token), pa.int32()), pa.nulls(len(token), pa.int64())], names=["token", "cls", "n", "row"])], 100_000)

    return source_rows(docs).mapInArrow(freed(run), ROWS)


def meetings(dealt: DataFrame) -> DataFrame:
    """Rows sorted by (token, cls): tokens of two classes or more, with the first class as ``hub``; document rows pass."""

    names = ["token", "cls", "hub", "n", "row"]

    def run(batches):
        last: tuple | None = None  # of the token rows so far: token, class, hub, whether the hub's row was given
        for batch in batches:
            is_doc = pa.compute.is_valid(batch.column(3))
            heads, rest = batch.filter(is_doc), batch.filter(pa.compute.invert(is_doc))
            if heads.num_rows:
                yield pa.RecordBatch.from_arrays([heads.column(0), heads.column(1), pa.nulls(heads.num_rows, pa.int64()), heads.column(2), heads.column(3)], names=names)
            token, cls = (rest.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            if not len(token):
                continue
            goes_on = last is not None and token[0] == last[0]
            again = np.concatenate([[goes_on and cls[0] == last[1]], (token[1:] == token[:-1]) & (cls[1:] == cls[:-1])])
            new = np.concatenate([[True], token[1:] != token[:-1]])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            hubs = cls[starts]
            if goes_on:
                hubs[0] = last[2]
            hub = np.repeat(hubs, sizes)
            company = cls != hub
            shared = np.logical_or.reduceat(company, starts)
            own = new & np.repeat(shared, sizes)
            if goes_on:
                own[0] = False
            out = np.flatnonzero((company & ~again) | own)
            given = (token[out], cls[out], hub[out])
            if goes_on and shared[0] and not last[3]:
                given = tuple(np.concatenate([[x], y]) for x, y in zip((token[0], hubs[0], hubs[0]), given, strict=True))
            last = (token[-1], cls[-1], hubs[-1], bool(shared[-1]) or (len(starts) == 1 and goes_on and last[3]))
            if len(given[0]):
                yield pa.RecordBatch.from_arrays([*map(pa.array, given), pa.nulls(len(given[0]), pa.int32()), pa.nulls(len(given[0]), pa.int64())], names=names)

    return dealt.mapInArrow(freed(run), "token bigint, cls bigint, hub bigint, n int, row bigint")


def sets_of(docs: DataFrame, members: DataFrame, met: DataFrame) -> DataFrame:
    """``cls, n, sketch, hashes`` of every class that meets another one."""
    wanted = met.select("cls").distinct().join(members.groupBy("cls").agg(F.min(F.struct("doc", "row")).alias("at")), "cls")
    wanted = materialize(wanted.select("cls", "at.doc", "at.row"), "class-rows")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches):
        known = TextHashes()
        for batch in slices(batches):
            rows = [(cls, len(h), bit_sketch(h), h.tobytes()) for cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for h in [shingles(text, known)]]
            if rows:
                types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["cls", "n", "sketch", "hashes"])

    texts = source_rows(docs).join(wanted, ["doc", "row"]).select("cls", "text")
    return materialize(texts.mapInArrow(freed(run), "cls bigint, n int, sketch binary, hashes binary"), "class-sets")


def near_by_sketch(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, apart``: the pairs whose sketches do not rule a link out."""
    side = lambda x: sets.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("n_a", "n_b") * SHARE[1] >= F.greatest("n_a", "n_b") * SHARE[0])

    def run(batches):
        for batch in batches:
            apart = [hamming(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(apart, pa.int32()), batch.column(4)], names=["a", "b", "apart", "most"])
            yield out.filter(pa.compute.less_equal(out.column(2), out.column(3)))

    most = F.expr(f"({SHARE[1] - SHARE[0]} * (n_a + n_b)) div {SHARE[1] + SHARE[0]}").cast("int").alias("most")
    return rows.select("a", "b", "sketch_a", "sketch_b", most).mapInArrow(freed(run), "a bigint, b bigint, apart int, most int").select("a", "b", "apart")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    side = lambda x: sets.select(F.col("cls").alias(x), F.col("hashes").alias(f"set_{x}"))

    def links(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return SHARE[1] * both >= SHARE[0] * (len(x) + len(y) - both)

    def run(batches):
        for batch in slices(batches):
            good = [links(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(freed(run), "a bigint, b bigint").distinct()


def by_group(batches, keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of the rows of each group; rows are sorted by their first ``keys`` columns."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        if held and any(columns[k][0] != held[-1][k][-1] for k in range(keys)):
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        cut = np.zeros(len(columns[0]) - 1, bool)
        for k in range(keys):
            cut |= columns[k][1:] != columns[k][:-1]
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), len(columns[0])]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            part = [c[x:y] for c in columns]
            if y < edges[-1]:
                yield [np.concatenate(c) for c in zip(*held, part, strict=True)] if held else part
                held = []
            else:
                held.append(part)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def pair_batches(found: Iterator[tuple[list[int], list[int]]]) -> Iterator[pa.RecordBatch]:
    """The pairs (smaller first), leaving out most of those a task finds again."""
    seen: set[tuple[int, int]] = set()
    fresh: list[tuple[int, int]] = []
    for left, right in found:
        for pair in zip(left, right, strict=True):
            pair = pair if pair[0] < pair[1] else pair[::-1]
            if pair not in seen:
                seen.add(pair)
                fresh.append(pair)
        if len(fresh) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*fresh, strict=True)], names=["a", "b"])
            fresh = []
        if len(seen) >= 500_000:
            seen.clear()
    if fresh:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*fresh, strict=True)], names=["a", "b"])


def close_pairs(cls: np.ndarray, root: np.ndarray, n: np.ndarray, part: np.ndarray, sketches: np.ndarray) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Pairs of one cell, with the distance of their sketches, that are in different components, and neither their sizes nor their sketches rule out."""
    order = np.lexsort((cls, n))
    cls, root, n, part = cls[order], root[order], n[order], part[order]
    views = [np.frombuffer(sketches[k], np.uint64) for k in order]
    least = min(map(len, views))
    folded = np.stack([np.bitwise_xor.reduce(v.reshape(-1, least), 0) for v in views])
    for k in range(len(n) - 1):
        other = np.arange(k + 1, np.searchsorted(n, n[k] * SHARE[1] // SHARE[0], side="right"))
        other = other[(root[other] != root[k]) & (part[other] != part[k])]
        if len(other):
            apart = np.bitwise_count(folded[other] ^ folded[k]).sum(1)
            near = apart <= (n[other] + n[k]) * (SHARE[1] - SHARE[0]) // (SHARE[1] + SHARE[0])
            other, apart = other[near], apart[near]
            yield [int(cls[k])] * len(other), cls[other].tolist(), apart.tolist()


def forest(found: Iterator[tuple[list[int], list[int], list[int]]], roots: dict[int, int]) -> tuple[list[int], list[int]]:
    """Of the (a, b, apart) pairs of one cell the closest ones that would join all components that any pair joins."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    columns = [np.concatenate([np.array(x, np.int64) for x in c]) for c in zip(*found, strict=True)]
    left, right = [], []
    for k in np.lexsort((columns[1], columns[0], columns[2])) if columns else ():
        a, b = int(columns[0][k]), int(columns[1][k])
        x, y = top(roots[a]), top(roots[b])
        if x != y:
            above[x] = y
            left.append(a)
            right.append(b)
    return left, right


def apart_pairs(met: DataFrame, roots: DataFrame, sets: DataFrame, closest: bool = False) -> DataFrame:
    """``a, b``: classes that meet in a block and are in different components.

    Pairs of small meeting places come as they are. A large one is split into parts, and
    every two parts meet in a cell of their own, where sizes and sketches sift the pairs.
    With ``closest`` only large places answer, each cell with fewer pairs than it has rows.
    """
    rooted = met.select("token", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    sizes = rooted.groupBy("token").agg(F.count("*").alias("rows"), F.min("root").alias("least"), F.max("root").alias("most"))
    rows = materialize(rooted.join(sizes.filter("least < most").select("token", "rows"), "token"), "mixed")

    def small(batches):
        def pairs():
            for _, cls, root in by_group(batches, 1):
                cls, root = cls.tolist(), root.tolist()
                for k in range(1, len(cls)):
                    others = [c for c, r in zip(cls[:k], root[:k], strict=True) if r != root[k]]
                    yield [cls[k]] * len(others), others

        yield from pair_batches(pairs())

    def large(batches):
        def pairs():
            for _, i, j, cls, root, part, n, sketches in by_group(batches, 3):
                # In a cell of one part with itself all rows differ in place, else only rows of the two parts meet.
                found = close_pairs(cls, root, n, np.arange(len(cls)) if i[0] == j[0] else part, sketches)
                if closest:
                    yield forest(found, dict(zip(cls.tolist(), root.tolist(), strict=True)))
                else:
                    yield from ((a, b) for a, b, _ in found)

        yield from pair_batches(pairs())

    few = rows.filter(F.col("rows") <= SMALL).select("token", "cls", "root").repartition("token").sortWithinPartitions("token")
    parts = F.ceil(F.col("rows") / CELL).cast("int")
    part = F.pmod(F.xxhash64("cls", "token"), parts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(F.least(k, part).alias("i"), F.greatest(k, part).alias("j")))
    many = rows.filter(F.col("rows") > SMALL).withColumn("part", part).withColumn("cell", F.explode(cells)).join(sets.select("cls", "n", "sketch"), "cls")
    many = many.select("token", "cell.i", "cell.j", "cls", "root", "part", "n", "sketch").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    schema = "a bigint, b bigint"
    if closest:
        return many.mapInArrow(large, schema).distinct()
    return few.mapInArrow(small, schema).union(many.mapInArrow(large, schema)).distinct()


def near_components(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_shingles, component_id, first`` for every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space. The set of a text
    holds its distinct 5-word shingles, or its whole sequence if it has fewer words. Rows of
    equal sets link, and sets of Jaccard similarity 0.8 or more; ``component_id`` is the
    smallest id that links reach. A text that is null or has no words links with nothing.
    ``row`` is the hash of the text; rows without an id give their component no id. ``first``
    marks the smallest id of a component, and rows that link with nothing.
    """
    dealt = offered(docs).repartition("token").sortWithinPartitions("token", "cls")
    both = materialize(meetings(dealt), "meetings")
    met = both.filter("row IS NULL").select("token", "cls", "hub")
    members = both.filter("row IS NOT NULL").select(F.col("token").alias("doc"), "row", "n", "cls")
    roots = class_roots(docs, members, met)
    placed = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    known = F.when(F.col("doc") != NO_ID, F.col("doc"))
    placed = materialize(placed.select("row", "n", "root", known.alias("doc_id")), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    found = placed.join(placed.filter("root IS NOT NULL").groupBy("root").agg(first), "root", "left")
    alone = F.col("root").isNull()
    return found.select(
        "doc_id", "row", F.col("n").cast("bigint").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row")))).alias("first"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The documents, as given, without those that are not ``first`` in their component; repeated rows stay once, but all that are empty stay."""
    judged = materialize(near_components(docs), "near-copies")
    gone = judged.filter("NOT first").select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")).distinct()
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    here = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))  # so that no column of theirs meets one of ours
    here = here.select("doc", F.col("doc.doc_id").cast("bigint").alias("id"), F.xxhash64("doc.text").alias("row"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row"))
    kept = here.join(gone, same, "left_anti")
    repeated = judged.filter("first AND n_shingles > 0").groupBy("doc_id", "row").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        twice = repeated.select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"))
        kept = kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["id", "row"]))
    return kept.select("doc.*")


def class_roots(docs: DataFrame, members: DataFrame, met: DataFrame) -> DataFrame:
    """``node, root`` of the classes that link with others."""
    if met.isEmpty():
        return met.select(F.col("cls").alias("node"), F.col("hub").alias("root"))
    sets = sets_of(docs, members.filter("cls IS NOT NULL"), met)
    with_hub = met.filter("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"), "cls").distinct()
    near = near_by_sketch(with_hub.select("a", "b"), sets).join(with_hub, ["a", "b"])
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("cls").orderBy("apart", "a", "b"))).filter("place <= 2")
    first = materialize(linked(best.select("a", "b").distinct(), sets), "links")
    roots = components(first)
    closest = materialize(linked(near_by_sketch(apart_pairs(met, roots, sets, closest=True), sets), sets), "links")
    if not closest.isEmpty():
        first = first.union(closest)
        roots = components(first)
    second = materialize(linked(near_by_sketch(apart_pairs(met, roots, sets), sets), sets), "links")
    if second.isEmpty():
        return roots
    return components(first.union(second))
