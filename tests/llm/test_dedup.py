"""Line dedup, Jaccard join, substring dedup and decontamination against plain versions."""

import random

import brute
import pytest

from salesmart.llm import decontaminate, jaccard, lines, substring

LONG = " ".join(f"w{k % 997}" for k in range(30_000))


def corpus(seed, n=120):
    """Near copies at many distances, shared passages and lines, copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(60))
    base = [[word() for _ in range(rng.choice((4, 30, 90, 160)))] for _ in range(8)]
    passage, line = [word() for _ in range(60)], "A common line of more than twenty letters"
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two three"), (4, "One TWO three"), (5, "same " * 70), (6, LONG)]
    for i in range(7, n):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 4, 8))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(20) :]
        text = " ".join(w)
        if rng.random() < 0.4:
            text = f"{line}\n{text}\n  {line.upper()} "
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, documents, seed):
    rows = corpus(seed)
    got = {r["doc"]["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in lines.dedup_lines(documents(rows, clash=True), batches=3).collect()}
    assert got == brute.line_dedup(rows)


def test_lines_of_repeated_and_unnamed_rows(spark, documents):
    text = "this line is long enough\nshort"
    rows = [(None, text), (1, text), (1, text), (2, text), (3, None)]
    got = sorted((r["doc"]["doc_id"] or -1, r["n_dropped"]) for r in lines.dedup_lines(documents(rows)).collect())
    assert got == [(-1, 1), (1, 1), (1, 1), (2, 0), (3, 0)]


def test_runs_are_compacted(spark):
    runs = lines.LineRuns(spark, fan_in=2)
    for k in range(5, 0, -1):
        runs.add(spark.createDataFrame([(k, 1, 1), (k, k, 2)], "doc bigint, hi bigint, lo bigint"))
    assert len(runs.runs()) == 2
    assert [(r["hi"], r["lo"]) for r in runs.frequent(3).collect()] == [(1, 1)]
    assert {(r["hi"], r["lo"], r["doc"]) for r in runs.first_holders().collect()} == {(1, 1, 5), *((k, 2, k) for k in range(1, 6))}


@pytest.mark.parametrize("small, cell", [(32, 1500), (1, 3)])
def test_components(spark, documents, monkeypatch, small, cell):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CELL", cell)
    rows = corpus(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_components(documents(rows, clash=True)).collect()}
    assert got == brute.components(rows)


def test_components_without_broadcast(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", -1)
    rows = corpus(4, 60)
    kept = {r["doc_id"] for r in jaccard.without_near_copies(documents(rows, clash=True)).collect()}
    assert kept == {i for i, (n, root) in brute.components(rows).items() if n == 0 or root == i}


def test_components_of_repeated_and_unnamed_rows(spark, documents):
    a, b = "a b c d e f g h", "other words that stand alone here"
    rows = [(2, a), (2, a), (5, a.upper()), (None, a), (None, b), (7, None), (7, None)]
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard.near_components(documents(rows)).collect())
    assert got == [(-1, -1), (-1, 2), (2, 2), (2, 2), (5, 2), (7, 7), (7, 7)]
    kept = sorted((r["doc_id"] or -1, r["text"] or "") for r in jaccard.without_near_copies(documents(rows)).collect())
    assert kept == [(-1, b), (2, a), (7, ""), (7, "")]


def test_sketches_bound_the_difference():
    rng = random.Random(5)
    import numpy as np

    for _ in range(50):
        x = {rng.getrandbits(64) for _ in range(rng.randrange(1, 900))}
        y = {v for v in x if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.randrange(60))}
        if y:
            a, b = (np.sort(np.array(list(s), np.uint64)) for s in (x, y))
            assert jaccard.hamming(jaccard.bit_sketch(a), jaccard.bit_sketch(b)) <= len(x ^ y)
            if 100 * len(x & y) >= 80 * len(x | y):
                assert set(jaccard.block_tokens(a).tolist()) & set(jaccard.block_tokens(b).tolist())


@pytest.mark.parametrize("seed, parts", [(6, 1), (7, 7)])
def test_substrings(spark, documents, seed, parts):
    rows = corpus(seed) + [(500, "lone " + "x y " * 40), (501, " ".join(map(str, range(20)))), (502, " ".join(map(str, range(19)))), (503, " ".join(map(str, range(20))))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.dedup_substrings(documents(rows, clash=True).repartition(parts)).collect()}
    assert got == brute.substring_dedup(rows)


def test_substrings_of_hot_anchors(spark, documents, monkeypatch):
    monkeypatch.setattr(substring, "SHARE", 1e-9)
    monkeypatch.setattr(substring, "CHUNK_WORDS", 400)
    rows = corpus(8)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.dedup_substrings(documents(rows)).collect()}
    assert got == brute.substring_dedup(rows)


def test_substrings_of_repeated_and_unnamed_rows(spark, documents):
    text = " ".join(f"v{k}" for k in range(25))
    rows = [(None, text), (1, text), (1, text), (2, None)]
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in substring.dedup_substrings(documents(rows)).collect())
    assert got == [(-1, 0), (1, 25), (1, 25), (2, 0)]


ITEMS = [
    (1, "A train leaves at 9:30 and travels 120 km in 2 hours, then Anna walks 120 km more on foot to the village"),
    (2, "Short one"),
    (3, None),
    (4, "The quick brown fox jumps over the lazy dog while seven green birds sing loudly in the old tree"),
]
QUESTIONS = [
    (1, "Intro text. A train leaves at 8:15 and travels 300 km in 5 hours, then Boris walks 300 km more on foot to the village. More."),
    (2, "A train leaves at 8:15 and travels 300 km in 5 hours, then Boris walks 77 km more on foot to the village."),
    (3, "Nothing of the kind; 12 34 56 78 90 12 34 56 78 90 12 34."),
    (4, "zz " * 37 + ITEMS[3][1].upper() + " zz" * 5),
    (5, None), (6, ""), (None, ITEMS[3][1]), (7, ITEMS[3][1][:40]), (8, ITEMS[3][1][30:] + " and on"),
    (9, LONG + " " + ITEMS[0][1]),
]


def test_benchmark_items_are_found(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in decontaminate.matches(documents(QUESTIONS, clash=True), items).collect()}
    want = brute.contaminated([r for r in QUESTIONS if r[0] != 9], [x for x in ITEMS if x[1] and len(x[1]) > 20]) | {(9, 1)}
    assert set(got) == want and {(1, 1), (4, 4), (None, 4)} <= want and (2, 1) not in want
    assert got[1, 1] == 5 and got[9, 1] == 0  # 9:30, 120, 2, Anna and 120 again
    kept = {r["doc_id"] for r in decontaminate.clean(documents(QUESTIONS, clash=True), items).collect()}
    assert kept == {i for i, _ in QUESTIONS} - {i for i, _ in want}


def test_empty_tables(spark, documents):
    none = documents([])
    items = spark.createDataFrame([], "item_id bigint, text string")
    for df in (lines.dedup_lines(none), jaccard.near_components(none), jaccard.without_near_copies(none), substring.dedup_substrings(none), decontaminate.matches(none, items), decontaminate.clean(none, items)):
        assert df.count() == 0
    assert decontaminate.clean(documents(QUESTIONS), items).count() == len(QUESTIONS)
