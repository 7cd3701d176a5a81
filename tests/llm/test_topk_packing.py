"""Exact top-k search and best-fit packing against plain versions."""

import random
import zlib

import brute
import numpy as np
import oracle
import pytest

from salesmart.llm import packing, topk
from salesmart.llm.shared import vocabulary

DDL = "vec_id bigint, embedding array<float>, id int, score double, vector string, query_id int"


def plain(rows, k, every=1):
    """[(query, rank, item, score)] with ties to smaller ids; repeated rows each take a place."""
    fine = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({(i, tuple(v)) for i, v in fine if i % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in fine if i != q[0])
        out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k, every=1, **blocks):
    df = spark.createDataFrame([(i, v, 1, 0.5, "x", 2) for i, v in rows], DDL)
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = topk.exact_top_k(vectors.filter(f"id % {every} = 0"), vectors, k=k, **blocks)
    return sorted((r["query_id"], r["rank"], r["item_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("seed, blocks", [(1, {}), (2, {"item_block": 40, "query_block": 9, "least_blocks": 1}), (3, {"least_blocks": 1})])
def test_top_k_equals_brute_force(spark, seed, blocks):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]  # ties
    rows += [(300, [0.0] * 8), (301, [0.0] * 8), (302, None), (303, [1.0, None] * 4), (304, [float("nan")] * 8), (305, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (306, [5.0, 5.0])]
    assert found(spark, rows, 7, 3, **blocks) == plain(rows, 7, 3)


def test_few_and_repeated_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.0])]
    assert found(spark, rows, 10) == plain(rows, 10)
    assert found(spark, [(1, [1.0])], 10) == [] and found(spark, [], 10) == []


def test_the_bound_stops_the_lists(monkeypatch):
    """On vectors of few strong dimensions most items are never scored."""
    rng, scored = np.random.default_rng(5), []
    vectors = np.floor(1024 * rng.normal(size=(4000, 6)) * np.array([8.0, 1, 0.2, 0.1, 0.05, 0.02]))
    lists = topk.SortedLists(np.arange(4000), vectors)

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.ndim == 1:
                scored.append(len(at))
            return super().__getitem__(at)

    lists.vectors = vectors.view(Counted)
    for q in range(0, 4000, 400):
        ids, scores = lists.search(vectors[q], 10, q)
        want = sorted(((-float(vectors[q] @ vectors[i]), i) for i in range(4000) if i != q))[:10]
        assert [(-s, i) for i, s in zip(np.asarray(ids).tolist(), np.asarray(scores).tolist())] == [(s, i) for s, i in want]
    assert sum(scored) < 0.6 * 10 * 4000


HARD = [
    "", None, " ", "\n\n", "Plain words here.", "ÀÉÎ straße ΣΑΣ İstanbul ǅ", "don't we'll 'tis x's", "a<|endoftext|>b <|startoftext|>", "½ ² Ⅷ ١٢٣ 12ab34", "tab\tin side  two   three",
    "中文字 かな 한국어", "🙂🙃 👩‍👩‍👧", "é café café", "###$$$ %%% |a| ...!?", " nbsp em　ideo", "x" * 5000, "A.B,C;D:E", "\x00\x01 control", "ſ ﬁ Ω K",
]


def test_token_ids_are_those_of_the_tokenizer():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    texts = [t or "" for t in pq.read_table(f"{oracle.DATA}/documents.parquet")["text"].to_pylist() + HARD]
    encoder = packing.WordEncoder(vocabulary(), most=2000)  # forgets on the way
    for start in range(0, len(texts), 16):
        for t, ids in zip(texts[start : start + 16], encoder.encode(texts[start : start + 16]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_of_whole_documents(spark, documents, capacity):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(vocabulary()), random.Random(capacity)
    rows = list(enumerate(HARD)) + [(100 + k, " ".join(rng.choice(["red", "blue", "Green."]) for _ in range(rng.randrange(3 * capacity // 2)))) for k in range(40)]
    rows += [(7, "same row"), (7, "same row"), (None, "no id"), (None, None)]
    got = packing.pack(documents(rows, clash=True), vocabulary(), capacity).collect()
    want = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(doc, k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    used = brute.packed_well([(r["sequence_id"], r["offset"], r["length"]) for r in got], capacity)
    least = -(-sum(w[3] for w in want) // capacity)
    assert least <= used <= least + 1 + len(want) // 20


def test_plan_of_many_equal_pieces_is_a_few_rows():
    counts = {4096: 10**9, 1: 10**9, 3000: 10**8, 1000: 3 * 10**8, 96: 7}
    plan = packing.plan(counts, 4096)
    assert len(plan) < 60
    for length, n in counts.items():
        ranges = sorted((first, first + k) for own, first, k, *_ in plan if own == length)
        assert ranges[0][0] == 0 and ranges[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_nothing_to_pack(spark, documents):
    assert packing.pack(documents([]), vocabulary()).collect() == []


def test_words_are_remembered_once_and_frequent_ones_for_longer():
    encoder, learnt = packing.WordEncoder(vocabulary(), most=200), []
    learn = encoder.learn
    encoder.learn = lambda words: (learnt.append(set(words)), learn(words))
    encoder.encode(["Word word, WORD word. Word!"])
    assert set(encoder.known) - {""} == {"word", ",", ".", "!"}
    for k in range(40):  # met in every third batch only
        encoder.encode([f"{'often' if k % 3 == 0 else 'and'} " + " ".join(f"x{k}y{j}" for j in range(20))])
        assert len(encoder.known) + len(encoder.older) <= 200 + 2 * 21
    assert sum("often" in x for x in learnt) == 1


@pytest.mark.parametrize("text", ["H̱ HE̱L KÅ K", "A<|ENDOFTEXT|>B, <|endoftext|>, C.", "it's, IT'S. 'Tis", "ǅ, ß. ẞ! ΐ; ΐ", "à, À. ², Ⅷ. x_, _y."])
def test_lower_case_and_marks_leave_the_ids(text):
    from tokenizers import Tokenizer

    (ids,) = packing.WordEncoder(vocabulary()).encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == Tokenizer.from_file(vocabulary()).encode(text, add_special_tokens=False).ids
