"""Token alignment against a version that compares every pair of byte ranges of a document."""

import gc
import hashlib
import random
from collections import Counter

import pytest

from salesmart.llm import align
from salesmart.llm.shared import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "plain words here", "a <|endoftext|> b </s><s> <unk>", "  x  y\t z \n\n  q ", "<0x41> k", "has ▁ inside", "é中\U0001f600 中\U0001f600 é ﬁ ½",
    "\x00 \x1c a\x85b c", "don't 's 12 3  4 ... !? a_b 're", "a   b　 c  d", "Å İ ſ x́ ﻿y", "tail  ", "word\n\nword \n word", "𐍈𐍈𐍈 🏳️‍🌈 👩‍👩‍👧", "_ _a !b (c) [d] {e} ~f `g",
]


@pytest.fixture(scope="module")
def tools():
    return align.Aligner(A, B)


def plain(tools, text):
    """(A tokens, B tokens, groups, digest, links) by comparing all ranges."""
    if not text:
        return 0, 0, 0, "", []
    ids_a, ids_b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
    both = []
    for ids, held in ((ids_a, tools.bytes_a), (ids_b, tools.bytes_b)):
        if b"".join(held[i] for i in ids) != (" " + text).encode():
            return 0, 0, 0, "", []
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(held[i]), i))
            at += len(held[i])
        both.append(out)
    links = [(x[2], y[2]) for x in both[0] for y in both[1] if x[0] < y[1] and y[0] < x[1]]
    groups, last = [], 0
    for end in sorted({x[1] for x in both[0]} & {y[1] for y in both[1]}):
        groups.append("|".join(",".join(str(i) for _, e, i in side if last < e <= end) for side in both))
        last = end
    return len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def texts(n, seed):
    rng = random.Random(seed)
    signs = ["the", "Über", "naïve", "x", "'s", "中文", "🙂", "1234", "...", "\n", "  ", "\t", "é", "<|endoftext|>", "ed", "re", "_", "|"]
    return ["".join(rng.choice(signs) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_stretches_give_what_the_whole_text_gives(tools):
    assert tools.cuttable
    some = ODD + texts(300, 1)
    for text, (n_a, n_b, n_groups, digest, links) in zip(some, tools.align(some), strict=True):
        want = plain(tools, text)
        assert (n_a, n_b, n_groups, digest) == want[:4], repr(text)
        assert sorted((x >> 16, x & 65535) for x in links.tolist()) == sorted(want[4]), repr(text)


def test_forgetting_changes_nothing(tools):
    small, some = align.Aligner(A, B, most=5), texts(60, 2)
    for at in range(0, 60, 4):
        for x, y in zip(small.align(some[at : at + 4]), tools.align(some[at : at + 4]), strict=True):
            assert x[:4] == y[:4] and x[4].tolist() == y[4].tolist()


@pytest.mark.parametrize("block_pairs", [1, 200, 4_000_000])
def test_corpus_counts_in_blocks(spark, documents, tools, block_pairs):
    some = ODD + texts(60, 3) + ["same text twice"] * 2 + ["long " * 20_000]
    rows = list(enumerate(some)) + [(None, "no id"), (None, None)]
    each = [(doc, plain(tools, t if len(t or "") < 9999 else None)) for doc, t in rows]
    long = next(k for k, t in rows if t and len(t) > 9999)
    found = next(tools.align([some[long]]))
    each[long] = (long, (*found[:4], [(x >> 16, x & 65535) for x in found[4].tolist()]))
    counts = Counter(p for _, x in each for p in set(x[4]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    want = [(doc, *x[:3], len(x[4]), sum(counts[p] == best[p[0]] for p in x[4]), sum(counts[p] for p in x[4]), x[3]) for doc, x in each]
    got = align.align(documents(rows, clash=True).repartition(3, "n_chars"), A, B, block_pairs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_rows(spark, documents):
    assert align.align(documents([]), A, B).collect() == []


def test_no_search_for_garbage_while_stretches_are_learnt():
    aligner, searches = align.Aligner(A, B), []

    def seen(phase, info):
        searches.append(phase)

    some = [" ".join(f"w{k}x{j}" for j in range(300)) for k in range(30)]
    learn = aligner.learn

    def watched(stretches):
        gc.callbacks.append(seen)
        try:
            learn(stretches)
        finally:
            gc.callbacks.remove(seen)

    aligner.learn = watched
    assert len(list(aligner.align(some))) == 30 and len(aligner.known) > 8000
    assert not searches and gc.isenabled()


def test_stretches_met_before_the_last_change_are_not_aligned_again(monkeypatch):
    small, asked = align.Aligner(A, B, most=8), []
    tokens = small.tokens
    monkeypatch.setattr(small, "tokens", lambda text: asked.append(text) or tokens(text))
    batches = [["aa bb"], [" ".join(f"w{k}" for k in range(9))], ["new"], ["aa bb"]]
    got = [list(small.align(batch)) for batch in batches]
    assert [x[:4] for x in got[3]] == [x[:4] for x in got[0]] == [plain(small, "aa bb")[:4]]
    assert sum("aa" in text for text in asked) == 1
    assert len(small.known) + len(small.older) <= 8 + 9
