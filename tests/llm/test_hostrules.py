"""Host-level rules against plain counting, and hosts that decide."""

import random

import pytest

from salesmart.llm import hostrules


def plain(text):
    words, w = [], ""
    for c in (text or "") + " ":
        if c in "\x20\t\n\x0b\x0c\r":
            words += [w] if w else []
            w = ""
        else:
            w += c
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), len(lines)


def test_measures_are_those_of_plain_counting():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 12, "a b\n\na b\n a b\n", "a b c |<#> é", "\r\n\x0b\x1c q"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "# ", "dd\t"]) for _ in range(rng.randrange(90))) for _ in range(150)]
    for t in texts:
        assert hostrules.measures(t) == plain(t), t


GOOD = "the quick brown fox jumps over one lazy dog near some old river bank today"
PIPES = "one | two | three | four | five | six | seven | eight | nine | ten | end"


def rows_of(hosts):
    """hosts: name -> (clean documents, documents of a table)"""
    out = []
    for source, (good, bad) in hosts.items():
        out += [(len(out) + k, f"{GOOD} {len(out) + k}", "en", source) for k in range(good)]
        out += [(len(out) + k, f"{PIPES} {len(out) + k}", "en", source) for k in range(bad)]
    return out


def test_a_bad_host_loses_all_and_a_small_one_is_not_condemned(spark, documents):
    hosts = {f"http://h{k}.org/a": (95, 5) for k in range(20)} | {"https://u@BAD.net:80/x": (5, 95), "tiny.com": (0, 1)}
    out = {r["doc_id"]: r for r in hostrules.judge(documents(rows_of(hosts), clash=True)).collect()}
    verdicts = {r["host"]: r["host_verdict"] for r in out.values()}
    assert verdicts["bad.net"] == "blocked" and verdicts["h3.org"] == "trusted"
    assert not any(r["kept"] for r in out.values() if r["host"] == "bad.net")
    others = [r for r in out.values() if r["host"] not in ("bad.net", "tiny.com")]
    assert sum(r["kept"] for r in others) == 20 * 95 and all(r["kept"] == (r["n_symbols"] == 0) for r in others)


def test_a_host_can_be_held_to_narrow_limits(spark, documents):
    soft = " ".join(["word"] + [f"w{k}" for k in range(28)]) + " # #"  # 2 symbols in 31 words: between 5 and 10 in a hundred
    rows = [(k, soft + f" {k}", "en", "watched.org") for k in range(60)] + [(100 + k, GOOD + f" {k}", "en", f"h{k % 30}.org") for k in range(900)] + [(2000, soft, "en", "h1.org"), (2001, GOOD, "en", "watched.org")]
    out = {r["doc_id"]: r for r in hostrules.judge(documents(rows)).collect()}
    assert out[0]["host_verdict"] == "watched" and not out[0]["kept"] and out[2001]["kept"] and out[2000]["kept"]


def test_nulls_empty_long_repeated_and_clashing(spark, documents):
    rows = [(1, None), (2, ""), (None, GOOD, "en", None), (None, GOOD, "en", None), (5, GOOD, None, "  "), (6, "wörd%d " * 3 + "x" * 300_000), (7, GOOD), (7, GOOD), (8, " ".join(f"w{k}" for k in range(60_000)))]
    docs = documents(rows, clash=True)
    out = hostrules.judge(docs).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["base_failed"] and by[2][0]["base_failed"] and not by[2][0]["kept"]
    assert len(by[None]) == 2 and all(r["kept"] and r["host_verdict"] is None for r in by[None])
    assert by[5][0]["host"] is None and by[5][0]["kept"]
    assert by[6][0]["n_words"] == 4 and by[6][0]["word_chars"] == 300_000 + 18 and by[8][0]["n_words"] == 60_000 and by[8][0]["kept"]
    kept = hostrules.keep_documents(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.select("doc_id").collect())) == sorted(f"Row(doc_id={r['doc_id']})" for r in out if r["kept"])


def test_empty_tables(spark, documents):
    assert hostrules.judge(documents([])).collect() == [] and hostrules.keep_documents(documents([])).collect() == []


@pytest.mark.parametrize("counts, strong", [([(10, 1)] * 50, True), ([(50, 0)] * 25 + [(50, 50)] * 25, False)])
def test_the_prior_follows_the_spread_of_hosts(counts, strong):
    n, f = [a for a, _ in counts], [b for _, b in counts]
    mean, pull = hostrules.prior(len(n), sum(n), sum(x * x for x in n), sum(f), sum(y * y / x for x, y in counts), 1.0, 1000.0)
    assert mean == sum(f) / sum(n) and pull == (1000.0 if strong else 1.0)
