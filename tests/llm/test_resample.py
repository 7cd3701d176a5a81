"""Importance resampling against a plain version, and the radix sort against sorted()."""

import hashlib
import math
import random
import re
import zlib

import oracle
import pytest

from salesmart.llm import resample


def plain(docs, target, percent=25, least=20):
    def feats(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        return len(w), [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in feats(text)[1]:
            s[b] += 1
    for text in target:
        for b in feats(text)[1]:
            t[b] += 1
    whole, wanted = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (whole + 10000) / ((a + 1) * (wanted + 10000)))) for a, b in zip(s, t)]
    rows = []
    for doc, text in docs:
        n, f = feats(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted((r[0], *r[2:]) for r in rows)


def words(rng, n):
    return " ".join(rng.choice(["Apple", "pear", "Über", "x1", "don't", "zwölf", "kiwi", "Plum!"]) + str(rng.randrange(9)) for _ in range(n))


def test_rows_are_those_of_the_plain_version(spark, documents):
    rng = random.Random(5)
    docs = [(k * 7919 % 100_003 - 50, words(rng, rng.randrange(60))) for k in range(400)] + [(200_000, None), (200_001, ""), (200_002, words(rng, 30_000)), (2**62, words(rng, 25)), (-(2**62), words(rng, 25))]
    target = [words(rng, 15) for _ in range(20)] + [None, ""]
    got = resample.resample(documents(docs, clash=True), spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string"))
    assert sorted(map(tuple, got.collect())) == plain(docs, target)


def test_the_sql_gives_the_same_rows(spark, con):
    from salesmart.llm.queries import SQL, op12_resample

    assert oracle.compare(op12_resample(spark, oracle.DATA), con, SQL["op12_resample"]) is None


@pytest.mark.parametrize("bits, block", [(1, 7), (4, 50), (11, 1000)])
def test_radix_sort_is_stable_and_total(spark, bits, block):
    rng = random.Random(bits)
    keys = [(rng.choice([0, 5, 5, 5, 2**63 - 1, -1, rng.randrange(40)]), rng.randrange(30)) for _ in range(600)]
    rows = [((k % 3 << 40) + k, k % 3, a, b) for k, (a, b) in enumerate(keys)]
    from salesmart.storage import materialize

    table = materialize(spark.createDataFrame(rows, "row bigint, shard bigint, a bigint, b bigint"))
    got = {r["row"]: r["rank"] for r in resample.radix_ranked(table, ["a", "b"], block_rows=block, digit_bits=bits).collect()}
    order = sorted(rows, key=lambda r: (r[2] % 2**64, r[3], r[0]))  # unsigned keys, then as stored
    assert [got[r[0]] for r in order] == list(range(1, len(rows) + 1))


def test_repeated_ids_null_ids_and_empty_tables(spark, documents):
    rng = random.Random(9)
    text = words(rng, 30)
    docs = documents([(1, text)] * 8 + [(None, text)] * 4)
    none = spark.createDataFrame([], "item_id int, text string")
    out = resample.resample(docs, none, percent=100).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 13)) and len(out) == 12
    assert resample.resample(documents([]), none).collect() == []
    short = resample.resample(documents([(1, "a b"), (2, None)]), none).collect()
    assert [r["rank"] for r in short] == [None, None] and sorted(r["n_features"] for r in short) == [0, 3]
