"""The corpus pipeline, stage by stage, against plain versions of what each stage was given."""

import brute
import pytest

import corpus_pipeline
from salesmart.llm import quality
from salesmart.llm.shared import freed, kept, vocabulary

PROSE = "the quiet river ran along the old stone wall while people walked home from market".split()


def prose(k, n=60):
    return " ".join(f"{PROSE[(k * 7 + j * (k % 5 + 1)) % len(PROSE)]}{(k * 31 + j * j) % 89}" for j in range(n))


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    """Good prose, tables of bars, copies, near copies, shared lines, a benchmark item, odd rows, clashing columns."""
    path, line = str(tmp_path_factory.mktemp("corpus")), "A line that many of the documents here hold"
    rows = [(k, f"{prose(k)}\n{line}" if k % 3 == 0 else prose(k), "en", f"src{k % 4}") for k in range(60)]
    rows += [(100 + k, " | ".join(prose(k, 40).split()), "en", f"src{k % 4}") for k in range(30)]
    rows += [(200, prose(5)), (201, prose(7) + " tail"), (202, prose(8) + " end"), (203, prose(50, 20) + " " + prose(77, 30) + " " + prose(51, 20))]
    rows += [(300, None), (301, ""), (None, prose(90)), (302, prose(91, 3000)), (303, prose(92)), (303, prose(92))]
    documents(rows, clash=True).write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(0, 60, 2)] + [(100 + k, 0, 0) for k in range(0, 30, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(77, 30)), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    from salesmart.storage import materialize

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    assert all(df.columns == stages[0].columns for df in stages[1:5])


def test_rejected_documents_go_and_clean_ones_stay(spark, folder, stages):
    docs = stages[0]
    judged = quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert pairs(stages[1]) == pairs(judged.filter("keep").select("doc.*"))
    ids = {i for i, _ in pairs(stages[1])}
    assert set(range(60)) <= ids and not ids & set(range(100, 130))


def test_lines_of_what_was_kept(stages):
    rows = {(i, t) for i, t in pairs(stages[1]) if i is not None}
    want = brute.line_dedup(sorted(rows))
    assert {(i, t) for i, t in pairs(stages[2]) if i is not None} == {(i, want[i][2]) for i, _ in rows}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].filter("doc_id < 60").collect())


def test_one_of_each_group_of_copies(stages):
    rows = dict((i, t) for i, t in pairs(stages[2]) if i is not None)
    found = brute.components(sorted(rows.items()))
    kept = [i for i, _ in pairs(stages[3]) if i is not None]
    assert sorted(kept) == sorted(i for i in rows if found[i][1] == i)
    assert not {200, 201, 202} & set(kept) and {5, 7, 8, 303} <= set(kept)


def test_benchmark_items_go(stages):
    before, after = ({i for i, _ in pairs(df)} for df in stages[3:5])
    gone = {i for i, _ in brute.contaminated([(i, t) for i, t in pairs(stages[3]) if i is not None], [(1, prose(77, 30))])}
    assert before - after == gone and 203 in gone


def test_all_that_is_left_is_packed(stages):
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(vocabulary()), stages[5].collect()
    total = {}
    for i, t in pairs(stages[4]):
        total[i] = total.get(i, 0) + len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    held = {}
    for r in pieces:
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert held == total
    brute.packed_well([(r["sequence_id"], r["offset"], r["length"]) for r in pieces], 4096)


def test_run_gives_the_last_stage(spark, folder, stages):
    key = lambda df: sorted(((r["doc_id"], r["piece"], r["ids_crc32"]) for r in df.collect()), key=str)
    assert key(corpus_pipeline.run(spark, folder)) == key(stages[5])


def test_workers_forget_what_other_steps_have_kept():
    kept("words", list).append(1)
    assert kept("words", list) == [1]
    assert list(freed(lambda batches: iter(kept("words", list)), keeps="words")([])) == [1]
    assert list(freed(lambda batches: batches)([])) == []
    assert kept("words", list) == []


def test_stages_hand_small_batches_to_workers(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, want in ((10_000, 1000), (0, 1000), (50, 50)):
            spark.conf.set(key, given)
            corpus_pipeline.in_small_batches(spark)
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, before)
