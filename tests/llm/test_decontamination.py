"""Decontamination of changed, short and re-cased copies."""

from pyspark.sql import functions as F

from salesmart.llm import decontaminate

ITEM = "the farmer named Smith keeps 50 hens in one barn and sells every egg for 3 dollars on each market day of the long year"


def held(spark, documents, items, rows):
    found = decontaminate.matches(documents(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    return {(r["doc_id"], r["item_id"]): (r["coverage"], r["n_changed"]) for r in found}


def test_changes_of_another_token_count(spark, documents):
    middle = "and sells every egg"
    rows = [
        (1, ITEM.replace("Smith", "Van Houten")),
        (2, ITEM.replace("50", "1 000")),
        (3, ITEM.replace(middle, "and then sells every egg")),
        (4, ITEM.replace(middle, "and sells egg")),
        (5, "word " * 50 + ITEM.replace(middle, "and, as is well known to all, sells every egg") + " word" * 30),
        (6, ITEM.split(" and ")[0] + " and so they go"),
        (7, ITEM.split(" every ")[1] + " every " + ITEM.split(" every ")[0]),
    ]
    got = held(spark, documents, [(1, ITEM)], rows)
    n = 25  # template tokens
    # Halves in the wrong order (7) do not add up.
    assert got == {(1, 1): (1.0, 1), (2, 1): (1.0, 1), (3, 1): (1.0, 0), (4, 1): ((n - 1) / n, 0), (5, 1): (1.0, 0)}


def test_short_items(spark, documents):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(1, 13)] + [(20, "what makes 5 plus 7"), (21, "12 km"), (22, ""), (23, "?!")]
    rows = [(100 * n + pad, "zz " * pad + text + " zz" * 9) for n, text in items for pad in range(4)] + [(5, "tell me what makes 3 plus 9 please"), (6, "w9x0 w9x1 w9x2 w9x4 w9x5 w9x6 w9x7 w9x8")]
    got = held(spark, documents, items, rows)
    assert got == {(100 * n + pad, n): (1.0, 0) for n in [*range(1, 13), 20] for pad in range(4)} | {(5, 20): (1.0, 2)}


def test_recased_and_rewrapped_copies(spark, documents):
    item = "wenn der Bauer Schmidt mit der Kuh zum Markt in die große Stadt geht und seine Frau mit dem Esel zur Mühle am Fluss reitet, wer ist früher am Ziel"
    lines = item.replace(" der ", " der\n").replace(" mit ", "  mit\t\u00a0").replace("Frau", "\r\nFrau")
    rows = [(1, item.upper()), (2, item.lower()), (3, item.replace(" ", "  ")), (4, item.replace(" ", "\n")), (5, lines), (6, "vorher " * 9 + item.title() + " danach"), (7, item)]
    got = held(spark, documents, [(1, item)], rows)
    assert got == {(i, 1): (1.0, 0) for i in range(1, 8)}
    kept = decontaminate.clean(documents(rows + [(8, "der Bauer Schmidt geht heute mit der Kuh nach Hause")]), spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert [r["doc_id"] for r in kept.collect()] == [8]


def test_windows_are_hashed_without_joining_their_tokens(spark, documents, capsys):
    words = spark.createDataFrame([(1, list("abcdab")), (2, list("ab")), (3, [])], "id int, words array<string>")
    found = words.select("id", decontaminate.window_hashes(F.col("words"), 2, 2).alias("h"))
    got = {r["id"]: r["h"] for r in found.collect()}
    assert len(set(got[1])) == 2 and got[1][0] == got[1][2] == got[2][0] and got[3] is None
    # A window of all tokens of a short text has the hash of a window of that size.
    assert words.filter("id = 2").select(decontaminate.hash_of(F.col("words"), F.lit(0), 8)).first()[0] == got[2][0]
    decontaminate.templates(documents([(1, ITEM)]), F.col("doc_id")).select(decontaminate.window_hashes(F.col("words1"), 8, 4)).explain()
    plan = capsys.readouterr().out
    assert "xxhash64" in plan and not any(f"{step}(" in plan for step in ("array_join", "slice", "translate"))
