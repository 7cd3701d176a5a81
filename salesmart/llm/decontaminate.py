"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names and units become typed placeholders, adjacent numbers or names one of
them, so a question keeps its template when its figures and names are exchanged. Windows
of template tokens are hash-joined with those of the benchmark: the benchmark offers
every window, a document every ``stride``-th, so any shared run of ``size + stride - 1``
tokens is met. Each meeting fixes a shift between document and item. Around it they are
compared token by token, at this shift alone and at several shifts in order, as words
that were added or dropped move what follows; the values in the slots must map one to one.
Names are told by their capitals, so a re-cased copy loses them: all of it is also done on
a plain form, where names are words without case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.storage import materialize

# Marks inside canonical texts: a name, a number, a unit, a separator inside a number, one between joined numbers, one between joined names.
NAME, NUMBER, UNIT, INNER, BOTH, NAMES = "\u0002", "\u0003", "\u0004", "\u0005", "\u0006", "\u0007"
TOKEN = r"\p{L}\p{N}\x{2}-\x{7}"
#: Units of measure, as fixed values.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds ton tons "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent degrees mph kmh kw kwh watt watts volt volts"
)


#: Shifts this far from a met one are tried without a window of their own.
NEAR = 8
#: Tokens a further shift has to add at least, less one half.
TURN = 1.5


def marked(text: Column) -> Column:
    """``text`` with names and units marked by a leading sign, and numbers and adjacent names or numbers in one piece."""
    x = F.coalesce(text, F.lit(""))
    x = F.regexp_replace(x, r"[\x{2}-\x{7}]", " ")
    x = F.regexp_replace(x, r"(?U)(?: +[^\S ]|[^\S ]|  )\s*", " ")
    x = F.regexp_replace(x, r"[.,:/](?<=\p{Nd}[.,:/])(?=\p{Nd})", INNER)
    x = F.regexp_replace(x, rf"(\p{{Nd}})[ -]?(?i:({'|'.join(UNITS.split())}))(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}$2")
    x = F.regexp_replace(x, r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})\p{Ll}\p{L}*", NAME + "$0")
    x = F.regexp_replace(x, rf"({NAME}[\p{{L}}\p{{N}}{INNER}]*)[^{TOKEN}]+(?={NAME})", f"$1{NAMES}")
    return F.regexp_replace(x, rf"(\p{{Nd}}(?<![{TOKEN}]\p{{Nd}})[\p{{L}}\p{{N}}{INNER}]*)[^{TOKEN}]+(?=\p{{Nd}})", f"$1{BOTH}")


def plain(mark: Column) -> Column:
    """A marked text without its names, and without case."""
    # Upper before lower makes ß and ss equal; side by side, the optimizer would drop the upper.
    return F.lower(F.replace(F.replace(F.upper(mark), F.lit(NAMES), F.lit(" ")), F.lit(NAME), F.lit("")))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[^{TOKEN}]+"), "")


def values(mark: Column) -> list[Column]:
    """Tokens of a marked text, in either form."""
    return [tokens(mark), tokens(plain(mark))]


def typed(mark: Column) -> Column:
    """A marked text with placeholders for numbers and units."""
    x = F.regexp_replace(mark, rf"{UNIT}[\p{{L}}\p{{N}}{INNER}]*", UNIT)
    return F.regexp_replace(x, rf"\p{{Nd}}(?<![{TOKEN}]\p{{Nd}})[\p{{L}}\p{{N}}{INNER}{BOTH}]*", NUMBER)


def templates(texts: DataFrame, key: Column) -> DataFrame:
    """``key``, and ``words0`` with template tokens (placeholders, and other words in lower case) and ``words1`` with those of the plain form."""
    rows = texts.select(key, typed(marked(F.col("text"))).alias("_typed"))
    names = F.regexp_replace("_typed", rf"{NAME}[\p{{L}}\p{{N}}{NAME}{INNER}{NAMES}]*", NAME)
    return rows.select(rows.columns[0], tokens(F.lower(names)).alias("words0"), tokens(plain(F.col("_typed"))).alias("words1"))


def as_template(token: Column) -> Column:
    """The template token of one of :func:`values`; agrees with :func:`templates`."""
    first = F.substring(token, 1, 1)
    return F.when(first.isin(NAME, UNIT), first).when(first.rlike(r"\p{Nd}"), NUMBER).otherwise(F.lower(token))


def window_hashes(words: Column, size: int, stride: int) -> Column:
    """Hash of the ``size`` tokens from each ``stride``-th place; null for shorter texts."""
    starts = F.sequence(F.lit(0), F.size(words) - size, F.lit(stride))
    return F.when(F.size(words) >= size, F.transform(starts, lambda i: hash_of(words, i, size)))


def hash_of(words: Column, start: Column, size: int) -> Column:
    """Hash of up to ``size`` tokens from ``start``; places behind the end are null, which changes no hash."""
    return F.xxhash64(*[F.get(words, start + k) for k in range(size)])


def benchmark_windows(items: DataFrame, size: int) -> DataFrame:
    """``hash, form, item_id, at, n, size`` of every window of every item that holds a word besides placeholders; a short item is one window."""
    words = templates(items, F.col("item_id")).select("item_id", F.posexplode(F.array("words0", "words1")).alias("form", "words")).withColumn("n", F.size("words")).filter("n > 0")
    words = words.withColumn("size", F.least("n", F.lit(size)))
    starts = F.sequence(F.lit(0), F.col("n") - F.col("size"))
    spread = words.select("form", "item_id", "words", "n", "size", F.explode(starts).alias("at")).withColumn("hash", hash_of(F.col("words"), F.col("at"), size))
    worded = F.exists(F.slice("words", F.col("at") + 1, F.col("size")), lambda w: ~w.isin(NAME, NUMBER, UNIT))
    return materialize(spread.filter(worded).select("hash", "form", "item_id", "at", "n", "size").distinct(), "benchmark-windows")


def strides(windows: DataFrame, size: int, stride: int) -> dict[int, int]:
    """Window size -> stride in documents: 1 where an item is too short for the guarantee of ``stride``."""
    kinds = windows.select(F.when(F.col("n") < size + stride - 1, F.col("size")).alias("short")).distinct().collect()  # at most ``size`` + 1 rows
    return {size: stride} | {r["short"]: 1 for r in kinds if r["short"]}


def alignments(docs: DataFrame, windows: DataFrame, size: int, stride: int) -> DataFrame:
    """``_key, _met``: documents with the items, forms, lengths and the shifts at which a window of both agrees."""
    words = templates(docs, key_of(docs))

    def placed(form: int, size: int, stride: int) -> Column:
        return F.transform(window_hashes(F.col(f"words{form}"), size, stride), lambda h, i: F.struct(F.lit(form).alias("form"), F.lit(size).alias("size"), (i * stride).alias("place"), h.alias("hash")))

    hashes = [placed(form, *kind) for kind in strides(windows, size, stride).items() for form in (0, 1)]
    none = F.expr("cast(array() as array<struct<form:int,size:int,place:int,hash:bigint>>)")
    spread = words.select("_key", F.explode(F.concat(*(F.coalesce(h, none) for h in hashes))).alias("w")).select("_key", "w.*")
    met = spread.join(windows, ["hash", "form", "size"]).withColumn("shift", F.col("place") - F.col("at"))
    each = met.groupBy("_key", "item_id", "form", "n").agg(F.collect_set("shift").alias("shifts"))
    return materialize(each.groupBy("_key").agg(F.collect_list(F.struct("item_id", "form", "n", "shifts")).alias("_met")), "alignments")


def key_of(docs: DataFrame) -> Column:
    """A row of equal id and text has an equal key."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "text").alias("_key")


def stretches(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, _item, _form, _held, _base, _lanes``: the tokens of a document around a met shift, and the shifts to try there."""
    rows = docs.select(key_of(docs), F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(found, "_key")
    rows = rows.select("doc_id", "_met", marked(F.col("text")).alias("_mark")).select("doc_id", "_met", F.array(*values(F.col("_mark"))).alias("_both"))
    rows = rows.select("doc_id", "_both", F.explode("_met").alias("m")).select("doc_id", "m", F.get("_both", F.col("m.form")).alias("_words"))
    rows = rows.select("doc_id", "_words", F.col("m.item_id").alias("_item"), F.col("m.form").alias("_form"), F.col("m.n").alias("n"), F.col("m.shifts").alias("shifts"), F.explode("m.shifts").alias("shift"))
    reach = F.greatest("n", F.lit(NEAR))
    start = F.greatest(F.col("shift") - reach, F.lit(0))
    lanes = F.array_union(F.filter("shifts", lambda s: F.abs(s - F.col("shift")) <= F.col("n")), F.sequence(F.col("shift") - NEAR, F.col("shift") + NEAR))
    held = F.slice("_words", start + 1, F.greatest(F.col("shift") + reach + F.col("n") - start, F.lit(0)))
    return rows.select("doc_id", "_item", "_form", held.alias("_held"), (F.col("shift") - start).alias("_base"), F.transform(F.array_sort(lanes), lambda s: s - start).alias("_lanes"))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_order(lanes: Column, asked: Column, held: Column) -> Column:
    """Places ``q, d`` of agreeing tokens, rising in both, where the shifts ``lanes`` take turns; a turn costs ``TURN`` tokens."""

    def step(state: Column, i: Column) -> Column:
        def lane(own: Column, shift: Column) -> Column:
            turned = F.struct((state["best"]["score"] - TURN).alias("score"), state["best"]["last"].alias("last"), state["best"]["pairs"].alias("pairs"))
            place = i + shift

            def on(before: Column) -> Column:
                agree = (place > before["last"]) & F.coalesce(F.get(asked, i) == F.get(held, place), F.lit(False))
                pair = F.array(F.struct(i.alias("q"), place.alias("d")))
                more = F.struct((before["score"] + 1).alias("score"), place.alias("last"), F.concat(before["pairs"], pair).alias("pairs"))
                return F.when(agree, more).otherwise(before)

            return let(F.when(turned["score"] > own["score"], turned).otherwise(own), on)

        return let(F.zip_with(state["all"], lanes, lane), lambda new: F.struct(F.array_max(new).alias("best"), new.alias("all")))

    nothing = F.expr("named_struct('score', 0D, 'last', -1, 'pairs', cast(array() as array<struct<q:int,d:int>>))")
    start = F.struct(nothing.alias("best"), F.transform(lanes, lambda _: nothing).alias("all"))
    return F.aggregate(F.sequence(F.lit(0), F.size(asked) - 1), start, step, lambda end: end["best"]["pairs"])


def matches(docs: DataFrame, items: DataFrame, size: int = 8, stride: int = 4, coverage: float = 0.6) -> DataFrame:
    """``doc_id, item_id, coverage, n_slots, n_changed`` of documents that hold a benchmark item.

    A document holds an item when at least the share ``coverage`` of the item's template
    tokens agree with tokens of the document and the slots are consistent: equal values of
    the item stand for equal values of the document and the other way round. Agreeing tokens
    are counted at one shift, and at several in order: those met at most an item's length
    from the first, and all within ``NEAR`` of it; with names as placeholders, or as words
    without case, whichever agrees in more. ``n_changed`` counts slots with
    another value (0: verbatim). Of several alignments the fullest counts. An item is met
    where ``size + stride - 1`` tokens in a row agree, one of fewer tokens where ``size`` do,
    and one of less than ``size`` tokens where all do; items of placeholders alone match
    nothing. Null and empty texts hold nothing; null ids are kept; repeated rows are answered once.
    """
    items = items.select(F.col("item_id").cast("bigint"), "text").filter("item_id IS NOT NULL")
    found = alignments(docs, benchmark_windows(items, size), size, stride)
    asked = items.select(F.col("item_id").alias("_item"), marked(F.col("text")).alias("_mark"))
    asked = asked.select("_item", F.posexplode(F.array(*values(F.col("_mark")))).alias("_form", "_asked")).distinct()
    rows = stretches(docs, found).join(asked, ["_item", "_form"])
    # Stored, so that no token is made again inside the comparisons.
    rows = materialize(rows.select("*", F.transform("_asked", as_template).alias("_q"), F.transform("_held", as_template).alias("_d")).distinct(), "stretches")
    single, several = (in_order(lanes, F.col("_q"), F.col("_d")) for lanes in (F.array("_base"), F.col("_lanes")))
    n = F.size("_asked")
    rows = rows.withColumn("_one", single).withColumn("_ways", F.when(F.size("_one") == n, F.array("_one")).otherwise(F.array("_one", several)))
    rows = rows.select("doc_id", "_item", "_asked", "_q", "_held", F.explode("_ways").alias("_pairs"))
    slot = lambda p: F.struct(F.lower(F.get("_asked", p["q"])).alias("q"), F.lower(F.get("_held", p["d"])).alias("d"))
    slots = F.transform(F.filter("_pairs", lambda p: F.get("_q", p["q"]).isin(NAME, NUMBER, UNIT)), slot)
    rows = rows.withColumn("_slots", slots).withColumn("coverage", F.size("_pairs") / n)
    kinds = F.size(F.array_distinct("_slots"))
    one_to_one = (kinds == F.size(F.array_distinct("_slots.q"))) & (kinds == F.size(F.array_distinct("_slots.d")))
    good = rows.filter((F.col("coverage") >= coverage) & one_to_one)
    changed = F.size(F.filter("_slots", lambda p: p["q"] != p["d"]))
    best = good.groupBy("doc_id", F.col("_item").alias("item_id")).agg(F.max(F.struct("coverage", (-changed).alias("same"), F.size("_slots").alias("n_slots"))).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.coverage").alias("coverage"), F.col("best.n_slots").alias("n_slots"), (-F.col("best.same")).alias("n_changed"))


def clean(docs: DataFrame, items: DataFrame, size: int = 8, stride: int = 4, coverage: float = 0.6) -> DataFrame:
    """The documents, as given, that hold no benchmark item; rows without an id are judged as one document."""
    held = materialize(matches(docs, items, size, stride, coverage).select(F.col("doc_id").alias("_held_id")).distinct(), "contaminated")
    return docs.join(held, docs["doc_id"].cast("bigint").eqNullSafe(held["_held_id"]), "left_anti")
