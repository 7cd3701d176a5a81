"""All quality checks of a table, compiled from its contract into three scans.

* Row rules (unreadable numbers and dates, negative values, ranges, period, own conditions)
  and the profile are conditional counts of one aggregate.
* Uniqueness (key, whole row, business line) is one scan: a row becomes one exploded array with an
  identity of two longs for each set of columns, counted by set and identity.
* References are one scan: a row becomes one exploded array of (reference, key), reduced to
  distinct keys with their counts before it meets the parents' keys in one grouping. A key with much of the table
  is a few partial rows by then.

``violations`` gives the keys of failing rows, again from one scan: the failed rules of a
row are one array, exploded.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.sources import contracts

NUMBERS = ("BIGINT", "INT", "DOUBLE")


def numeric(df: DataFrame) -> set[str]:
    """Columns that hold numbers already: every value of theirs is readable."""
    return {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}


def row_rules(table: str, columns: list[str], start: str, end: str, numbers: Collection[str] = ()) -> dict[str, Column]:
    """Check -> failing condition of every row rule of ``table``; columns of the contract that are not there are left out.

    The columns ``numbers`` are of a numeric type and need not be read from text.
    """

    def present(name: str) -> Column:
        return F.trim(F.col(name).cast("string")) != ""

    def have(names: list[str]) -> list[str]:
        return [n for n in names if n in columns]

    rules: dict[str, Column] = {}
    for n in have(contracts.typed_columns(table, *NUMBERS)):
        rules[f"invalid_number_{n}"] = F.lit(False) if n in numbers else present(n) & F.col(n).cast("string").try_cast("double").isNull()
    for n in have(contracts.typed_columns(table, "DATE")):
        rules[f"invalid_date_{n}"] = present(n) & F.try_to_date(F.col(n).cast("string"), "yyyy-MM-dd").isNull()
    for n in have(contracts.NON_NEGATIVE.get(table, [])):
        rules[f"negative_{n}"] = (F.col(n) if n in numbers else F.col(n).cast("string").try_cast("double")) < 0
    for n in have(contracts.PERIOD_DATES.get(table, [])):
        rules[f"{n}_outside_period"] = ~F.coalesce(F.col(n).cast("string").between(start, end), F.lit(False))
    rules |= {check: F.expr(condition) for check, condition in contracts.ROW_RULES.get(table, {}).items()}
    rules["pk_null"] = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in contracts.PRIMARY_KEYS[table]])
    return rules


def _long(sums: DataFrame, dataset: str, names: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("long").alias("failures")) for n in names])
    return sums.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def check_rows(df: DataFrame, dataset: str, rules: Mapping[str, Column]) -> DataFrame:
    """``dataset, check, failures`` of all row rules and of the missing cells, from one aggregate over ``df``."""
    missing = reduce(lambda a, b: a + b, [F.col(f"`{n}`").isNull().cast("long") for n in df.columns])
    counts = {"missing_cells": F.sum(missing)} | {check: F.count_if(F.coalesce(p, F.lit(False))) for check, p in rules.items()}
    return _long(df.agg(*[x.alias(check) for check, x in counts.items()]), dataset, list(counts))


KEY = ["set", "a", "b", "nulls"]
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def whole(df: DataFrame, columns: list[str]) -> bool:
    """Whether the columns are one or two of whole numbers, which ``_identity`` keeps as they are."""
    return len(columns) <= 2 and all(isinstance(df.schema[c].dataType, WHOLE) for c in columns)


def _identity(number: int, cells: list[Column], kept: bool) -> Column:
    """What tells apart the combinations of ``cells`` in the set of columns ``number``: two longs and a mark for nulls.

    ``kept`` values stand for themselves. Other combinations, of any width, are two 64-bit hashes over the values
    and their null marks, in either order of the cells.
    """
    missing = [x.isNull() for x in cells]
    if kept:
        longs = [F.coalesce(x.cast("long"), F.lit(0).cast("long")) for x in cells] + [F.lit(0).cast("long")]
        parts = [*longs[:2], reduce(lambda a, b: a + b, [x.cast("int") * (k + 1) for k, x in enumerate(missing)])]
    else:
        any_null = F.when(reduce(lambda a, b: a | b, missing), 1).otherwise(0)
        parts = [F.xxhash64(F.array(*missing), *cells), F.xxhash64(F.lit("again"), *reversed(cells), F.array(*missing)), any_null]
    return F.struct(F.lit(number).alias("set"), *[x.alias(n) for x, n in zip(parts, KEY[1:], strict=True)])


def check_unique(df: DataFrame, dataset: str, sets: Mapping[str, list[str]]) -> DataFrame:
    """Rows beyond the first of each combination of columns, for several sets of columns in one scan; nulls equal each other.

    Combinations repeat seldom, so they are dealt out before they are counted: no task holds those of its whole file split.
    """
    each = F.explode(F.array(*[_identity(k, [F.col(f"`{c}`") for c in columns], whole(df, columns)) for k, columns in enumerate(sets.values())]))
    groups = df.select(each.alias("x")).select("x.*").repartition(*KEY).groupBy(*KEY).agg(F.count("*").alias("n"))
    found = groups.agg(*[F.sum(F.when(F.col("set") == k, F.col("n") - 1)).alias(n) for k, n in enumerate(sets)])
    return _long(found, dataset, list(sets))


def check_references(df: DataFrame, dataset: str, references: list[tuple[str, list[str], DataFrame, list[str]]]) -> DataFrame:
    """Rows whose key the parent does not have, for all references of a table in one scan; a key with a null is unknown.

    A reference is (check, child columns, parent, parent columns); the parent's keys need not be unique. Keys are the same
    when their texts are. Keys of both sides meet in one grouping, each side reduced to distinct keys before.
    """
    kept = [whole(df, columns) and whole(parent, parent_columns) for _, columns, parent, parent_columns in references]

    def key(k: int, columns: list[str]) -> Column:
        return _identity(k, [F.col(c) if kept[k] else F.col(c).cast("string") for c in columns], kept[k])

    each = F.explode(F.array(*[key(k, columns) for k, (_, columns, _, _) in enumerate(references)]))
    children = df.select(each.alias("x")).select("x.*", F.lit(1).alias("n"), F.lit(0).alias("known"))
    parents = [parent.select(key(k, columns).alias("x")).where("x.nulls = 0").select("x.*", F.lit(0).alias("n"), F.lit(1).alias("known"))
               for k, (_, _, parent, columns) in enumerate(references)]
    keys = reduce(DataFrame.unionByName, parents, children).groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    found = keys.where("known = 0").agg(*[F.sum(F.when(F.col("set") == k, F.col("n"))).alias(check) for k, (check, *_) in enumerate(references)])
    return _long(found, dataset, [check for check, *_ in references])


def unique_sets(table: str, columns: list[str]) -> dict[str, list[str]]:
    sets = {"pk_duplicate": contracts.PRIMARY_KEYS[table], "duplicate_rows": columns}
    return sets | ({"duplicate_business_line": contracts.BUSINESS_LINE[table]} if table in contracts.BUSINESS_LINE else {})


def check_table(table: str, frames: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """Every check of one table; parents are looked up in ``frames``."""
    df = frames[table]
    parts = [check_rows(df, table, row_rules(table, df.columns, start, end, numeric(df))), check_unique(df, table, unique_sets(table, df.columns))]
    references = [(check, columns, frames[parent], parent_columns) for check, columns, parent, parent_columns in contracts.parents_of(table)]
    if references:
        parts.append(check_references(df, table, references))
    return reduce(DataFrame.unionByName, parts)


def check_all(frames: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """``dataset, check, failures`` of every check of every table of the contract that ``frames`` has."""
    return reduce(DataFrame.unionByName, [check_table(t, frames, start, end) for t in contracts.TABLES if t in frames])


def violations(df: DataFrame, dataset: str, rules: Mapping[str, Column], key: list[str]) -> DataFrame:
    """``dataset, check, key`` of every row rule that a row fails; ``key`` is a JSON object. One scan, no shuffle."""
    failed = F.array_compact(F.array(*[F.when(p, F.lit(check)) for check, p in rules.items()]))
    keys = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    return df.select(F.lit(dataset).alias("dataset"), F.explode(failed).alias("check"), keys.alias("key"))


def all_checks() -> list[str]:
    """Names of all checks of the contract, sorted: the columns of a pivoted report."""
    names = {"missing_cells"}
    for t in contracts.TABLES:
        columns = contracts.typed_columns(t, *NUMBERS, "DATE", "STRING")
        numbers, dates = contracts.typed_columns(t, *NUMBERS), contracts.typed_columns(t, "DATE")
        names |= {f"invalid_number_{n}" for n in numbers} | {f"invalid_date_{n}" for n in dates} | {f"negative_{n}" for n in contracts.NON_NEGATIVE.get(t, [])}
        names |= {f"{n}_outside_period" for n in contracts.PERIOD_DATES.get(t, [])} | set(contracts.ROW_RULES.get(t, {})) | {"pk_null"}
        names |= set(unique_sets(t, columns)) | {check for check, *_ in contracts.parents_of(t)}
    return sorted(names)
