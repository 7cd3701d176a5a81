"""Exact interpolated quantiles by iterated distributed selection.

A quantile lies between two ranks. A sketch names a bracket of values for each wanted
rank, exact counts tell whether the rank lies in it, and rows strictly inside it are
looked at again: sketched anew while they are more than ``fits``, else their distinct values
come to the driver with their counts. A bracket that missed its rank is left for the part
of the column beside it. Rows are only ever counted, so memory is bounded by ``fits`` values
for each rank at every size of the table, and there is no other form for small tables.

Nulls are left out. NaN counts as larger than all other values, as in Spark's order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.storage import concurrently

ACCURACY = 20_000
FITS = 50_000


@dataclass
class Target:
    """A rank of one column, and what is known to hold it: ``inside`` rows between two values (None: no end), from rank ``before`` on."""

    column: str
    rank: int
    inside: int
    before: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None


Bracket = tuple[float, float]


def _value(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v + F.lit(0.0))  # one zero; NaN is counted apart


def _between(v: Column, low: float | None, high: float | None) -> Column:
    out = v.isNotNull() if low is None else v > low
    return out if high is None else out & (v < high)


def _ends(p: float, accuracy: int) -> list[float]:
    """Probabilities on both sides of ``p`` by the sketch's error."""
    return [max(0.0, p - 2.0 / accuracy), min(1.0, p + 2.0 / accuracy)]


def _sketch(df: DataFrame, targets: list[Target], accuracy: int) -> list[Bracket]:
    """A bracket of values around each target's rank; targets of the same part of a column share a sketch."""
    parts: dict[tuple, list[float]] = {}
    places = []
    for t in targets:
        ends = parts.setdefault((t.column, t.low, t.high), [])
        places.append(((t.column, t.low, t.high), len(ends)))
        ends += _ends((t.rank - t.before) / max(1, t.inside - 1), accuracy)
    cells = [F.percentile_approx(F.when(_between(_value(c), low, high), _value(c)), ends, accuracy).alias(f"w{k}") for k, ((c, low, high), ends) in enumerate(parts.items())]
    row = dict(zip(parts, df.agg(*cells).first(), strict=True))
    return [(row[part][k], row[part][k + 1]) for part, k in places]


def _counts(df: DataFrame, keys: list[tuple[str, Bracket]]) -> dict[tuple[str, Bracket], tuple[int, int, int, int]]:
    """Rows below, at the low end of, strictly inside, and at the high end of each bracket: one row in all."""
    keys = list(dict.fromkeys(keys))
    out = []
    for column, (low, high) in keys:
        v = _value(column)
        out += [F.count_if(v < low), F.count_if(v == low), F.count_if((v > low) & (v < high)), F.count_if((v == high) & F.lit(low != high))]
    row = df.agg(*[c.alias(f"c{k}") for k, c in enumerate(out)]).first()
    return {key: tuple(row[4 * k : 4 * k + 4]) for k, key in enumerate(keys)}


def _values(df: DataFrame, keys: list[tuple[str, Bracket]], fits: int) -> dict[str, list[tuple[float, int]]] | None:
    """By column, the distinct values strictly inside any of its brackets with their counts, ascending; None when they are too many."""
    inside: dict[str, Column] = {}
    for column, (low, high) in dict.fromkeys(keys):
        here = _between(_value(column), low, high)
        inside[column] = inside[column] | here if column in inside else here
    cells = [F.when(here, F.struct(F.lit(c).alias("column"), _value(c).alias("v"))) for c, here in inside.items()]
    met = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    most = fits * len(keys)
    rows = met.limit(most + 1).collect()  # ``fits`` values for each target at most
    if len(rows) > most:
        return None
    out: dict[str, list[tuple[float, int]]] = {c: [] for c in inside}
    for r in sorted(rows, key=lambda r: r["cell"]["v"]):
        out[r["cell"]["column"]].append((r["cell"]["v"], r["n"]))
    return out


def _place(t: Target, bracket: Bracket, counts: tuple[int, int, int, int]) -> bool:
    """Take what the counts say about a target; True when it lies strictly inside the bracket counted."""
    (low, high), (below, at_low, inside, at_high) = bracket, counts
    if t.rank < below:  # missed: beside it, up to ``low``
        t.high, t.inside = low, below - t.before
    elif t.rank < below + at_low:
        t.value = low
    elif t.rank < below + at_low + inside:
        t.low, t.high, t.before, t.inside = low, high, below + at_low, inside
        return True
    elif t.rank < below + at_low + inside + at_high:
        t.value = high
    else:  # missed: beside it, from ``high`` on
        passed = below + at_low + inside + at_high
        t.low, t.inside, t.before = high, t.before + t.inside - passed, passed
    return False


def select_ranks(df: DataFrame, targets: list[Target], brackets: list[Bracket], accuracy: int = ACCURACY, fits: int = FITS) -> int:
    """Find ``value`` of every target, beginning with the given brackets; returns the rounds it took.

    Every round ends with a value, or with ends that lie strictly inside the ones before, so it comes to an end.
    """
    rounds = 0
    while targets:
        rounds += 1
        keys = [(t.column, b) for t, b in zip(targets, brackets, strict=True)]
        if all(4 * t.inside <= fits * accuracy for t in targets):  # then brackets should hold ``fits`` rows at most
            found = concurrently(counts=lambda: _counts(df, keys), values=lambda: _values(df, keys, fits))
        else:
            found = {"counts": _counts(df, keys), "values": None}
        for t, key in zip(targets, keys, strict=True):
            if _place(t, key[1], found["counts"][key]) and found["values"] is not None:
                seen = t.before
                for v, n in found["values"][t.column]:
                    seen += n if t.low < v < t.high else 0
                    if t.rank < seen:
                        t.value = v
                        break
        targets = [t for t in targets if t.value is None]
        brackets = _sketch(df, targets, accuracy) if targets else []
    return rounds


def find_quantiles(df: DataFrame, specs: Sequence[tuple[str, str, float]], accuracy: int = ACCURACY, fits: int = FITS) -> dict[str, float | None]:
    """Values of ``(name, column, probability)`` by name. Each round reads ``df`` again: pass a stored table."""
    probs: dict[str, list[float]] = {}
    for _, c, p in specs:
        probs.setdefault(c, []).append(p)
    first = [x for c, ps in probs.items() for x in (F.count(_value(c)), F.count_if(F.isnan(F.col(c).cast("double"))), F.percentile_approx(_value(c), [e for p in ps for e in _ends(p, accuracy)], accuracy))]
    row = df.agg(*[x.alias(f"x{k}") for k, x in enumerate(first)]).first()
    known = {c: row[3 * k : 3 * k + 3] for k, c in enumerate(probs)}
    targets: dict[tuple[str, int], Target] = {}
    brackets: dict[tuple[str, int], Bracket] = {}
    for c, ps in probs.items():
        n, nan, ends = known[c]
        for k, p in enumerate(ps):
            for rank in (math.floor(p * (n + nan - 1)), math.ceil(p * (n + nan - 1))) if n + nan else ():
                targets[c, rank] = Target(c, rank, inside=n, value=math.nan if rank >= n else None)
                brackets[c, rank] = (ends[2 * k], ends[2 * k + 1]) if n else (0.0, 0.0)
    wanted = [key for key, t in targets.items() if t.value is None]
    select_ranks(df, [targets[key] for key in wanted], [brackets[key] for key in wanted], accuracy, fits)
    out: dict[str, float | None] = {}
    for name, c, p in specs:
        n, nan, _ = known[c]
        position = p * (n + nan - 1)
        part = position - math.floor(position)
        a, z = (targets[c, r].value if n + nan else None for r in (math.floor(position), math.ceil(position)))
        out[name] = a if a == z or not part else (1 - part) * a + part * z
    return out


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float], accuracy: int = ACCURACY, fits: int = FITS) -> DataFrame:
    """One row with a column per entry of ``probs`` (name -> probability); null when the column has no value.

    ``df`` is read when this is called, twice as a rule: pass a table or a stored intermediate result.
    """
    found = find_quantiles(df, [(name, column, p) for name, p in probs.items()], accuracy, fits)
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(name) for name, v in found.items()])


def with_quantiles(df: DataFrame, specs: Sequence[tuple[str, str, float]], accuracy: int = ACCURACY, fits: int = FITS) -> DataFrame:
    """Append ``(name, column, probability)`` quantiles of ``df`` to every row, as constants.

    ``df`` is read when this is called, twice as a rule: pass a table or a stored intermediate result.
    """
    found = find_quantiles(df, specs, accuracy, fits)
    return df.select(*df.columns, *[F.lit(v).cast("double").alias(name) for name, v in found.items()])
