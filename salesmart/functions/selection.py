"""Exact shares of classes without ranking their rows.

The rows of a class that have the smallest order values are found by radix selection: rows
are counted by class and leading digit, the digit that holds the last wanted row is kept for
the next round, and so on. A round brings (classes x 2^digit) counts at most to the
driver, whatever the number of rows, and one class with nearly all rows is counted in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order values are non-negative and have so many bits.
BITS = 60


def hash_order(key: str | Column, seed: int = 42) -> Column:
    """A number of ``BITS`` bits that follows from a key alone: the first 15 hex digits of an MD5."""
    text = F.concat_ws(":", (F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _by_class(kind: Column, values: dict[str, int], missing: int) -> Column:
    if not values:
        return F.lit(missing).cast("long")
    pairs = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return F.coalesce(F.try_element_at(pairs, kind), F.lit(missing).cast("long"))


def class_cuts(rows: DataFrame, kind: Column, order: Column, percent: int, digit: int = 12) -> dict[str, int]:
    """For each class the order value up to which ``percent`` in a hundred of its rows lie, to the nearest row.

    ``rows`` is read once a round, five times at most: pass a stored table. Rows of equal order value are
    never parted. A class none of whose rows is wanted is left out.
    """
    rows = rows.select(kind.alias("kind"), order.alias("at"))
    left: dict[str, int] = {}  # rows still wanted inside the kept digits
    prefix: dict[str, int] = {}
    cuts: dict[str, int] = {}
    shift = BITS
    while shift > 0 and (shift == BITS or prefix):
        shift = max(0, shift - digit)
        inside = rows if not prefix else rows.where(F.shiftright("at", shift + digit) == _by_class(F.col("kind"), prefix, -1))
        counts: dict[str, list[tuple[int, int]]] = {}
        for r in inside.groupBy("kind", F.shiftright("at", shift).alias("head")).agg(F.count("*").alias("n")).collect():
            counts.setdefault(r["kind"], []).append((r["head"], r["n"]))
        if shift + digit >= BITS:
            left = {k: (sum(n for _, n in found) * percent + 50) // 100 for k, found in counts.items()}
        prefix = {}
        for kind_, found in counts.items():
            for head, n in sorted(found):
                if left[kind_] < n:
                    if left[kind_] and shift:
                        prefix[kind_] = head
                    elif left[kind_]:
                        cuts[kind_] = head  # equal values stay together
                    break
                left[kind_] -= n
                cuts[kind_] = ((head + 1) << shift) - 1
                if not left[kind_]:
                    break
    return cuts


def first_share(rows: DataFrame, kind: str | None, order: Column, percent: int) -> Column:
    """Whether a row of the stored table ``rows`` is among the first ``percent`` in a hundred of its class; null is a class of its own."""
    name = F.lit("all") if kind is None else F.coalesce(F.concat(F.lit("="), F.col(kind).cast("string")), F.lit("null"))
    return order <= _by_class(name, class_cuts(rows, name, order, percent), -1)
