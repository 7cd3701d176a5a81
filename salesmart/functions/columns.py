"""Scalar expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal digits kept by exact sums of money and of unit prices.
MONEY = 4
PRICE = 7


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_completed(status: str | Column = "order_status") -> Column:
    """Completed orders only, ignoring case and padding."""
    return F.upper(F.trim(col(status))) == "COMPLETED"


def _parts(c: str | Column, digits: int) -> tuple[Column, Column]:
    """Whole part and the rest in units of 10^-digits, both as long."""
    value = col(c).cast("double")
    whole = F.floor(value)
    return whole, F.floor((value - whole) * float(10**digits) + 0.5)


def _joined(whole: Column, rest: Column, digits: int) -> Column:
    scale = float(10**digits)
    return (whole.cast("double") * scale + rest.cast("double")) / scale


def exact_sum(c: str | Column, digits: int = MONEY) -> Column:
    """Sum that does not depend on row order.

    Doubles would add up differently for every partitioning, and decimals cost
    several times more. Two long sums (whole part and fraction) are exact, stay in
    generated code and hold at 10^11 rows of one group; ANSI mode reports an overflow.
    """
    whole, rest = _parts(c, digits)
    return _joined(F.sum(whole), F.sum(rest), digits)


def exact_sum_over(c: str | Column, window, digits: int = MONEY) -> Column:
    whole, rest = _parts(c, digits)
    return _joined(F.sum(whole).over(window), F.sum(rest).over(window), digits)


def exact_avg(c: str | Column, digits: int = MONEY) -> Column:
    """Order-independent mean (NULL on no rows)."""
    return exact_sum(c, digits) / F.count(col(c))


def on_grid(c: str | Column, digits: int = MONEY) -> Column:
    """Nearest multiple of 10^-digits."""
    return _joined(*_parts(c, digits), digits)


def zero(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def zero_int(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0)).cast("long")


def safe_percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100``, and 0 where the denominator is not positive."""
    return F.when(col(whole) > 0, col(part) / col(whole) * 100).otherwise(F.lit(0.0))


def safe_ratio(part: str | Column, whole: str | Column) -> Column:
    return F.when(col(whole) > 0, col(part) / col(whole)).otherwise(F.lit(0.0))


def month_key(date: str | Column) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def month_start(date: str | Column) -> Column:
    """First day of the month: the cheap grouping key; format it after the aggregation."""
    return F.trunc(col(date), "month")


# Weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_name(number: str | Column) -> Column:
    """Name of a 0-based weekday number."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAYS]), col(number) + 1)


def is_weekend(date: str | Column) -> Column:
    return F.weekday(col(date)) >= 5


def day_type(date: str | Column) -> Column:
    return F.when(is_weekend(date), "weekend").otherwise("weekday")


def hour_of(time_text: str | Column) -> Column:
    """Hour of an ``HH:MM:SS`` text; NULL unless it is a valid clock time."""
    t = col(time_text)
    valid = t.rlike(r"^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    return F.when(valid, F.substring_index(t, ":", 1).cast("int"))


# Day-part boundaries (inclusive hours) and labels.
DAY_PARTS = [(7, 10, "Morning"), (11, 14, "Lunch Peak"), (15, 17, "Afternoon"), (18, 21, "Dinner Peak")]
OTHER_DAY_PART = "Late / Off-Peak"


def day_part(hour: str | Column) -> Column:
    h = col(hour)
    out = None
    for first, last, label in DAY_PARTS:
        test = h.between(first, last)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(OTHER_DAY_PART)


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def optional_id(c: str | Column) -> Column:
    """Optional identifier as text: NULL/blank -> '', 77.0 -> '77'."""
    as_number = col(c).cast("string").try_cast("double").try_cast("long")
    return F.coalesce(as_number.cast("string"), F.lit(""))


def trend_percent(value: str | Column, previous: str | Column) -> Column:
    """Change against the previous period in percent, NULL without a base."""
    v, p = col(value), col(previous)
    return F.when(p != 0, (v - p) / F.abs(p) * 100)
