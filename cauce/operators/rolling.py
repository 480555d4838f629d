"""Sliding aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG_LIMIT = 9e18  # below the largest long by more than doubles are rounded


def daily_totals(rows: DataFrame, key: str, day: str, amount: str, sign: Column | None = None) -> DataFrame:
    """Per key and day, count (_n), sum (_s) and sum of squares (_q) of an amount in cents.

    Rows whose ``sign`` is -1 are taken away instead of added.
    """
    cents = (F.col(amount) * 100).cast("decimal(16,0)")
    if sign is None:
        parts = F.count(amount), F.sum(cents), F.sum(cents * cents)
    else:
        present = F.col(amount).isNotNull().cast("int")
        parts = tuple(F.sum(F.when(sign == 1, c).otherwise(-c)) for c in (present, cents, cents * cents))
    return rows.groupBy(key, day).agg(*(p.alias(c) for p, c in zip(parts, ("_n", "_s", "_q"))))


def trailing_day_totals(rows: DataFrame, key: str, day: str, amount: str, days: int) -> DataFrame:
    """Per key and day, count, sum and sum of squares of the ``days`` days before that day.

    The rows are first reduced to one per key and day, with partial sums in the map tasks. The window
    then runs over days: a key with a third of all rows is a few thousand rows there, and each frame
    holds at most ``days`` of them. Amounts count in cents, as decimals, so sums are exact and do
    not depend on the order in which tasks deliver them.
    """
    daily = daily_totals(rows, key, day, amount)
    before = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    return daily.select(
        key,
        day,
        F.sum("_n").over(before).alias("trailing_n"),
        F.sum("_s").over(before).alias("trailing_sum"),
        F.sum("_q").over(before).alias("trailing_squares"),
    )


def trailing_mean() -> Column:
    """Mean in currency units from the totals above; NULL without rows."""
    n = F.nullif(F.col("trailing_n"), F.lit(0))
    return F.col("trailing_sum").cast("double") / 100 / n


def trailing_deviation() -> Column:
    """Sample deviation in currency units from the totals above; NULL below two rows.

    Squares count from the whole part ``m`` of the mean, not from zero: with ``sum = n * m + rest``
    they add up to ``squares - n * m * m - 2 * m * rest``. All of it is whole numbers, so nothing
    cancels, however large and close the amounts are. A frame whose
    squares, or whose spread times ``n * n``, exceed 38 digits in cents fails the job.

    Where ``n * squares`` fits into a long, so does ``sum * sum``, which is never larger: there the spread is the
    difference of the two. It is the same whole number, without the arithmetic of long decimals.
    """
    n, s, q = F.col("trailing_n"), F.col("trailing_sum"), F.col("trailing_squares")
    short = n.cast("double") * q.cast("double") < LONG_LIMIT
    whole = n.cast("decimal(20,0)")
    m = F.expr("trailing_sum div nullif(trailing_n, 0)").cast("decimal(19,0)")
    rest = (s - whole * m).cast("decimal(20,0)")
    around = q - (whole * m) * m - F.lit(2).cast("decimal(1,0)") * m * rest
    by_longs = n.cast("bigint") * q.cast("bigint") - s.cast("bigint") * s.cast("bigint")
    spread = F.when(short, by_longs.cast("double")).otherwise((whole * around - rest * rest).cast("double"))
    pairs = F.when(n > 1, n.cast("double") * (n - 1).cast("double"))
    return F.sqrt(spread / pairs) / 100


def trailing_row_sum(value: Column, key: str, order: str, rows: int) -> Column:
    """Sum over the current and the ``rows - 1`` previous rows of the key."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(1 - rows, 0)
    return F.sum(value).over(frame)
