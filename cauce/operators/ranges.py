"""Disjoint key ranges of similar numbers of rows, for reading a table in parts.

The ranges come from sketches: ``percentile_approx`` over the key as a number. A date is its day. A text is
read three code points at a time: after the beginning that all keys share, the next three are one number in the order of the
texts. Where one such number holds too many rows, the texts that begin so are sketched again from there. A single value that is still
too heavy (a hot date, or missing keys) is cut by the next key.

The first range is open below, the last above, and missing keys are a part of their own, so any set of boundaries covers every
row once; the sketch decides only about sizes. A sketch of a sample does as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 3  # code points in a number
BITS = 21  # of a code point
POINTS = 8  # quantiles in a part
DAY = date(1970, 1, 1)


@dataclass(frozen=True)
class Bounds:
    """``low <= key < high``; None is open. ``missing`` means the rows without the key instead."""

    key: str
    low: Any = None
    high: Any = None
    missing: bool = False

    def condition(self, quoted: Callable[[str], str], collate: str = "") -> str | None:
        if self.missing:
            return f"{self.key} IS NULL"
        parts = [f"{self.key}{collate if isinstance(v, str) else ''} {op} {_literal(v, quoted)}"
                 for op, v in ((">=", self.low), ("<", self.high)) if v is not None]
        return " AND ".join(parts) if parts else f"{self.key} IS NOT NULL"


@dataclass(frozen=True)
class Part:
    """Rows within all bounds; ``rows`` is the sketch's estimate."""

    bounds: tuple[Bounds, ...]
    rows: float

    def spark_sql(self) -> str:
        return self._joined(lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'")

    def standard_sql(self, collate: str = "") -> str:
        """For a database. Texts must compare by code points: name a collation that does, if the database's own does not."""
        return self._joined(lambda v: "'" + v.replace("'", "''") + "'", f' COLLATE "{collate}"' if collate else "")

    def _joined(self, quoted: Callable[[str], str], collate: str = "") -> str:
        return " AND ".join(b.condition(quoted, collate) for b in self.bounds)


def _literal(value: Any, quoted: Callable[[str], str]) -> str:
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return quoted(value) if isinstance(value, str) else str(value)


@dataclass(frozen=True)
class _Cell:
    """Keys from ``low`` to the next cell's; ``single`` if all of them are one value."""

    low: Any
    rows: float
    single: bool = False


def _sketch(df: DataFrame, number: Column, points: int, by: list[str]) -> list:
    """Rows (by, n, quantiles): so many quantiles of the number, of all rows or by group."""
    shares = [i / points for i in range(1, points)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(number, shares, max(10_000, 20 * points)).alias("q")).collect()


def _runs(quantiles: Sequence[int]) -> list[tuple[int, int]]:
    """Distinct quantiles with the number of times that each occurs."""
    found: list[list[int]] = []
    for q in quantiles:
        if found and found[-1][0] == q:
            found[-1][1] += 1
        else:
            found.append([q, 1])
    return [tuple(x) for x in found]


def _encoded(key: Column, start: int) -> Column:
    """Three code points from ``start`` (from 0) as a number; 0 stands for the end of the text."""
    number = F.lit(0).cast("long")
    for k in range(WIDTH):
        char = F.substring(key, start + k + 1, 1)
        code = F.when(F.length(char) > 0, F.ascii(char).cast("long") + 1).otherwise(0)
        number = number * (1 << BITS) + code
    return number


def _decoded(number: int) -> tuple[str, bool]:
    """The text of a number, and whether a key ends with it."""
    codes = [(number >> BITS * k) & ((1 << BITS) - 1) for k in range(WIDTH - 1, -1, -1)]
    text = "".join(chr(c - 1) for c in codes if c)
    return text, 0 in codes


def _after(text: str) -> str | None:
    """The smallest text above all that begin with ``text``; None if there is none."""
    while text:
        code = ord(text[-1]) + 1
        if code <= 0x10FFFF:
            return text[:-1] + chr(0xE000 if 0xD800 <= code < 0xE000 else code)
        text = text[:-1]
    return None


def _text_cells(df: DataFrame, key: str, parts: int) -> list[_Cell]:
    column = F.col(key)
    least, most, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    shared = 0
    while shared < min(len(least), len(most)) and least[shared] == most[shared]:
        shared += 1
    if least == most:
        return [_Cell(least, n, single=True)]
    heavy = n / parts / 2
    done: dict[str, list[_Cell]] = {}  # cells below a beginning
    open_, start = [least[:shared]], shared
    while open_:
        begin = F.substring(column, 1, start)
        some = df.where(begin.isin(open_)).select(begin.alias("_begin"), _encoded(column, start).alias("_number"))
        found, open_ = _sketch(some, F.col("_number"), parts * POINTS, ["_begin"]), []
        for r in found:
            cells = [_Cell(r._begin, 0)]
            for number, times in _runs(r.q):
                text, ends = _decoded(number)
                rows = r.n * times / (parts * POINTS)
                if times == 1 or rows < heavy:
                    cells.append(_Cell(r._begin + text, rows))
                    continue
                cells.append(_Cell(r._begin + text, rows, single=ends))
                if not ends:
                    open_.append(r._begin + text)
                above = r._begin + text + "\0" if ends else _after(r._begin + text)
                if above is not None:
                    cells.append(_Cell(above, 0))
            done[r._begin] = cells
        start += WIDTH

    def flat(begin: str) -> list[_Cell]:
        return [x for c in done[begin] for x in (flat(c.low) if c.low in done and c.low != begin else [c])]
    return flat(least[:shared])


def _number_cells(df: DataFrame, key: str, parts: int) -> list[_Cell]:
    dated = isinstance(df.schema[key].dataType, T.DateType)
    number = F.unix_date(key) if dated else F.col(key).cast("long")
    value = (lambda v: DAY + timedelta(days=v)) if dated else (lambda v: v)
    cells = []
    for r in _sketch(df, number, parts * POINTS, []):
        for v, times in _runs(r.q or []):
            rows = r.n * times / (parts * POINTS)
            single = times > 1 and rows >= r.n / parts / 2
            cells += [_Cell(value(v), rows, single)] + ([_Cell(value(v + 1), 0)] if single else [])
    return cells


def _merged(cells: list[_Cell], target: float) -> list[_Cell]:
    """Cells put together to about ``target`` rows; heavy single values stay apart."""
    out: list[_Cell] = []
    for c in cells:
        if out and not out[-1].single and not (c.single and c.rows > target / 2) and out[-1].rows + c.rows <= 1.1 * target:
            out[-1] = _Cell(out[-1].low, out[-1].rows + c.rows)
        elif out and out[-1].low == c.low:
            out[-1] = c
        else:
            out.append(c)
    return out


def key_parts(df: DataFrame, keys: Sequence[str], parts: int) -> list[Part]:
    """Parts of ``df`` by ranges of the first key; values too heavy for that are cut by the next keys.

    ``df`` needs only the keys. A part is about ``1 / parts`` of the rows; there are a few more if single values are heavy.
    """
    key, *others = keys
    total, missing = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    target = max(total / parts, 1)

    def within(bounds: Bounds, rows: float, some: Callable[[], DataFrame]) -> list[Part]:
        if rows <= 1.5 * target or not others:
            return [Part((bounds,), rows)]
        return [replace(p, bounds=(bounds, *p.bounds)) for p in key_parts(some(), others, ceil(rows / target))]

    out = within(Bounds(key, missing=True), missing, lambda: df.where(F.col(key).isNull()))
    some = df.where(F.col(key).isNotNull())
    if total > missing:
        text = isinstance(df.schema[key].dataType, T.StringType)
        share = max(1, ceil(parts * (total - missing) / total))
        cells = _merged((_text_cells if text else _number_cells)(some, key, share), target)
        highs = [c.low for c in cells[1:]] + [None]
        for number, (cell, high) in enumerate(zip(cells, highs)):
            bounds = Bounds(key, cell.low if number else None, high)
            rows = cell.rows if cell.single else min(cell.rows, target)  # what lies in a range of many values is cut fine enough
            out += within(bounds, rows, lambda b=bounds: some.where(Part((b,), 0).spark_sql()))
    return out


def read_parts(table: DataFrame, parts: Sequence[Part], number: str | None = None) -> DataFrame:
    """The table by its parts, each a scan with its range pushed down; ``number`` names a column for the part's number."""
    found = (table.where(p.spark_sql()) for p in parts)
    return reduce(DataFrame.unionByName, (df.withColumn(number, F.lit(k)) if number else df for k, df in enumerate(found)))


def numbered_parts(table: DataFrame, parts: Sequence[Part]) -> DataFrame:
    """The table with ``part``: each row once for every part that it lies in."""
    of = F.filter(F.array(*(F.when(F.expr(p.spark_sql()), F.lit(k)) for k, p in enumerate(parts))), lambda x: x.isNotNull())
    return table.withColumn("part", F.explode(of))
