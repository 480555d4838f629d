"""Per-column strategies for missing values, declared as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Exclude:
    """Drop the row when the column is missing."""

    column: str


@dataclass(frozen=True)
class Impute:
    """Put a default in place of a missing value, and say so in ``flag`` if one is named."""

    column: str
    default: Any
    flag: str | None = None


@dataclass(frozen=True)
class Flag:
    """Keep the value and add a flag: missing, or (``when_present``) all columns present."""

    columns: str | tuple[str, ...]
    flag: str
    when_present: bool = False


def _flag_value(rule: Flag) -> Column:
    columns = (rule.columns,) if isinstance(rule.columns, str) else rule.columns
    if rule.when_present:
        return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def apply_null_rules(df: DataFrame, rules: Sequence[Exclude | Impute | Flag]) -> DataFrame:
    """Filter first, then impute and flag in one projection that sees the original values."""
    required = [F.col(r.column).isNotNull() for r in rules if isinstance(r, Exclude)]
    kept = df.where(reduce(Column.__and__, required)) if required else df
    changed: dict[str, Column] = {}
    for rule in rules:
        if isinstance(rule, Impute):
            default = F.lit(rule.default).cast(df.schema[rule.column].dataType)
            changed[rule.column] = F.coalesce(F.col(rule.column), default)
            if rule.flag:
                changed[rule.flag] = F.col(rule.column).isNull()
        elif isinstance(rule, Flag):
            changed[rule.flag] = _flag_value(rule)
    return kept.withColumns(changed)
