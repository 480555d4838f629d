"""The operational database as source and target, over JDBC.

Needs the driver jar of the database on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.ranges import Part, key_parts
from cauce.schemas import SourceTable

def newer_than(column: str, last_value: date | None) -> str | None:
    return f"{column} > DATE '{last_value.isoformat()}'" if last_value else None


def sketch_query(table: SourceTable, keys: Sequence[str], condition: str | None = None, percent: float = 1.0) -> str:
    """The keys of a sample of the table's pages, as a subquery; of all of them for 100 percent."""
    sample = f" TABLESAMPLE SYSTEM ({percent:g}) REPEATABLE (7)" if percent < 100 else ""
    return f"(SELECT {', '.join(keys)} FROM {table.name.lower()}{sample}{f' WHERE {condition}' if condition else ''}) sketch"


def part_predicates(parts: Sequence[Part], condition: str | None = None, collate: str = "C") -> list[str]:
    """Conditions of the parts, each one task and one connection; together they cover every row once."""
    return [f"({p.standard_sql(collate)})" + (f" AND {condition}" if condition else "") for p in parts]


def read_table(
    spark: SparkSession,
    url: str,
    table: SourceTable,
    properties: Mapping[str, str],
    parts: int = 64,
    last_value: date | None = None,
    percent: float = 1.0,
) -> DataFrame:
    """The table, or its rows after the watermark, by ranges of its date and key; the database applies the conditions.

    The ranges come from a sketch of a sample of the pages (see ``ranges``): an index on the leading key makes each part a
    range scan. Connections are transactions of their own, so rows that change while they run may be seen in
    either state.
    """
    condition = newer_than(table.watermark, last_value) if table.watermark else None
    keys = [table.watermark, table.key] if table.watermark else [table.key]
    options = {"fetchsize": "10000", **properties}
    sketch = spark.read.jdbc(url, sketch_query(table, keys, condition, percent), properties=options).cache()
    predicates = part_predicates(key_parts(sketch, keys, parts), condition)
    sketch.unpersist()
    return table.project(spark.read.jdbc(url, table.name.lower(), predicates=predicates, properties=options))


def as_declared(df: DataFrame, table: SourceTable) -> DataFrame:
    """The contract's columns with its types; empty texts as NULL, as the bulk load of the source system takes them."""
    return df.select(*(
        (F.nullif(F.col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType) else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in table.schema))


def write_table(
    df: DataFrame, url: str, table: SourceTable, properties: Mapping[str, str], connections: int = 16, recreate: bool = False
) -> None:
    """Replace the rows of the target table by batched inserts over a bounded number of connections.

    ``recreate`` drops the target and creates it anew, with the contract's types as the database calls them; otherwise the
    target is emptied and keeps its definition.
    """
    options = {"batchsize": "10000", "reWriteBatchedInserts": "true", "truncate": str(not recreate).lower(), **properties}
    as_declared(df, table).write.option("numPartitions", connections).jdbc(
        url, table.name.lower(), mode="overwrite", properties=options
    )
