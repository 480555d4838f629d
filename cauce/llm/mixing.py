"""Mixing sources to target weights: budgets down a tree of domain, language and source, then token prefixes of epochs.

Each node passes its budget to its children in proportion to their weights, and no child gets more than its capacity
(``max_epochs`` times the tokens below it). What a child cannot use goes to its siblings in proportion to their weights,
and only a node all of whose children are full leaves a shortage, which its own siblings then share: siblings before
ancestors. Budgets are whole tokens and add up exactly; the remainders of rounding go to the first children by name.

A leaf reads its budget from a stream of epochs. An epoch is all its documents in the order of
``md5(seed:epoch:doc_id)`` (of the text's digest where the id is missing); whole epochs take every document, and of the last one a prefix of the tokens is taken. To find
it, the tokens are added up by leaf and the hash's first three digits; only documents of the one slice in which
the prefix ends are ordered, a 4096th of the leaf. So a leaf may hold any share of the rows.

Defined results: null and empty texts have no tokens and are never drawn; a very long text is one document like any other; a null level is the value ``(none)``; null ids
and repeated rows are documents of their own, ordered by tokens and text after the hash; weights of 0 get nothing;
an empty table gives no rows; input columns named like a level or like epoch, n_tokens or take are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.llm.common import stored, table

DIGITS = 3


@dataclass
class Level:
    """A level of the tree: its name, its value for a document, and the weight of a value (a whole number)."""

    name: str
    value: Column
    weight: Column


def space_tokens(text: Column) -> Column:
    """Tokens between single spaces."""
    n = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, n).otherwise(0).cast("long")


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budgets of children (``cap``, ``w``) out of their parent's ``budget``, by filling up."""
    of = Window.partitionBy(*parent)
    by = of.orderBy(F.col("cap") / F.col("w"), name)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    df = nodes.withColumn("spent", F.coalesce(F.sum(wide("cap")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("open", F.sum(wide("w")).over(by.rowsBetween(0, Window.unboundedFollowing)))
    df = df.withColumn("full", F.expr("CAST(cap AS decimal(28,0)) * CAST(open AS decimal(10,0)) <= "
                                      "CAST(budget - spent AS decimal(28,0)) * CAST(w AS decimal(10,0))").cast("int"))
    df = df.withColumn("full", F.min("full").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("left", F.col("budget") - F.sum(F.expr("IF(full = 1, cap, 0L)")).over(of)) \
        .withColumn("wsum", F.sum(F.expr("IF(full = 1, 0L, w)")).over(of))
    df = df.withColumn("part", F.expr("IF(full = 1, cap, (CAST(left AS decimal(28,0)) * CAST(w AS decimal(10,0))) div wsum)"))
    df = df.withColumn("over", F.col("left") - F.sum(F.expr("IF(full = 1, 0L, part)")).over(of)) \
        .withColumn("turn", F.sum(1 - F.col("full")).over(of.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn("budget", F.expr("part + IF(full = 0 AND turn <= over, 1L, 0L)")).select(
        *parent, name, "budget")


def leaf_budgets(leaves: DataFrame, levels: list[Level], total: int | None, max_epochs: int) -> DataFrame:
    """(levels, tokens, budget) of the leaves; ``leaves`` has the levels and their tokens."""
    names = [x.name for x in levels]
    weighted = leaves
    for x in levels:
        weighted = weighted.withColumn(f"w_{x.name}", F.greatest(x.weight, F.lit(0)).cast("long"))
    some = weighted.where(" AND ".join(f"w_{n} > 0" for n in names)).withColumn("cap", F.col("tokens") * max_epochs)
    whole, there = some.agg(F.sum("cap"), F.sum("tokens")).first()
    given = F.lit(min(whole or 0, there or 0 if total is None else total)).cast("long")
    for k, x in enumerate(levels):
        parent = names[:k]
        children = some.groupBy(*names[:k + 1]).agg(F.sum("cap").cast("long").alias("cap"), F.max(f"w_{x.name}").alias("w"))
        given = _share(children.join(given, parent) if parent else children.withColumn("budget", given), parent, x.name)
    return leaves.join(given, names)


def mixed(docs: DataFrame, levels: list[Level], total: int | None = None, max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """Rows drawn: the columns of docs, the levels, epoch, n_tokens and take (tokens to read from the front of the text)."""
    names = [x.name for x in levels]
    own = [*names, "epoch", "n_tokens", "take"]
    kept = [c for c in docs.columns if c not in own]
    base = docs.select(*kept, space_tokens(F.col("text")).alias("n_tokens"),
                       *(F.coalesce(x.value.cast("string"), F.lit("(none)")).alias(x.name) for x in levels)).where("n_tokens > 0")
    leaves = stored(base.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = stored(leaf_budgets(leaves, levels, total, max_epochs).where("budget > 0").select(
        *names, F.expr("budget div tokens").cast("int").alias("whole"), F.expr("budget % tokens").alias("rest")), "shares")
    drawn = lambda p: base.join(p, names).withColumn(
        "_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "whole", F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))))
                    .cast("binary")))
    # the struct is another key than the join's, so that a hot leaf is added up in all tasks before it meets
    slices = drawn(plan).where("rest > 0").groupBy(F.struct(*names).alias("leaf"), "rest", F.substring("_h", 1, DIGITS).alias("slice")).agg(
        F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = slices.withColumn("upto", F.sum("n").over(upto)).where("upto >= rest").groupBy("leaf").agg(
        F.min(F.struct("slice", (F.col("upto") - F.col("n")).alias("before"))).alias("end")).select("leaf.*", "end")
    plan = stored(plan.join(ends, names, "left").select(*names, "whole", "rest", F.col("end.slice").alias("_slice"),
                                                        F.col("end.before").alias("_before")), "budgets")
    rows = drawn(plan).withColumn("_own", F.substring("_h", 1, DIGITS))
    epochs = F.col("whole") + F.coalesce(F.col("_own") < F.col("_slice"), F.lit(False)).cast("int")
    full = rows.where(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1))).withColumn("take", F.col("n_tokens"))
    order = Window.partitionBy(*names).orderBy("_h", "n_tokens", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    last = rows.where("_own = _slice").withColumn("_upto", F.col("_before") + F.sum("n_tokens").over(order)).withColumn(
        "epoch", F.col("whole")).withColumn("take", F.least("n_tokens", F.col("rest") - F.col("_upto") + F.col("n_tokens"))).where("take > 0")
    out = [*kept, *names, "epoch", "n_tokens", "take"]
    return full.select(*out).unionByName(last.select(*out))


def cut(rows: DataFrame) -> DataFrame:
    """The rows of ``mixed`` with each text cut to the tokens to read."""
    return rows.withColumn("text", F.expr("IF(take < n_tokens, substring_index(text, ' ', CAST(take AS int)), text)"))


def corpus_levels() -> list[Level]:
    """Domains by the last digit of the source's name, languages, sources; weights of the production mix."""
    digit = F.right(F.coalesce("source", F.lit("")), F.lit(1))
    domain = F.when(digit.isin("0", "1", "2"), "web").when(digit.isin("3", "4", "5", "6"), "books").otherwise("forums")
    return [
        Level("domain", domain, F.expr("CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END")),
        Level("lang", F.col("lang"), F.expr("CASE lang WHEN 'en' THEN 4 ELSE 2 END")),
        Level("source", F.col("source"), F.expr("CASE source WHEN 'src0' THEN 2 ELSE 1 END")),
    ]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(mixed(table(spark, sf_dir, "documents"), corpus_levels()))
    return rows.select("doc_id", "domain", "lang", "source", F.col("epoch").cast("long").alias("epoch"), "n_tokens", "take",
                       F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _share_sql(given: str, nodes: str, parent: str, name: str, out: str) -> str:
    keys = f"{parent}, " if parent else ""
    part = f"PARTITION BY {parent} " if parent else ""
    using = f"JOIN {given} USING ({parent})" if parent else f", {given}"
    return f"""
{out}_a AS (SELECT *, coalesce(sum(cap) OVER ({part}ORDER BY cap / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(w) OVER ({part}ORDER BY cap / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS op FROM {nodes} {using}),
{out}_b AS (SELECT *, min((cap * op <= (budget - spent) * w)::INT) OVER ({part}ORDER BY cap / w, {name} ROWS UNBOUNDED PRECEDING) AS f FROM {out}_a),
{out}_c AS (SELECT *, budget - sum(CASE f WHEN 1 THEN cap ELSE 0 END) OVER ({part}) AS lft, sum((1 - f) * w) OVER ({part}) AS ws FROM {out}_b),
{out}_d AS (SELECT *, CASE f WHEN 1 THEN cap ELSE (lft * w) // ws END AS p FROM {out}_c),
{out}_e AS (SELECT *, lft - sum((1 - f) * p) OVER ({part}) AS ov, sum(1 - f) OVER ({part}ORDER BY {name} ROWS UNBOUNDED PRECEDING) AS turn FROM {out}_d),
{out} AS (SELECT {keys}{name}, p + (f = 0 AND turn <= ov)::INT AS budget FROM {out}_e)"""


OP1_SQL = """
WITH d AS (SELECT * FROM (
  SELECT doc_id, text, CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE length(text) - length(replace(text, ' ', '')) + 1 END AS n_tokens,
    CASE WHEN right(coalesce(source, ''), 1) IN ('0', '1', '2') THEN 'web' WHEN right(coalesce(source, ''), 1) IN ('3', '4', '5', '6') THEN 'books'
         ELSE 'forums' END AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source FROM documents) WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS t, 2 * sum(n_tokens)::HUGEINT AS cap,
  CASE source WHEN 'src0' THEN 2 ELSE 1 END::HUGEINT AS w FROM d GROUP BY ALL),
n1 AS (SELECT domain, sum(cap)::HUGEINT AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END::HUGEINT AS w FROM leaf GROUP BY domain),
n2 AS (SELECT domain, lang, sum(cap)::HUGEINT AS cap, CASE lang WHEN 'en' THEN 4 ELSE 2 END::HUGEINT AS w FROM leaf GROUP BY domain, lang),
g0 AS (SELECT sum(t)::HUGEINT AS budget FROM leaf),""" + ",".join([
    _share_sql("g0", "n1", "", "domain", "g1"), _share_sql("g1", "n2", "domain", "lang", "g2"),
    _share_sql("g2", "leaf", "domain, lang", "source", "g3")]) + """,
plan AS (SELECT domain, lang, source, budget // t AS whole, budget % t AS rest FROM g3 JOIN leaf USING (domain, lang, source)),
r AS (SELECT d.*, whole::INT AS whole, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('7:' || whole::INT || ':' || coalesce(doc_id::VARCHAR, md5(text))), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS bef
      FROM d JOIN plan USING (domain, lang, source)),
o AS (SELECT *, unnest(range(0, whole)) AS epoch, n_tokens AS take FROM r
      UNION ALL SELECT *, whole AS epoch, least(n_tokens, rest - bef) AS take FROM r WHERE bef < rest)
SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, n_tokens::BIGINT AS n_tokens, take::BIGINT AS take,
  md5(CASE WHEN take < n_tokens THEN array_to_string(string_split(text, ' ')[1:take::INT], ' ') ELSE text END) AS text_md5 FROM o
"""
