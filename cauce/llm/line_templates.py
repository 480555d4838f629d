"""Line removal by a log-template tree of fixed depth, in DataFrame functions only.

A line's tokens stand between spaces; a token with a digit is the field ``<*>``. The tree's first level is the number of
tokens, the next ones the first ``DEPTH`` tokens; so a leaf is (number, leading tokens). In a leaf, a token is constant
at its position if at least ``share`` percent of the leaf's documents (two at least) have it there, and a field otherwise, so
leaves of any size are parsed alike; the line's template is what remains constant. Lines with at least ``min_tokens`` tokens, of
which at least ``constant`` (in percent) are no fields, are dropped if they recur:

* equal lines (but for tokens with digits) from ``min_docs`` different documents on, those of ``long_tokens`` tokens from two;
* lines of one template, whatever stands in its fields, from ``min_docs`` different documents on.

Copies are added up before anything is grouped: equal lines are one row with the number of documents that hold
them, so a line that a third of all documents share is one row, and only leaves of different lines and enough documents are parsed.
Constants come from partial sums and joins, never from a window or a list over a leaf. Tables that have been added up are
written before they are joined, so that adaptive execution can split a hot line or leaf on the other side.

Defined results: null texts have no lines and stay null; an empty text is one empty line; a line of fewer than ``min_tokens``
tokens stays; very long texts, lines and tokens are read whole, in time that grows with their length; repeated rows (equal doc_id
and text) are one document for the counts and are all cleaned alike; an empty table gives no rows; own columns (n_lines,
n_dropped) replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import discard, stored, table

DEPTH = 3
MIN_DOCS = 5
MIN_TOKENS = 4
LONG_TOKENS = 8
CONSTANT = 70
SHARE = 25
FIELD = "<*>"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _masked(line: Column) -> Column:
    masked = F.regexp_replace(line, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    return F.when(line.rlike("[0-9]"), masked).otherwise(line)


def _key(row: str = "") -> Column:
    """A document: its id and text."""
    return F.xxhash64(F.col(f"{row}doc_id").cast("string"), F.col(f"{row}text")).alias("k")


def _without(text: Column, what: str) -> Column:
    return F.length(F.replace(text, F.lit(what), F.lit("")))


def _tree(lines: DataFrame, min_tokens: int) -> DataFrame:
    """k, at, number of tokens and of those that are no fields, the line's leaf and its own hash; short lines go."""
    masked = F.col("masked")
    plain = F.col("n") - F.when(masked.contains(FIELD), F.size(F.filter(F.split(masked, " "), lambda x: x == FIELD))).otherwise(0)
    return lines.select("k", "at", _masked(F.col("line")).alias("masked")).withColumn(
        "n", F.length("masked") - _without(masked, " ") + 1).where(F.col("n") >= min_tokens).select(
        "k", "at", "n", plain.alias("plain"), F.xxhash64("n", F.substring_index("masked", " ", DEPTH)).alias("leaf"),
        F.xxhash64("masked").alias("own"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, constant: int = CONSTANT,
                    share: int = SHARE, long_tokens: int = LONG_TOKENS) -> DataFrame:
    """(k: the document, at: the line) of every line that recurs."""
    texts = docs.where("text IS NOT NULL").select(_key(), "text")
    held = stored(_tree(texts.select("k", F.posexplode(_lines(F.col("text"))).alias("at", "line")), min_tokens), "lines")
    copies = stored(held.groupBy("own", "leaf", "n", "plain", "k").agg(F.min("at").alias("at")).groupBy("own", "leaf", "n", "plain").agg(
        F.count("*").alias("docs"), F.min(F.struct("k", "at")).alias("one")), "line-copies")
    equal = copies.where((100 * F.col("plain") >= constant * F.col("n")) & (
        (F.col("docs") >= min_docs) | ((F.col("docs") >= 2) & (F.col("n") >= long_tokens)))).select("own")
    wide = stored(copies.groupBy("leaf").agg(F.sum("docs").alias("all"), F.count("*").alias("lines")).where(
        (F.col("all") >= min_docs) & (F.col("lines") > 1)).select("leaf", "all"), "line-leaves")
    # the text of one line of each kind
    chosen = copies.join(wide, "leaf").select("leaf", "own", "docs", "all", "one.*").groupBy("k").agg(
        F.collect_list(F.struct("leaf", "own", "docs", "all", "at")).alias("of"))
    found = texts.dropDuplicates(["k"]).join(chosen, "k").select(F.inline(F.element_at(F.transform(
        F.array(_lines(F.col("text"))), lambda lines: F.transform("of", lambda x: F.struct(
            x["leaf"].alias("leaf"), x["own"].alias("own"), x["docs"].alias("docs"), x["all"].alias("all"),
            F.get(lines, x["at"]).alias("line")))), 1)))
    parsed = stored(found.select("leaf", "own", "docs", "all", F.posexplode(F.split(_masked(F.col("line")), " ")).alias("pos", "token")),
                    "line-tokens")
    fixed = stored(parsed.where(F.col("token") != FIELD).groupBy("leaf", "pos", "token").agg(
        F.sum("docs").alias("times"), F.max("all").alias("all")).where(
        (F.col("times") >= 2) & (100 * F.col("times") >= share * F.col("all"))).select("leaf", "pos", "token", F.lit(True).alias("fixed")),
        "line-constants")
    templates = parsed.join(fixed, ["leaf", "pos", "token"], "left").groupBy("own").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("fixed"), F.col("token")).otherwise(FIELD).alias("t")))).alias("all"))
    templates = stored(templates.select("own", F.transform("all", lambda x: x["t"]).alias("t")).where(
        100 * F.size(F.filter("t", lambda x: x != FIELD)) >= constant * F.size("t")).select(
        "own", F.xxhash64(F.array_join("t", " ")).alias("template")), "line-templates")
    often = stored(held.join(templates, "own").select("template", "k").distinct().groupBy("template").agg(
        F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("template"), "line-often")
    gone = stored(equal.unionByName(templates.join(often, "template").select("own")).distinct(), "line-gone")
    out = stored(held.join(gone, "own").select("k", "at"), "line-places")
    discard(held, copies, wide, parsed, fixed, templates, often, gone)
    return out


def without_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, constant: int = CONSTANT,
                            share: int = SHARE, long_tokens: int = LONG_TOKENS) -> DataFrame:
    """The documents with their texts less the recurring lines, and n_lines and n_dropped."""
    gone = recurring_lines(docs, min_docs, min_tokens, constant, share, long_tokens).distinct().groupBy("k").agg(
        F.collect_list("at").alias("_gone"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*(f"`{c}`" for c in kept)).alias("_row"), _key()).join(gone, "k", "left")
    places = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    left = lambda lines: F.array_join(F.transform(places(lines), lambda i: F.get(lines, i)), "\n")
    cleaned = F.element_at(F.transform(F.array(_lines(F.col("_row.text"))), lambda lines: F.struct(
        F.size(lines).alias("n"), F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(left(lines)).alias("text"))), 1)
    return rows.select("_row", F.size("_gone").alias("_d"), cleaned.alias("_c")).select(
        *(F.col("_c.text").alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in kept),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.col("_c.n")).cast("long").alias("n_lines"),
        F.greatest("_d", F.lit(0)).cast("long").alias("n_dropped"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_recurring_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


OP7_SQL = f"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
l AS (SELECT r, doc_id, pos, line, string_split(regexp_replace(line, '[^ ]*[0-9][^ ]*', '{FIELD}', 'g'), ' ') AS t
      FROM (SELECT r, doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos, unnest(string_split(text, chr(10))) AS line FROM d)),
h AS (SELECT *, len(t) AS n, array_to_string(t[1:{DEPTH}], ' ') AS lead FROM l WHERE len(t) >= {MIN_TOKENS}),
c AS (SELECT n, lead, t, count(DISTINCT r) AS docs, len([x FOR x IN t IF x <> '{FIELD}']) AS plain FROM h GROUP BY n, lead, t),
e AS (SELECT n, lead, t FROM c WHERE 100 * plain >= {CONSTANT} * n AND (docs >= {MIN_DOCS} OR docs >= 2 AND n >= {LONG_TOKENS})),
w AS (SELECT n, lead, sum(docs) AS al FROM c GROUP BY n, lead HAVING sum(docs) >= {MIN_DOCS} AND count(*) > 1),
x AS (SELECT n, lead, t, docs, al, unnest(range(1, n + 1)) AS p, unnest(t) AS tok FROM c JOIN w USING (n, lead)),
f AS (SELECT n, lead, p, tok FROM x WHERE tok <> '{FIELD}' GROUP BY n, lead, p, tok, al HAVING sum(docs) >= 2 AND 100 * sum(docs) >= {SHARE} * al),
m AS (SELECT x.n, x.lead, x.t, string_agg(CASE WHEN f.tok IS NULL THEN '{FIELD}' ELSE x.tok END, ' ' ORDER BY x.p) AS template,
             sum((f.tok IS NOT NULL)::INT) AS fixed
      FROM x LEFT JOIN f ON x.n = f.n AND x.lead = f.lead AND x.p = f.p AND x.tok = f.tok GROUP BY x.n, x.lead, x.t),
g AS (SELECT h.r, h.pos, m.template FROM h JOIN m USING (n, lead, t) WHERE 100 * m.fixed >= {CONSTANT} * m.n),
o AS (SELECT template FROM g GROUP BY template HAVING count(DISTINCT r) >= {MIN_DOCS}),
z AS (SELECT r, pos FROM g JOIN o USING (template) UNION SELECT r, pos FROM h JOIN e USING (n, lead, t)),
q AS (SELECT l.r, l.doc_id, count(*) AS n_lines, count(z.pos) AS n_dropped,
             coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE z.pos IS NULL), '') AS left_text
      FROM l LEFT JOIN z ON l.r = z.r AND l.pos = z.pos GROUP BY l.r, l.doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, md5(left_text) AS text_md5
FROM documents LEFT JOIN q USING (doc_id)
"""
