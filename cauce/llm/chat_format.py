"""Chat formatting: the nested field paths of a record, hashed, select the mapping that turns it into canonical turns.

A record is a variant value, so one table may hold any mixture of layouts: rows by turn, lists of messages, prompt and
completion, instruction and output. Its fingerprint is the hash of its sorted field paths (``messages[].role``), as far as any
layout names them, so that other columns do not matter. ``LAYOUTS`` declares for each layout where the conversation's
name, the roles and the texts lie; a fingerprint that is no layout's own takes the layout with most paths among those
that are there as a whole, and of equals the first declared. Paths are read off once for each schema that a record shows.

Canonical turns are (conversation, order, role, text). They are dealt by ranges of the conversation and of ``TURNS`` turn
numbers, sorted, and written as they stream by: a piece of at most about ``PIECE`` characters of one conversation is one row
of the output, so a conversation of any length is never held as a whole. A turn reads ``### role:``, a new line, the
text and ``</turn>``, a new line. Inside roles and texts a backslash goes before every backslash, before ``#`` that follows
another, and between ``<`` and ``/turn>``, so that no text holds a control string and every text comes back exactly. The spans of
``loss`` cover what the roles in ``learned`` said, without the marks.

Defined results: null texts and roles are empty ones, and a null role is its own role; rows by turn without a name form one conversation
without a name; turns of equal number are ordered by role, then text; repeated rows by turn are turns of
their own, and each other record is a conversation of its own, also if it repeats one (records are told apart by their place in the
input, which must not change between attempts of a task); records of no known layout, and lists without messages, have no turns and
are listed by ``unmapped``; a very long text is one piece; an empty table gives no rows. Columns that no layout names are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import partitions_for, scratch, slices, table, text_batches

TURNS = 1000
PIECE = 1 << 16
MEMO = 10_000
HEAD, MIDDLE, END = "### ", ":\n", "</turn>\n"
CONTROL = re.compile(r"\\|(?<=#)#|(?<=<)/turn>")
CONTROL_IN_ROLE = re.compile(r"\\|(?<=#)#|(?<=<)/turn>|(?<=:)\n")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Turn:
    """Where turns lie: ``text`` and ``role`` are fields of the record, or of each element of the list ``each``."""

    text: str
    role: str | None = None       # a field
    said_by: str = "user"         # the role, if no field has it
    each: str | None = None
    order: str | None = None      # a field with the turn's number
    optional: bool = False        # left out where the text is missing or null


@dataclass(frozen=True)
class Layout:
    name: str
    conversation: str
    turns: tuple[Turn, ...]
    roles: tuple[tuple[str, str], ...] = ()  # names of roles that become others

    def paths(self, optional: bool) -> frozenset[str]:
        found = {self.conversation}
        for t in self.turns:
            if optional or not t.optional:
                before = f"{t.each}[]." if t.each else ""
                found |= {before + t.text} | ({before + t.role} if t.role else set()) | ({t.order} if t.order else set())
        return frozenset(found)


NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("rows by turn", "conv_id", (Turn("text", role="role", order="turn"),)),
    Layout("messages", "id", (Turn("content", role="role", each="messages"),), NAMES),
    Layout("conversations", "id", (Turn("system", said_by="system", optional=True), Turn("value", role="from", each="conversations")), NAMES),
    Layout("dialog", "meta.id", (Turn("utterance", role="speaker", each="dialog.turns"),), NAMES),
    Layout("instruction", "id", (Turn("system", said_by="system", optional=True), Turn("instruction"), Turn("input", optional=True),
                                 Turn("output", said_by="assistant"))),
    Layout("prompt", "id", (Turn("prompt"), Turn("completion", said_by="assistant"))),
    Layout("question", "id", (Turn("question"), Turn("answer", said_by="assistant"))),
)


def field_paths(schema: str) -> frozenset[str]:
    """Paths to the leaves of a schema as ``schema_of_variant`` writes it: ``a.b`` for fields, ``a[].b`` for elements."""
    found, stack, here = set(), [], ""
    for token in re.finditer(r"OBJECT<|ARRAY<|>|, |(`(?:[^`]|``)*`|[\w$]+): |[^<>,`]+", schema):
        text, name = token.group(0), token.group(1)
        if name is not None:
            plain = name[1:-1].replace("``", "`") if name[0] == "`" else name
            here = f"{stack[-1]}.{plain}" if stack[-1] else plain
        elif text == "OBJECT<":
            stack.append(here)
        elif text == "ARRAY<":
            stack.append(here)
            here += "[]"
        elif text == ">":
            here = stack.pop()
        elif text != ", ":
            found.add(here)
    return frozenset(found)


class Registry:
    """Layouts by the fingerprint of their paths."""

    def __init__(self, layouts: tuple[Layout, ...]) -> None:
        self.layouts = layouts
        self.known = frozenset().union(*(x.paths(True) for x in layouts))
        self.seen: dict[str, tuple[int, int]] = {}
        self.by_print: dict[int, int] = {}
        for k, x in enumerate(layouts):
            for optional in (False, True):
                self.by_print.setdefault(self.fingerprint(x.paths(optional)), k)

    def fingerprint(self, paths: frozenset[str]) -> int:
        digest = hashlib.sha256("\n".join(sorted(paths & self.known)).encode("utf-8", "surrogatepass")).digest()
        return int.from_bytes(digest[:8], "big", signed=True)

    def of(self, schema: str | None) -> tuple[int, int]:
        """(fingerprint, number of the layout or -1) of a record's schema."""
        found = self.seen.get(schema or "")
        if found is None:
            paths = field_paths(schema or "")
            print_ = self.fingerprint(paths)
            covered = [(-len(x.paths(False)), k) for k, x in enumerate(self.layouts) if x.paths(False) <= paths]
            found = print_, self.by_print.get(print_, min(covered)[1] if covered else -1)
            if len(self.seen) < MEMO:
                self.seen[schema or ""] = found
        return found


def records_of_rows(df: DataFrame) -> DataFrame:
    """Rows of typed columns as variant records."""
    names = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    return df.select(F.expr(f"to_variant_object(struct({names}))").alias("record"))


def records_of_json(df: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts as variant records; what is no JSON is null."""
    return df.select(F.try_parse_json(column).alias("record"))


def fingerprinted(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """record, fingerprint and layout (number, -1 for none)."""
    registry = Registry(layouts)

    def look_up(schema: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([registry.of(s) for s in schema], columns=["fingerprint", "layout"])

    found = F.pandas_udf(look_up, "fingerprint long, layout int")
    return records.select("record", found(F.schema_of_variant("record")).alias("f")).select("record", "f.*")


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get("record", "$" + "".join(f"['{p}']" for p in path.split(".")), kind)


def _turns(layout: Layout) -> Column:
    """Array of (turn, part, role, text)."""
    def said(turn: Column, part: Column, role: Column, text: Column) -> Column:
        named = F.coalesce(role, F.lit(""))
        renamed = F.coalesce(*(F.when(F.lower(named) == old, F.lit(new)) for old, new in layout.roles), named)
        return F.struct(turn.cast("long").alias("turn"), part.cast("int").alias("part"), renamed.alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))

    def element(t: Turn, k: int):
        return lambda x, i: said(none, i + k, x[t.role], x[t.text])

    none, lists = F.lit(None), []
    for k, t in enumerate(layout.turns):
        if t.each:
            kind = f"array<struct<{t.text}:string,{t.role}:string>>"
            lists.append(F.transform(F.coalesce(_get(t.each, kind), F.array().cast(kind)), element(t, k)))
        else:
            text = _get(t.text, "string")
            one = F.array(said(_get(t.order, "long") if t.order else none, F.lit(k), _get(t.role, "string") if t.role else F.lit(t.said_by), text))
            lists.append(F.when(text.isNull(), F.slice(one, 1, 0)).otherwise(one) if t.optional else one)
    return F.concat(*lists)


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id (as text), record (-1 for rows by turn), turn, part, role, text of every record of a known layout."""
    found = fingerprinted(records, layouts)
    pick = lambda of: F.coalesce(*(F.when(F.col("layout") == k, of(x)) for k, x in enumerate(layouts)))
    by_turn = [k for k, x in enumerate(layouts) if any(t.order for t in x.turns)]
    return found.select(
        pick(lambda x: _get(x.conversation, "string")).alias("conv_id"),
        F.when(F.col("layout").isin(by_turn), F.lit(-1)).otherwise(F.monotonically_increasing_id()).alias("record"),
        pick(_turns).alias("all")).select("conv_id", "record", F.explode("all").alias("t")).select("conv_id", "record", "t.*")


def unmapped(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """fingerprint, schema and number of the records of no known layout."""
    return fingerprinted(records, layouts).where("layout < 0").groupBy(
        "fingerprint", F.schema_of_variant("record").alias("schema")).agg(F.count("*").alias("n"))


def escaped(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn as it is written, and where its text begins and how long it is."""
    head, body = f"{HEAD}{escaped(role, CONTROL_IN_ROLE)}{MIDDLE}", escaped(text)
    return head + body + END, len(head), len(body)


def parsed(piece: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a written piece."""
    for turn in piece.split(END)[:-1]:
        at = turn.index(MIDDLE, len(HEAD))
        yield unescaped(turn[len(HEAD):at]), unescaped(turn[at + len(MIDDLE):])


PIECES = "conv_id string, record long, block long, piece long, text string, loss array<struct<start:int,length:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))


def _format(learned: tuple[str, ...]):
    """Rows in the order of their conversations to pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, texts, spans, size, done, held = None, 0, [], [], 0, [], 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:4]), pa.array(cols[4], pa.string()),
                 pa.array(cols[5], SPANS)], ["conv_id", "record", "block", "piece", "text", "loss"])

        for rows in slices(batches):
            for *own, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "record", "block", "role", "text"))):
                if texts and (own != key or size >= PIECE):
                    done.append((*key, number, "".join(texts), spans))
                    held, texts, spans, size = held + size, [], [], 0
                    if len(done) >= 500 or held >= 16 * PIECE:
                        yield batch()
                        held = 0
                if own != key:
                    key, number = own, 0
                elif not texts:
                    number += 1
                whole, start, length = formatted(role, text)
                if role in learned:
                    spans.append({"start": size + start, "length": length})
                texts.append(whole)
                size += len(whole)
        if texts:
            done.append((*key, number, "".join(texts), spans))
        if done:
            yield batch()
    return run


def write_formatted(records: DataFrame, folder: str, layouts: tuple[Layout, ...] = LAYOUTS, learned: tuple[str, ...] = ("assistant",)) -> None:
    """Pieces of formatted conversations with the spans to learn from, as Parquet, in the order of the conversations."""
    turns = canonical_turns(text_batches(records), layouts).withColumn("block", F.expr("floor(turn / CAST(%d AS DOUBLE))" % TURNS).cast("long"))
    parts = partitions_for(records)
    dealt = turns.repartitionByRange(parts, "conv_id", "record", "block").sortWithinPartitions(
        "conv_id", "record", "block", "turn", "part", "role", "text")
    dealt.select("conv_id", "record", "block", "role", "text").mapInArrow(_format(learned), PIECES).write.parquet(folder)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its pieces in order; holds no more than a piece."""
    key, state, done = None, None, []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*done))
        done.clear()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)],
            ["conv_id", "record", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    def row() -> tuple:
        n, turns, chars, loss, size = state
        return (*key, n, turns.hexdigest(), chars, loss.hexdigest(), size)

    raw = lambda text: text.encode("utf-8", "surrogatepass")
    for rows in slices(batches):
        for *own, text, spans in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "record", "text", "loss"))):
            if own != key:
                if key is not None:
                    done.append(row())
                    if len(done) >= 10_000:
                        yield batch()
                key, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in parsed(text):
                state[0] += 1
                state[1].update(raw(f"{role}\n{said}\n"))
            for span in spans:
                said = unescaped(text[span["start"]:span["start"] + span["length"]])
                state[2] += len(said)
                state[3].update(raw(said))
            state[4] += len(text)
    if key is not None:
        done.append(row())
    if done:
        yield batch()


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, record, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from written pieces."""
    dealt = text_batches(pieces).repartition(partitions_for(pieces), "conv_id", "record").sortWithinPartitions(
        "conv_id", "record", "block", "piece")
    return dealt.mapInArrow(_digests, "conv_id string, record long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


MARKED = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = rows.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                              F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"))
    folder = scratch(spark, "chats")
    write_formatted(records_of_rows(rows.unionByName(added)), folder)
    return digests(spark.read.schema(PIECES).parquet(folder)).select(
        F.col("conv_id").cast("long").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


_ESCAPED_LENGTH = ("length({0}) + length({0}) - length(replace({0}, '\\', '')) + (length({0}) - length(replace({0}, '</turn>', ''))) // 7"
                   " + length({0}) - length(replace({0}, '#', '')) - len(regexp_extract_all({0}, '#+'))")
OP11_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{MARKED}'),
e AS (SELECT *, {_ESCAPED_LENGTH.format('role')} + (length(role) - length(replace(role, ':' || chr(10), ''))) // 2 + {_ESCAPED_LENGTH.format('text')}
  + {len(HEAD + MIDDLE + END)} AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars FROM e GROUP BY conv_id
"""
