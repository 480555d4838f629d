"""Token ids in binary files: one wavelet matrix per shard.

A shard holds the ids of consecutive documents. Level by level, from the highest bit of the ids down, the wavelet matrix
stores the current bit of every position and then moves the zeros before the ones, keeping their order. Rank on the levels
follows one position down (``access``), counts an id before a position (``rank``) and leads from the n-th
occurrence back up to its position (``select``). Each level's bits are compressed in blocks; a directory holds each
block's place and the ones before it, so a single lookup opens one block a level.

File format, little endian: b"WMX1", header length (4 bytes), a JSON header (n, levels, block, zeros by level, offsets and
ones before each block by level, document ids and lengths' places), the blocks, then the document table.

Documents are range partitioned and sorted by doc_id; a task cuts its documents into shards of about ``shard_tokens`` ids
and writes each file under a name of its own before it renames it, so a repeated task replaces equal bytes. Words
are encoded once by the library and remembered: the tokenizer never joins across white space.

Defined results: null and empty texts are the end id alone; null ids sort first; repeated ids follow each other, ordered by
a hash of their texts; a document longer than a shard, however long, is a shard by itself; an empty table gives no files. Other columns
are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cauce.llm.common import partitions_for, scratch, slices, table

MAGIC = b"WMX1"
BLOCK = 1 << 16  # bits
MEMO = 700_000
MEMO_LENGTH = 64
SHARD_TOKENS = 4_000_000
PLAIN = "^(?P<lead>[!-&(-/:-@\\[-`{-~]*)(?P<core>[A-Za-zÀ-ÖØ-öø-įı-ſ]+)(?P<trail>[!-&(-/:-@\\[-`{-~]*)$"


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space.

    Only the distinct words of a batch are looked at. A word of plain Latin letters between punctuation falls into parts
    that the tokenizer always separates; unknown parts are encoded together in one text, told apart by the end-of-word
    marks, and remembered by the worker process. Every other word is encoded on its own and remembered as a whole.
    """

    def __init__(self, path: str) -> None:
        known = vars(sys).setdefault("_cauce_token_ids", {}).get(path)
        if known is None:
            tokenizer = Tokenizer.from_file(path)
            ends = np.zeros(tokenizer.get_vocab_size(), bool)
            ends[[k for t, k in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
            known = vars(sys)["_cauce_token_ids"][path] = (tokenizer, ends, {"": b""}, {})
        self.tokenizer, self.ends, self.parts, self.wholes = known

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(parts), 20_000):
            some = parts[k:k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(some):
                raise ValueError("the tokenizer joined or split the parts")
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def _encode_wholes(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for k in range(0, len(words), 10_000)
                for e in self.tokenizer.encode_batch_fast(words[k:k + 10_000], add_special_tokens=False)]

    @staticmethod
    def _ids(names: list[str], known: dict[str, bytes], encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct strings on end and how many each has; remembers as many as MEMO."""
        found = list(map(known.get, names))
        missing = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(missing, encode([names[k] for k in missing])):
            found[k] = x
            if len(known) < MEMO and len(names[k]) <= MEMO_LENGTH:
                known[names[k]] = x
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) >> 2

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, and how many each text has."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary
        three = pc.extract_regex(names, PLAIN)
        plain = pc.and_(three.is_valid(), pc.invert(pc.match_substring(names, "<|")))
        cut, whole = three.filter(plain), names.filter(pc.invert(plain))
        parts = pa.chunked_array([cut.field(0), pc.utf8_lower(cut.field(1)), cut.field(2)]).combine_chunks().dictionary_encode()
        ids, sizes = self._ids(parts.dictionary.to_pylist(), self.parts, self._encode_parts)
        whole_ids, whole_sizes = self._ids(whole.to_pylist(), self.wholes, self._encode_wholes)
        # a word is a run of pieces: three parts, or one whole word, which stand behind the parts
        mask = plain.to_numpy(zero_copy_only=False)
        pieces = np.full((len(names), 3), -1, np.int64)
        pieces[mask] = parts.indices.to_numpy().reshape(3, -1).T
        pieces[~mask, 0] = len(sizes) + np.arange(len(whole_sizes))
        ids, sizes = np.concatenate([ids, whole_ids]), np.concatenate([sizes, whole_sizes, [0]])
        store, per_word = gathered(ids, sizes, pieces.ravel())
        out, per_occurrence = gathered(store, per_word.reshape(-1, 3).sum(1), coded.indices.to_numpy())
        upto = np.concatenate(([0], np.cumsum(per_occurrence)))
        return out, np.diff(upto[ends - ends[0]])


def gathered(values: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values that ``picks`` names, on end, and their sizes; ``sizes`` are those of all runs."""
    own = sizes[picks]
    starts = (np.cumsum(sizes) - sizes)[picks] - (np.cumsum(own) - own)
    return values[np.repeat(starts, own) + np.arange(own.sum())], own


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The bytes of a shard file."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    kind = np.uint16 if levels <= 16 else np.uint32
    now, zeros, places, ones_before, body, at = ids.astype(kind), [], [], [], [], 0
    press = zstandard.ZstdCompressor(level=1)
    for level in range(levels - 1, -1, -1):
        bits = (now & kind(1 << level)) != 0
        packed = np.packbits(bits, bitorder="little")
        ones = [int(np.bitwise_count(packed[k:k + BLOCK // 8]).sum()) for k in range(0, len(packed), BLOCK // 8)]
        ones_before.append([0, *np.cumsum(ones, dtype=np.int64).tolist()])
        packed, place = packed.tobytes(), [at]
        for k in range(0, len(packed), BLOCK // 8):
            block = press.compress(packed[k:k + BLOCK // 8])
            body.append(block)
            at += len(block)
            place.append(at)
        places.append(place)
        zeros.append(len(bits) - sum(ones))
        now = np.concatenate([now[~bits], now[bits]])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], np.int64)
    tail = press.compress(docs.tobytes() + lengths.astype(np.int64).tobytes() + known.tobytes())
    head = json.dumps({"n": len(ids), "levels": levels, "zeros": zeros, "places": places, "ones": ones_before,
                       "docs": [len(docs), at, len(tail)]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *body, tail])


class WaveletMatrix:
    """Lookups on a shard's bytes (or a memory map of its file): only the blocks that a lookup needs are opened."""

    def __init__(self, data) -> None:
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = struct.unpack("<I", bytes(data[4:8]))[0]
        head = json.loads(bytes(data[8:8 + size]))
        self.data, self.base = data, 8 + size
        self.n, self.levels, self.zeros = head["n"], head["levels"], head["zeros"]
        self.places, self.ones, self.docs = head["places"], head["ones"], head["docs"]
        self.opened: dict[tuple[int, int], np.ndarray] = {}

    def _bits(self, level: int, block: int) -> np.ndarray:
        found = self.opened.get((level, block))
        if found is None:
            a, b = (self.base + x for x in self.places[level][block:block + 2])
            raw = zstandard.ZstdDecompressor().decompress(bytes(self.data[a:b]))
            found = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:min(BLOCK, self.n - block * BLOCK)]
            if len(self.opened) > 64:
                self.opened.clear()
            self.opened[level, block] = found
        return found

    def _ones(self, level: int, end: int) -> int:
        """Ones of a level before ``end``."""
        block, inside = divmod(end, BLOCK)
        return self.ones[level][block] + (int(self._bits(level, block)[:inside].sum()) if inside else 0)

    def access(self, at: int) -> int:
        """The id at a position."""
        value = 0
        for k in range(self.levels):
            bit = int(self._bits(k, at // BLOCK)[at % BLOCK])
            ones = self._ones(k, at)
            at = self.zeros[k] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id before ``end`` stand below the last level."""
        start = 0
        for k in range(self.levels):
            a, b = self._ones(k, start), self._ones(k, end)
            if value >> (self.levels - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id before ``end``."""
        if value >> self.levels:
            return 0
        start, end = self._range(value, self.n if end is None else end)
        return end - start

    def select(self, value: int, turn: int) -> int:
        """Position of an id's occurrence number ``turn``, from 0."""
        if value >> self.levels or not 0 <= turn < self.rank(value):
            raise IndexError(turn)
        at = self._range(value, self.n)[0] + turn
        for k in range(self.levels - 1, -1, -1):
            bit = value >> (self.levels - 1 - k) & 1
            want = at - self.zeros[k] if bit else at
            starts = np.array(self.ones[k]) if bit else np.minimum(np.arange(len(self.ones[k])) * BLOCK, self.n) - np.array(self.ones[k])
            block = int(np.searchsorted(starts, want, side="right")) - 1
            at = block * BLOCK + int(np.flatnonzero(self._bits(k, block) == bit)[want - starts[block]])
        return at

    def all_ids(self) -> np.ndarray:
        """All ids in order: the levels are undone from the last to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        unpress = zstandard.ZstdDecompressor()
        for k in range(self.levels - 1, -1, -1):
            raw = b"".join(unpress.decompress(bytes(self.data[self.base + a:self.base + b])) for a, b in zip(self.places[k], self.places[k][1:]))
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:self.n].view(bool)
            up = np.empty(self.n, kind)
            up[~bits] = ids[:self.zeros[k]]
            up[bits] = ids[self.zeros[k]:] | kind(1 << (self.levels - 1 - k))
            ids = up
        return ids.astype(np.uint32)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and their numbers of ids, in order."""
        n, at, size = self.docs
        raw = zstandard.ZstdDecompressor().decompress(bytes(self.data[self.base + at:self.base + at + size]))
        ids, lengths = np.frombuffer(raw[:8 * n], np.int64), np.frombuffer(raw[8 * n:16 * n], np.int64)
        return [int(d) if k else None for d, k in zip(ids, raw[16 * n:])], lengths


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder.removeprefix('file:'))}")


def _writer(folder: str, tokenizer: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, store, base, part, doc_ids, ids, held, shard = WordEncoder(tokenizer), None, "", 0, [], [], 0, 0

        def written() -> pa.RecordBatch:
            nonlocal doc_ids, ids, held, shard, store, base
            if store is None:
                store, base = _place(folder)
                store.create_dir(base, recursive=True)
            lengths = np.array([len(x) for x in ids], np.int64)
            name, own = f"shard-{part:07d}-{shard:05d}.wmx", f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(build(np.concatenate(ids), doc_ids, lengths))
            store.move(own, f"{base}/{name}")
            row = pa.RecordBatch.from_pydict({"file": [name], "docs": [len(ids)], "tokens": [int(lengths.sum())]})
            doc_ids, ids, held, shard = [], [], 0, shard + 1
            return row

        for piece in slices(batches, 2048):
            part = piece.column("part")[0].as_py()
            flat, lengths = encode(piece.column("text"))
            for doc_id, own in zip(piece.column("doc_id").to_pylist(), np.split(flat, np.cumsum(lengths)[:-1])):
                if held and held + len(own) + 1 > shard_tokens:
                    yield written()
                doc_ids.append(doc_id)
                ids.append(np.append(own, np.uint32(end_id)))
                held += len(own) + 1
        if held:
            yield written()
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards below ``folder`` and returns their list: file, docs, tokens. File names sort by doc_id.

    ``folder`` must be one that all executors reach, by a scheme that Arrow's file systems know.
    """
    order = F.xxhash64("text")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", order.alias("tie"))
    placed = plain.repartitionByRange(partitions_for(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select(
        F.spark_partition_id().alias("part"), "doc_id", "text")
    return placed.mapInArrow(_writer(folder, tokenizer, end_id, shard_tokens), "file string, docs long, tokens long")


def _reader(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame.path, frame.content):
            shard = WaveletMatrix(content)
            doc_ids, lengths = shard.documents()
            ids, ends = shard.all_ids().astype("<u4"), np.cumsum(lengths)
            starts = ends - lengths
            yield pd.DataFrame({"file": path.rsplit("/", 1)[-1], "doc_id": pd.array(doc_ids, "Int64"), "inside": starts, "n_tokens": lengths,
                                "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]})


def read_documents(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file."""
    task = F.substring_index("file", "-", 2).alias("task")  # shard-task-number: the files of a task follow each other
    sums = files.groupBy(task).agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    tasks = sums.select("task", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("_task_first"))
    before = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("task", task).withColumn("_before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(tasks, "task").select(
        "file", (F.col("_task_first") + F.col("_before")).alias("first"))
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.wmx").load(folder).select("path", "content").mapInPandas(
        _reader, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "file").select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "file")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark, "tokens")
    listed = f"{folder}-list"
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json")).write.parquet(listed)
    files = spark.read.schema("file string, docs long, tokens long").parquet(listed)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_documents(spark, folder, files).select("doc_id", "start", "n_tokens", "ids_crc32")
