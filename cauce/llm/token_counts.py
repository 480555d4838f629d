"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

A word's symbols are its characters in a doubly linked list. The heap holds the adjacent pairs that the vocabulary can merge, by
rank and then place; the best is popped, its two symbols become one, and the pairs with the new neighbours are pushed.
A popped pair whose symbols have changed since is skipped. The count is the initial symbols minus the merges; a
character that the vocabulary lacks and that no merge took up counts as its bytes (byte fallback).

No piece of the vocabulary holds a space mark after another character, so merges never cross from a word to the space
before the next one: text is cut there, and each distinct word is counted once and remembered.

Defined results: null and empty texts have 0 tokens and 0 bytes; other columns are not read, and equal rows get equal rows; very long
texts and words are counted whole; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cauce.llm.common import slices, table, text_batches

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
MEMO = 500_000


class MergeCounter:
    """Counts the tokens of texts for a sentencepiece BPE model file with byte fallback and an identity normaliser."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        self.ranks = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
        odd = {p.type for p in model.pieces} - {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or not model.trainer_spec.byte_fallback or odd or any(SPACE in p.lstrip(SPACE) for p in self.ranks)):
            raise ValueError("this model needs another cut or normaliser")
        self.memo: dict[str, int] = {}

    def merged(self, chunk: str) -> int:
        ranks = self.ranks
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(chunk[i:i + 2])) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            left = symbols[i]
            if left is None or j == n or len(left) + len(symbols[j]) != size:
                continue
            symbols[i] = whole = left + symbols[j]
            symbols[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(whole + symbols[k])) is not None:
                    heapq.heappush(heap, (r, i, size + len(symbols[k])))
            k = before[i]
            if k >= 0 and (r := ranks.get(symbols[k] + whole)) is not None:
                heapq.heappush(heap, (r, k, len(symbols[k]) + size))
        lacking = sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in ranks)
        return n - merges + lacking

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for chunk, times in Counter(CHUNK.findall(SPACE + text.replace(" ", SPACE))).items():
            n = self.memo.get(chunk)
            if n is None:
                n = self.merged(chunk)
                if len(self.memo) < MEMO and len(chunk) < 64:
                    self.memo[chunk] = n
            total += n * times
        return total


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = MergeCounter(path)
        for piece in slices(batches):
            texts = piece.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                 pa.array([count(t) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every whole text."""
    kind = dict(docs.dtypes)["doc_id"]
    return text_batches(docs).select("doc_id", "text").mapInArrow(_counted(model), f"doc_id {kind}, n_bytes long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 4096 AS over_limit")
