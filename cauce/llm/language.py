"""Language identification: word-first backoff.

Words are runs of letters (``str.isalpha``). A word that the training texts hold is scored by its log frequency in each
language. Any other word falls back to character n-grams: at each of its positions the longest known n-gram counts, from ``LONGEST``
characters down to one, and the word's score is the mean over its positions. The score of a text is the softmax over the
languages' sums; ``known`` is the share of its words that the model knows, an unseen word counting by the share of its positions at
which an n-gram of at least ``TELLING`` characters is known.

The model is fitted on a sample of at most about ``train_rows`` labelled rows, chosen by a hash of doc_id and text, equal
rows once, and holds every word and n-gram that occurs ``least_count`` times in it; so its size is bounded by the sample. It
is kept sparse: a unit's languages and log frequencies in three flat arrays. Every whole text is scored.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything if there is nothing to
learn from; a text whose words and letters are all unknown gets the same score for every language, the first of
them, and known 0; null ids are held out; ties go to the language that sorts first; repeated rows get equal results; very long
texts and words are read whole; an empty table gives no rows. Other columns are kept by ``identified``; its own four columns
replace columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import slices, table, text_batches

WORD = re.compile(r"[^\W\d_]+")  # letters, and numbers that are no digits, which word_counts takes out
LONGEST = 4
TELLING = 3
MEMO = 50_000
MEMO_LENGTH = 64
COUNTED = 30_000
TRAIN_ROWS = 10_000
LEAST_COUNT = 2


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(True))


def training_sample(rows: DataFrame, label: str, train_rows: int) -> DataFrame:
    """About ``train_rows`` rows (doc_id, ``label``, text) with a label and a text that are not held out, equal rows once."""
    fit = rows.where(~held_out()).where(F.col(label).isNotNull() & F.col("text").isNotNull())
    n = fit.count()
    share = min(1.0, train_rows / max(n, 1))
    return fit.where(F.pmod(F.xxhash64(F.lit("train"), "doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))).select(
        "doc_id", label, "text").dropDuplicates()


def word_counts(text: str) -> Counter:
    """Words of a text with their numbers."""
    counts = Counter(WORD.findall(text.lower()))
    for word in [w for w in counts if not w.isalpha()]:
        n = counts.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            counts[part] += n
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by language, added up in pieces of bounded size."""
    found: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        flat = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
        found.clear()
        cols = list(zip(*flat)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
                                          ["lang", "word", "n"])
    for piece in slices(batches, 64):
        for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
            found.setdefault(lang, Counter()).update(word_counts(text))
        if sum(map(len, found.values())) > COUNTED:
            yield rows()
    yield rows()


def _grams(words: DataFrame) -> DataFrame:
    """(lang, unit, n): n-grams of padded words, counted as often as the words."""
    padded, at = F.concat(F.lit(" "), "word", F.lit(" ")), F.col("at")
    units = F.filter(F.array(*(F.when(at + n - 1 <= F.length("padded"), F.substring("padded", at, F.lit(n))) for n in range(1, LONGEST + 1))),
                     lambda x: x.isNotNull())
    return words.withColumn("padded", padded).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("padded")))).select(
        "lang", F.explode(units).alias("unit"), "n")


class Units:
    """Sparse log frequencies of units: those of one group (words; n-grams of one length) add up to 1 in each language."""

    def __init__(self, index: dict[str, int], starts: np.ndarray, langs: np.ndarray, gains: np.ndarray, groups: np.ndarray,
                 base: np.ndarray) -> None:
        self.index, self.starts, self.langs, self.gains, self.groups, self.base = index, starts, langs, gains, groups, base

    def sums(self, units: list[int], weights: list[float]) -> np.ndarray:
        k, w = np.array(units, np.int64), np.array(weights, float)
        held = self.starts[k + 1] - self.starts[k]
        at = np.repeat(self.starts[k] - np.cumsum(held) + held, held) + np.arange(held.sum())
        own = np.bincount(self.langs[at], self.gains[at] * np.repeat(w, held), self.base.shape[1])
        return own + np.bincount(self.groups[k], w, len(self.base)) @ self.base


def packed(rows: pd.DataFrame, langs: list[str], group) -> tuple:
    """What ``Units`` takes, plain data, out of rows (unit, lang, n). A unit counts half a time more in every language."""
    rows = rows.sort_values(["unit", "lang"], ignore_index=True)
    codes, names = pd.factorize(rows.unit)
    of = np.array([group(u) for u in names], np.int64)
    lang = np.searchsorted(np.array(langs, object), rows.lang.to_numpy(object)).astype(np.int64)
    n = rows.n.to_numpy(float)
    size = int(of.max()) + 1 if len(of) else 1
    totals = np.full((size, len(langs)), 0.5) * np.bincount(of, minlength=size)[:, None]
    np.add.at(totals, (of[codes], lang), n)
    base = np.log(0.5) - np.log(np.maximum(totals, 0.5))
    starts = np.searchsorted(codes, np.arange(len(names) + 1))
    return {u: k for k, u in enumerate(names)}, starts, lang.astype(np.int32), np.log(n + 0.5) - np.log(0.5), of, base


class Scorer:
    """Scores texts by a model as ``fit`` gives it: the languages, then words and n-grams."""

    def __init__(self, langs: list[str], words: tuple, grams: tuple) -> None:
        self.langs, self.words, self.grams = langs, Units(*words), Units(*grams)
        self.unseen: dict[str, tuple[list[int], float]] = {}

    def longest(self, word: str) -> tuple[list[int], float]:
        """The longest known n-gram at each position of an unseen word, and the share of positions where it is a telling one."""
        found = self.unseen.get(word)
        if found is None:
            padded, grams, telling, index = f" {word} ", [], 0, self.grams.index
            for i in range(len(padded)):
                for n in range(LONGEST, 0, -1):
                    gram = padded[i:i + n]
                    k = index.get(gram) if gram != " " else None
                    if k is not None:
                        grams.append(k)
                        telling += len(gram) >= TELLING
                        break
            found = grams, telling / len(word)
            if len(self.unseen) < MEMO and len(word) <= MEMO_LENGTH:
                self.unseen[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, known)."""
        counts = word_counts(text) if text else None
        if not counts or not self.langs:
            return "und", 0.0, 0.0
        whole, times, parts, weights, known = [], [], [], [], 0.0
        for word, n in counts.items():
            k = self.words.index.get(word)
            if k is not None:
                whole.append(k)
                times.append(n)
                known += n
            else:
                found, share = self.longest(word)
                parts += found
                weights += [n / max(len(found), 1)] * len(found)
                known += n * share
        total = self.words.sums(whole, times) + self.grams.sums(parts, weights)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum()), known / counts.total()


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, least_count: int = LEAST_COUNT) -> tuple:
    sample = training_sample(docs, "lang", train_rows).select("lang", "text")
    words = sample.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()

    def learned(rows: DataFrame) -> pd.DataFrame:
        held = rows.groupBy("unit").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
        return held.where(F.col("total") >= least_count).select("unit", F.explode("by").alias("b")).select("unit", "b.*").toPandas()

    whole = learned(words.withColumnRenamed("word", "unit"))
    grams = learned(_grams(words).groupBy("lang", "unit").agg(F.sum("n").alias("n")))
    words.unpersist()
    langs = sorted({*whole.lang, *grams.lang})
    return langs, packed(whole, langs, lambda w: 0), packed(grams, langs, len)


def _scored(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*state.value)
        for piece in slices(batches):
            found = [scorer(t) for t in piece.column("text").to_pylist()]
            made = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*piece.columns, *made], [*piece.schema.names, "lang_pred", "score", "known"])
    return run


def identified(docs: DataFrame, columns: list[str], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``columns`` of the documents (``text`` among them) with held_out, lang_pred, score and known."""
    state = docs.sparkSession.sparkContext.broadcast(fit(docs, train_rows))
    columns = [c for c in columns if c not in ("held_out", "lang_pred", "score", "known")]
    df = text_batches(docs).select(*columns, held_out().alias("held_out"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(_scored(state), f"{schema}, lang_pred string, score double, known double")


def in_known_language(docs: DataFrame, least: float = 0.5, least_known: float = 0.3) -> DataFrame:
    """The documents whose language is recognised: a score of at least ``least``, and at least ``least_known`` of the words known.

    Columns as they were; documents without letters go, and so do all if there is nothing to learn from.
    """
    kept = [f"`{c}`" for c in docs.columns]
    plain = docs.select(*kept, F.struct(*kept).alias("_all"))
    return identified(plain, ["doc_id", "text", "_all"]).where(
        (F.col("lang_pred") != "und") & (F.col("score") >= least) & (F.col("known") >= least_known)).select("_all.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "documents"), ["doc_id", "text"]).select("doc_id", "held_out", "lang_pred", "score", "known")
