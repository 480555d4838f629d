"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: density, number, weight and variety of lexicon words, the share of them near a second-person
word, capitals, punctuation, obfuscated words (letters mixed with digits or symbols, counted again with the symbols read as
letters), digits and length. The lexicon is learned: words and word beginnings (``lowe*``) that are more frequent in
toxic training texts, all that are significant by the log-likelihood ratio. Trees are of fixed depth on binned features with
logistic loss; the calibration maps scores that folds held out of training got to the frequency of label 1, without a decrease;
equal scores are one point of it.

Everything is fitted on at most about ``train_rows`` labelled ids, chosen by a hash of doc_id, none of them held out, with one
text each.

Defined results: null and empty texts are scored like any text (all features 0); without labels of both kinds the score is
the share of label 1 (0 without labels); null ids are held out; repeated rows get equal scores; very long texts and words are
read whole, in time that grows with their length; an empty table gives no rows; other columns are not read. Of several labels of one document the
highest counts, of several texts the one of the smallest hash. Between equal gains the first feature and the lowest cut are taken.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import slices, table, text_batches
from cauce.llm.language import held_out, training_sample

TRAIN_ROWS = 10_000
SIGNIFICANT = 20.0  # log-likelihood ratio / 2 of a lexicon word, in nats
STEMS = range(4, 9)
STRONG = 4.0
MEMO = 100_000
MEMO_LENGTH = 64
NEAR = 5
WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!|][\w@$*!|]*[^\W\d_]")  # from the start of a run of letters: linear
LIKE = str.maketrans("013457@$!|", "oieasasii" + "l")
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos "
                "tú ti tus usted ustedes vosotros".split())


def units(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself and its beginnings."""
    return [word, *(word[:k] + "*" for k in STEMS if k < len(word))]


class Lexicon(dict):
    """Weight of a word, from the strongest of its units; remembers as many words as MEMO."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = max((self.weights[u] for u in units(word) if u in self.weights), default=0.0)
        if len(self) < MEMO and len(word) <= MEMO_LENGTH:
            self[word] = found
        return found


def letters(text: str) -> list[str]:
    """Runs of letters; numbers that are no digits (``[^\\W\\d_]`` has them) part runs."""
    found = WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [part for w in found for part in "".join(c if c.isalpha() else " " for c in w).split()]


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    text = text or ""
    words = letters(text.lower())
    n, size = max(len(words), 1), max(len(text), 1)
    found = [lexicon[w] for w in words]
    hits = [i for i, x in enumerate(found) if x]
    weights = [found[i] for i in hits]
    strong = sum(1 for x in weights if x > STRONG)
    near = sum(1 for i in hits if not YOU.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]))
    mixed = MIXED.findall(text)
    plain = [x for m in mixed for w in letters(m.lower().translate(LIKE)) if (x := lexicon[w])]
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    marks = int(raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum())
    return [
        float(strong), strong / n, len(hits) / n, float(len(hits)), sum(weights) / n, sum(weights), float(len({words[i] for i in hits})), max(weights, default=0.0),
        near / max(len(hits), 1), near / n, float(raw[65:91].sum()) / size, marks / size, float(raw[33]) / size, float(raw[63]) / size,
        len(mixed) / n, float(len(plain)), sum(plain), float(raw[48:58].sum()) / size, float(len(words)), size / n,
    ]


def _present(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that hold a word, by label, added up in pieces of bounded size."""
    found: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def rows() -> pd.DataFrame:
        return pd.DataFrame([(w, y, n) for y, c in found.items() for w, n in c.items()], columns=["word", "y", "n"])
    for frame in frames:
        for text, y in zip(frame.text, frame.y):
            found[y].update({u for w in set(letters(text.lower())) for u in units(w)})
            if len(found[0]) + len(found[1]) > 500_000:
                yield rows()
                found[0].clear(), found[1].clear()
    yield rows()


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and beginnings with their log odds ratio, where the log-likelihood ratio of their presence is significant."""
    totals = {r.y: float(r.n) for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return {}
    counts = sample.select("text", "y").mapInPandas(_present, "word string, y int, n long").groupBy("word").agg(
        F.sum(F.expr("IF(y = 1, n, 0)")).cast("double").alias("a"), F.sum(F.expr("IF(y = 0, n, 0)")).cast("double").alias("b"))
    a, b, toxic, plain = F.col("a"), F.col("b"), F.lit(totals[1]), F.lit(totals[0])
    odds = F.log((a + 0.5) / (toxic - a + 0.5)) - F.log((b + 0.5) / (plain - b + 0.5))
    part = lambda n, of: F.when(n > 0, n * F.log(n / of)).otherwise(0.0)
    ratio = part(a, (a + b) * toxic / (toxic + plain)) + part(b, (a + b) * plain / (toxic + plain))
    best = counts.where("a >= 4").select("word", odds.alias("odds"), ratio.alias("ratio")).where(
        (F.col("odds") > 1.5) & (F.col("ratio") > SIGNIFICANT))
    return {r.word: r.odds for r in best.collect()}  # words of the sample, each in four of its texts or more


class Boosted:
    """Trees of fixed depth; a tree is (features, thresholds, leaf values) of a complete binary tree."""

    def __init__(self, depth: int = 3, rounds: int = 120, rate: float = 0.1, bins: int = 48, least: float = 1.0) -> None:
        self.depth, self.rounds, self.rate, self.bins, self.least = depth, rounds, rate, bins, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        score, inner = np.full(len(y), self.base), 2 ** self.depth - 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h, node = y - p, p * (1 - p), np.zeros(len(y), np.int64)
            feat, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(self.depth):
                first, wide = 2 ** level - 1, 2 ** level
                best = np.full(wide, 1e-9)
                where = np.full(wide, self.bins, np.int64)
                for f in range(x.shape[1]):
                    key = (node - first) * self.bins + binned[:, f]
                    gs, hs = (np.bincount(key, v, wide * self.bins).reshape(wide, -1).cumsum(1) for v in (g, h))
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                    gain[(hs < self.least) | (ht - hs < self.least)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(wide), at]
                    better = (top > best) & (at < len(edges[f]))
                    best[better], where[better] = top[better], at[better]
                    feat[first:first + wide][better] = f
                    cut[first:first + wide][better] = edges[f][at[better]] if better.any() else 0
                right = binned[np.arange(len(y)), feat[node]] > where[node - first]
                node = 2 * node + 1 + right
            leaf = node - inner
            value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
            score += self.rate * value[leaf]
            self.trees.append((feat, cut, self.rate * value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for feat, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feat[node]] > cut[node])
            score += value[node - len(feat)]
        return score


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, frequencies), both rising; between them values are interpolated."""
    points, of = np.unique(score, return_inverse=True)  # equal scores are one point, whatever their order
    weights, ones = np.bincount(of), np.bincount(of, y)
    blocks: list[list[float]] = []  # sum of y, weight, sum of scores
    for s, v, w in zip(points.tolist(), ones.tolist(), weights.tolist()):
        blocks.append([v, float(w), s * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple:
    """Plain data that ``score`` takes: lexicon, base, trees and calibration."""
    marked = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"), F.lit("").alias("text"))
    sample = training_sample(marked, "y", train_rows).select("doc_id", "y").join(docs.select("doc_id", "text"), "doc_id").where(
        "text IS NOT NULL").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).persist()
    lexicon = learn_lexicon(sample)
    got = sample.select("doc_id", "y", "text").mapInPandas(
        _measured(lexicon), "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id", ignore_index=True)  # ``train_rows`` at most
    sample.unpersist()
    y = got.y.to_numpy(float)
    if len(set(y)) < 2:
        return {}, None, (np.array([0.0]), np.array([y.mean() if len(y) else 0.0]))
    x = np.stack(got.x.to_numpy())
    fold, apart = got.doc_id.to_numpy() % 3, np.zeros(len(y))
    for f in range(3):
        rest = fold != f
        if rest.any() and len(set(y[rest])) == 2:
            apart[~rest] = Boosted().fit(x[rest], y[rest]).raw(x[~rest])
    model = Boosted().fit(x, y)
    return lexicon, (model.base, model.trees), isotonic(apart, y)


def _measured(weights: dict[str, float]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(weights)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame.doc_id, "y": frame.y, "x": [features(t, lexicon) for t in frame.text]})
    return run


def _scored(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, trees, (at, freq) = state.value
        lexicon, model = Lexicon(weights), Boosted()
        if trees:
            model.base, model.trees = trees
        for piece in slices(batches):
            x = np.array([features(t, lexicon) for t in piece.column("text").to_pylist()])
            score = np.clip(np.interp(model.raw(x) if trees else np.zeros(len(x)), at, freq), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out and score of every whole text."""
    state = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_rows))
    kind = dict(docs.dtypes)["doc_id"]
    return text_batches(docs).select("doc_id", "text", held_out().alias("held_out")).mapInArrow(_scored(state), f"doc_id {kind}, held_out boolean, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
