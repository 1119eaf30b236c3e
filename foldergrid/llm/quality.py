"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics are cut into bins. Boosting goes round the features; each step fits a tree
of at most two splits to one feature alone and adds it to that feature's lookup table. The
strongest pairs then get tables of their own the same way. A score is a sum of table
entries, read for whole batches at once.

Edge cases: a null or empty text has statistics of zero and is scored like any other. Labels
without id or value, and ids of the held-out fold, are never learned from. Without labels, or
with labels of one class, the score is the smoothed share of label 1. Repeated rows get equal
scores.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import bounded_sample, held_out, labelled, small_batches, texts_of

# labelled documents that training may take; their statistics are collected to the driver
MAX_TRAIN_ROWS = 20_000
FOLDS = 5
_SYMBOLS = b"#$%&*|!@^~<>=+_{}[]\\/`"
_MARKS = b".,;:?'\"()-"
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"

FEATURES = (
    "log_words", "word_length", "longest_word", "symbols", "marks", "capitals", "digits", "wide", "white",
    "distinct_words", "top_word", "repeats", "distinct_pairs", "distinct_lines", "plain_words", "shouted_words",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """The values named in FEATURES."""
    text = text or ""
    words, raw = text.split(), text.encode()
    n, size = len(words) or 1, len(raw) or 1
    counts, lines = Counter(words), text.split("\n")
    lengths = list(map(len, words))
    following = words[1:]
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    return (
        np.log1p(len(words)), sum(lengths) / n, float(max(lengths, default=0)),
        share(_SYMBOLS), share(_MARKS), share(_CAPITALS), share(_DIGITS),
        (len(raw) - len(text)) / size, 1 - sum(lengths) / (len(text) or 1),
        len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(eq, words, following)) / n, len(set(zip(words, following))) / n, len(set(lines)) / len(lines),
        sum(map(str.isalpha, words)) / n, sum(map(str.isupper, words)) / n,
    )


def statistics_matrix(texts) -> np.ndarray:
    rows = [statistics(text) for text in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    max_bins: int = 32
    pair_bins: int = 8
    rounds: int = 150
    pairs: int = 6
    pair_rounds: int = 40
    rate: float = 0.1
    ridge: float = 2.0
    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    coarse: list = field(default_factory=list)
    pair_tables: list = field(default_factory=list)  # (feature, feature, table)

    def fit(self, values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
        ones = float(labels.sum())
        self.intercept = float(np.log((ones + 1) / (len(labels) - ones + 1)))
        width = values.shape[1]
        self.edges = [self._cuts(values[:, j], self.max_bins) for j in range(width)]
        self.coarse = [self._cuts(values[:, j], self.pair_bins) for j in range(width)]
        self.tables = [np.zeros(len(cuts) + 1) for cuts in self.edges]
        self.pair_tables = []
        if not 0 < ones < len(labels):
            return self
        score = np.full(len(labels), self.intercept)
        bins = [np.searchsorted(cuts, values[:, j], side="right") for j, cuts in enumerate(self.edges)]
        for _ in range(self.rounds):
            for j in range(width):
                slope, weight = self._residual(score, labels)
                size = len(self.tables[j])
                step = self.rate * self._tree(np.bincount(bins[j], slope, size), np.bincount(bins[j], weight, size))
                self.tables[j] += step
                score += step[bins[j]]
        self._fit_pairs(values, labels, score)
        return self

    def _fit_pairs(self, values: np.ndarray, labels: np.ndarray, score: np.ndarray) -> None:
        bins = [np.searchsorted(cuts, values[:, j], side="right") for j, cuts in enumerate(self.coarse)]
        sizes = [len(cuts) + 1 for cuts in self.coarse]

        def grids(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
            cell = bins[a] * sizes[b] + bins[b]
            return tuple(np.bincount(cell, v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b]) for v in self._residual(score, labels))

        gains = {pair: self._quadrants(*grids(*pair))[0] for pair in combinations(range(len(sizes)), 2)}
        strongest = sorted(gains, key=lambda pair: (-gains[pair], pair))[: self.pairs]
        tables = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in strongest if gains[pair] > 0}
        for _ in range(self.pair_rounds):
            for (a, b), table in tables.items():
                step = self.rate * self._quadrants(*grids(a, b))[1]
                table += step
                score += step[bins[a], bins[b]]
        self.pair_tables = [(a, b, table) for (a, b), table in tables.items()]

    @staticmethod
    def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(column, np.arange(1, bins) / bins)) if len(column) else np.zeros(0)

    @staticmethod
    def _residual(score: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-score))
        return labels - chance, chance * (1 - chance)

    def _value(self, slope, weight):
        return slope / (weight + self.ridge)

    def _tree(self, slope: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """A tree of at most two splits over ordered bins: the step for each bin."""
        leaves = [(0, len(slope))]
        for _ in range(2):
            best = None
            for leaf in leaves:
                low, high = leaf
                if high - low < 2:
                    continue
                g, h = np.cumsum(slope[low:high]), np.cumsum(weight[low:high])
                left, right = (g[:-1], h[:-1]), (g[-1] - g[:-1], h[-1] - h[:-1])
                gain = left[0] * self._value(*left) + right[0] * self._value(*right) - g[-1] * self._value(g[-1], h[-1])
                at = int(np.argmax(gain))
                if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                    best = (gain[at], leaf, low + at + 1)
            if best is None:
                break
            leaves.remove(best[1])
            leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
        step = np.zeros(len(slope))
        for low, high in leaves:
            step[low:high] = self._value(slope[low:high].sum(), weight[low:high].sum())
        return step

    def _quadrants(self, slope: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """The best split of a grid by one cut on either side: its gain and its steps."""
        rows, columns = slope.shape
        step = np.zeros(slope.shape)
        if rows < 2 or columns < 2:
            return 0.0, step
        g, h = (np.cumsum(np.cumsum(m, 0), 1) for m in (slope, weight))
        quarters = []
        for m in (g, h):
            a = m[:-1, :-1]
            b, c = m[:-1, -1:] - a, m[-1:, :-1] - a
            quarters.append((a, b, c, m[-1, -1] - a - b - c))
        gain = sum(x * self._value(x, y) for x, y in zip(*quarters)) - g[-1, -1] * self._value(g[-1, -1], h[-1, -1])
        i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[i, j] <= 1e-9:
            return 0.0, step
        a, b, c, d = (self._value(x[i, j], y[i, j]) for x, y in zip(*quarters))
        step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = a, b, c, d
        return float(gain[i, j]), step

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(cuts, values[:, j], side="right")]
        for a, b, table in self.pair_tables:
            total += table[
                np.searchsorted(self.coarse[a], values[:, a], side="right"),
                np.searchsorted(self.coarse[b], values[:, b], side="right"),
            ]
        return 1 / (1 + np.exp(-total))


def statistics_column(text: Column) -> Column:
    """The statistics of a text as an array."""

    @F.arrow_udf("array<double>")
    def values(column: pa.Array) -> pa.Array:
        return pa.array(statistics_matrix(texts_of(column)).tolist(), pa.list_(pa.float64()))

    return values(text)


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id",
    label_column: str = "quality", max_rows: int = MAX_TRAIN_ROWS, **settings,
) -> AdditiveModel:
    """A model learned from the labelled documents of the training folds, about `max_rows` of
    them at most. Of several rows of one id the one with the largest statistics counts."""
    small_batches(docs.sparkSession)
    chosen = bounded_sample(labelled(labels, id_column, label_column, FOLDS), "_id", max_rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    rows = (
        texts.join(F.broadcast(chosen), "_id")  # max_rows ids and labels
        .select("_id", "_label", statistics_column(F.col("_text")).alias("_values"))
        .groupBy("_id").agg(F.max("_label").alias("_label"), F.max("_values").alias("_values"))
        .orderBy("_id").collect()
    )
    values = np.array([r["_values"] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return AdditiveModel(**settings).fit(values, np.array([min(max(r["_label"], 0), 1) for r in rows], np.float64))


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """Chance of label 1, between 0 and 1."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics_matrix(texts_of(column))), pa.float64())

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels)
    return (
        docs.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that the model does not reject, with their columns as they are."""
    return docs.where(quality_score(train(docs, labels), F.col("text")) >= threshold)
