"""Toxicity: maximum-scoring segments of token log-odds.

Words, and the first letters of words for those never seen, get log-odds between toxic and
other documents under a Dirichlet prior of background shares. Those whose likelihood ratio
leaves no room for chance, given how many are tried, are the lexicon. All other words share a small negative score. One linear
scan finds every maximal segment. Under the scores of clean text the best segment of n words
follows an extreme-value law; its parameters turn a segment's score into a p-value, and a
logistic curve over the normalised score gives the document's.

Edge cases: a text without any segment, null and empty ones included, has the lowest score that
the calibration saw, whatever its length. Labels without id or
value, and ids of the held-out fold, are never learned from; without labels of both classes
the lexicon is empty and the score is the smoothed share of label 1. Texts are never cut.
Repeated rows get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import bounded_sample, held_out, labelled, small_batches, texts_of
from foldergrid.session import cut_lineage

# labelled documents of each class that training may take
MAX_TRAIN_ROWS = 15_000
FOLDS = 5
PREFIXES = (5, 4)
PRIOR_SHARE = 0.05    # of the sample: pseudo documents of either class that hold words at their background share
MIN_DRIFT = -0.02     # of a word outside the lexicon, at most
SIGNIFICANT = 0.01
_CACHE = 300_000
# ASCII that is neither letter nor digit separates words
_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


def prefix(word: bytes, size: int) -> bytes | None:
    """The first letters of a longer word, marked so that they are no word."""
    letters = word.decode()
    return letters[:size].encode() + b"*" if len(letters) > size else None


def terms_of(words: list[bytes]) -> set[bytes]:
    """The distinct words and their prefixes."""
    distinct = set(words)
    return distinct | {p for word in distinct for size in PREFIXES if (p := prefix(word, size))}


def sketch(words: list[bytes]) -> int:
    """The smallest hash of a triple of words: equal for copies, mostly equal for near copies."""
    triples = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    return min((xxhash.xxh64_intdigest(b" ".join(t)) for t in triples), default=0) - (1 << 63)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in one linear scan.

    Each is a run no part of which scores more and that no better run contains.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    # neighbouring positive scores are one run to begin with
    first = positive[np.concatenate(([True], np.diff(positive) > 1))]
    last = positive[np.concatenate((np.diff(positive) > 1, [True]))] + 1
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    before: list[int] = []  # the last earlier candidate whose sum before is lower, or -1
    for start, end, low, high in zip(first.tolist(), last.tolist(), sums[first].tolist(), sums[last].tolist()):
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = before[j]
            if j < 0 or found[j][3] >= high:
                found.append((start, end, low, high))
                before.append(j)
                break
            start, low = found[j][0], found[j][2]
            del found[j:], before[j:]
    return [(start, end, high - low) for start, end, low, high in found]


class _Scores(dict):
    """Word -> score, with the words outside the lexicon looked up by prefix and remembered."""

    def __init__(self, lexicon: dict[bytes, float], drift: float):
        super().__init__()
        self.lexicon, self.drift = lexicon, drift

    def __missing__(self, word: bytes) -> float:
        value = self.lexicon.get(word)
        for size in PREFIXES:
            if value is None and (p := prefix(word, size)):
                value = self.lexicon.get(p)
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = self.drift if value is None else value
        return value


@dataclass
class ToxicityModel:
    lexicon: dict = field(default_factory=dict)
    drift: float = MIN_DRIFT
    rate: float = 1.0        # of the extreme-value law
    log_scale: float = 0.0   # log of its factor to the number of words
    bias: float = 0.0
    slope: float = 0.0
    lowest: float = np.inf   # normalised score that calibration saw, which a text without a segment gets

    def _scores(self) -> _Scores:
        if "_cache" not in self.__dict__:
            self.__dict__["_cache"] = _Scores(self.lexicon, self.drift)
        return self.__dict__["_cache"]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_cache"}

    def token_scores(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._scores().__getitem__, words), np.float64, len(words))

    def normalised(self, score: float, words: int) -> float:
        return self.rate * score - self.log_scale - np.log(max(words, 1))

    def p_value(self, score: float, words: int) -> float:
        """Chance that clean text of so many words has a segment of this score."""
        return float(-np.expm1(-np.exp(-self.normalised(score, words))))

    def document(self, text: str | None) -> tuple[float, list[dict]]:
        """(score between 0 and 1, significant passages with their places among the words and bytes)."""
        words = words_of(text)
        found = segments(self.token_scores(words))
        best = max((s for _, _, s in found), default=0.0)
        value = self.normalised(best, len(words)) if found or np.isinf(self.lowest) else self.lowest
        score = float(1 / (1 + np.exp(-(self.bias + self.slope * value))))
        hits = [(a, b, s, p) for a, b, s in found if (p := self.p_value(s, len(words))) <= SIGNIFICANT]
        if not hits:
            return score, []
        blank = np.frombuffer(b" " + text.lower().encode().translate(_BLANK) + b" ", np.uint8)
        solid = ~np.isin(blank, list(b" \t\n\r\x0b\x0c"))
        begins = np.flatnonzero(solid[1:] & ~solid[:-1])
        ends = np.flatnonzero(solid[:-1] & ~solid[1:])
        return score, [
            {"first_word": a, "end_word": b, "first_byte": int(begins[a]), "end_byte": int(ends[b - 1]), "score": s, "p_value": p}
            for a, b, s, p in hits
        ]


PASSAGES = "array<struct<first_word: bigint, end_word: bigint, first_byte: bigint, end_byte: bigint, score: double, p_value: double>>"
_PASSAGE = pa.struct(
    [(n, pa.int64()) for n in ("first_word", "end_word", "first_byte", "end_byte")] + [("score", pa.float64()), ("p_value", pa.float64())]
)


def _sketch(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def sketches(column: pa.Array) -> pa.Array:
        return pa.array([sketch(words_of(text)) for text in texts_of(column)], pa.int64())

    return sketches(text)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold a term; partial counts, let go at a bounded number."""
    toxic, clean = Counter(), Counter()

    def batch() -> pa.RecordBatch:
        terms = list(toxic.keys() | clean.keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.binary()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
            ["term", "toxic", "clean"],
        )
        toxic.clear()
        clean.clear()
        return out

    for rows in batches:
        for text, label in zip(texts_of(rows.column(0)), rows.column(1).to_pylist()):
            (toxic if label else clean).update(terms_of(words_of(text)))
            if len(toxic) + len(clean) > 400_000:
                yield batch()
    yield batch()


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id",
    label_column: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
) -> ToxicityModel:
    """A model learned from the training folds: about `max_rows` documents of each class at
    most, of near copies mostly one."""
    small_batches(docs.sparkSession)
    known = labelled(labels, id_column, label_column, FOLDS).withColumn("_label", (F.col("_label") > 0).cast("int"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    positive, total = counts.get(1, 0), sum(counts.values())
    model = ToxicityModel(bias=float(np.log((positive + 1) / (total - positive + 1))))
    if not 0 < positive < total:
        return model
    chosen = bounded_sample(known.where("_label = 1"), "_id", max_rows).unionByName(
        bounded_sample(known.where("_label = 0"), "_id", max_rows)
    )
    sample = cut_lineage(
        docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(chosen), "_id")  # 2 * max_rows ids and labels
        .withColumn("_sketch", _sketch(F.col("_text")))
        .groupBy("_label", "_sketch").agg(F.min(F.struct("_id", "_text")).alias("_row"))
        .select("_label", F.col("_row._text").alias("_text"))
    )
    sizes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return model
    model.lexicon = _lexicon(sample, sizes[1], sizes[0])
    return _calibrate(model, sample, float(positive / total))


def _lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[bytes, float]:
    """Log-odds, under the prior, of the terms that chance does not explain: those whose
    log-likelihood ratio reaches the log of the number of terms that are tried. Each is in
    several sampled documents, so their number is bounded by the sample."""
    counted = cut_lineage(
        sample.select("_text", "_label").mapInArrow(_count_terms, "term binary, toxic bigint, clean bigint")
        .groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    )
    evidence = float(np.log(max(counted.count(), 2)))
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    share = (t + c) / (n_toxic + n_clean)
    prior = PRIOR_SHARE * (n_toxic + n_clean)
    odds = F.log((t + prior * share) / (n_toxic + prior)) - F.log((c + prior * share) / (n_clean + prior))
    ratio = t * F.log(t / (n_toxic * share)) + F.when(c > 0, c * F.log(c / (n_clean * share))).otherwise(0.0)
    scored = counted.where("t > 0").where((odds > 0) & (ratio >= evidence)).select("term", odds.alias("score"))
    return {bytes(r["term"]): r["score"] for r in scored.collect()}


def _calibrate(model: ToxicityModel, sample: DataFrame, share: float) -> ToxicityModel:
    """Drift, extreme-value law and logistic curve, from the sampled documents' best segments."""
    lexicon = model.lexicon

    @F.arrow_udf("struct<words: bigint, hits: bigint, total: double, powers: array<double>>")
    def profile(column: pa.Array) -> pa.Array:
        own, rows = ToxicityModel(lexicon, 0.0), []
        for text in texts_of(column):
            scores = own.token_scores(words_of(text))
            hit = scores[scores > 0]
            rows.append({"words": len(scores), "hits": len(hit), "total": float(hit.sum()),
                         "powers": [float(np.expm1(rate * hit).sum()) for rate in _RATES]})
        return pa.array(rows, pa.struct([("words", pa.int64()), ("hits", pa.int64()), ("total", pa.float64()), ("powers", pa.list_(pa.float64()))]))

    sums = sample.select("_label", profile("_text").alias("p")).groupBy("_label").agg(
        F.sum("p.words").alias("words"), F.sum("p.hits").alias("hits"),
        *[F.sum(F.col("p.powers")[i]).alias(f"e{i}") for i in range(len(_RATES))],
    )
    toxic, clean = (next(r for r in sums.collect() if r["_label"] == label) for label in (1, 0))
    rates = [(r["hits"] + 0.5) / (r["words"] + 1.0) for r in (toxic, clean)]
    model.drift = min(float(np.log((1 - rates[0]) / (1 - rates[1]))), MIN_DRIFT)
    # the positive root of E[exp(rate * score)] = 1 over clean words, with half a word of every
    # lexicon score added; where even the largest rate tried stays below 1, that rate
    extra = np.array(list(lexicon.values()) or [0.0])
    for i, rate in enumerate(_RATES):
        gain = clean[f"e{i}"] + 0.5 * float(np.mean(np.expm1(rate * extra)))
        model.rate = rate
        if clean["words"] * np.expm1(rate * model.drift) + gain >= 0:
            break

    fixed = model

    @F.arrow_udf("struct<best: double, words: bigint>")
    def best(column: pa.Array) -> pa.Array:
        rows = []
        for text in texts_of(column):
            words = words_of(text)
            found = segments(fixed.token_scores(words))
            rows.append({"best": max((s for _, _, s in found), default=0.0), "words": len(words)})
        return pa.array(rows, pa.struct([("best", pa.float64()), ("words", pa.int64())]))

    rows = sample.select("_label", best("_text").alias("b")).select("_label", "b.best", "b.words").collect()  # two numbers a sampled document
    label = np.array([r["_label"] for r in rows], np.float64)
    score = np.array([r["best"] for r in rows])
    words = np.maximum(np.array([r["words"] for r in rows], np.float64), 1)
    null = label == 0
    # the law's factor: the share of clean documents without a segment above s is exp(-K n exp(-rate s))
    model.log_scale = float(-np.log(np.mean(words[null] * np.exp(-model.rate * score[null]))))
    value = model.rate * score - model.log_scale - np.log(words)
    weight = np.where(null, (1 - share) / max(null.mean(), 1e-9), share / max(1 - null.mean(), 1e-9))
    model.lowest = float(value.min())
    value = np.where(score > 0, value, model.lowest)
    model.bias, model.slope = _logistic(value, label, weight)
    return model


_RATES = [0.05 * 1.1 ** i for i in range(45)]


def _logistic(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton steps, with a small ridge so that separable classes end."""
    centre, spread = float(np.mean(value)), float(np.std(value)) or 1.0
    x = np.stack([np.ones(len(value)), (value - centre) / spread], 1)
    beta, ridge = np.zeros(2), np.diag([1e-6, 1e-3])
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - chance)) - ridge @ beta
        curve = (x * (weight * np.maximum(chance * (1 - chance), 1e-9))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] - beta[1] * centre / spread), float(beta[1] / spread)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """struct<score: double, passages: array<…>>: the document's score and every significant
    passage, by word and by byte of the lower-cased text."""

    @F.arrow_udf(f"struct<score: double, passages: {PASSAGES}>")
    def judged(column: pa.Array) -> pa.Array:
        rows = [dict(zip(("score", "passages"), model.document(text))) for text in texts_of(column)]
        return pa.array(rows, pa.struct([("score", pa.float64()), ("passages", pa.list_(_PASSAGE))]))

    return judged(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of significant passages of every document."""
    model = train(docs, labels)
    return (
        docs.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), toxicity(model, F.col("text")).alias("_t"))
        .select("doc_id", "held_out", F.col("_t.score").alias("score"),
                (F.col("_t.score") >= threshold).cast("int").alias("predicted"), F.size("_t.passages").alias("n_passages"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` below the threshold, with their columns as they are."""
    return docs.where(toxicity(train(docs, labels), F.col("text"))["score"] < threshold)
