"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class given the words before, times that of the word in
its class. Classes come from word endings: endings that keep the same company (the same
neighbours over the whole corpus) are one class. The class model is a softmax whose features
are the hashed ending of the word before, of the one before that and of the third before (skips), and the
pair of the first two; weights live in one table of bounded size. Every round all training documents pass
through the tasks, which sum up the expected feature counts under the present weights; the
difference to the observed counts, scaled by their size, is the gradient step. Within a class
words have add-0.1 relative frequencies, with one unknown word per class, so the model is
a distribution over all words.

Word counts cover the whole corpus and are never collected: the most frequent words, at most
FREQUENT of them, are in a broadcast table, every other word is joined by itself.

Edge cases: a null or empty text is its end token alone. Rows without an id count as training
rows. Without training documents all counts are zero and the model is the unknown word's.
Repeated rows are counted and scored as often as they occur. An empty table gives an empty result. Very long texts
are read whole, a piece of tokens at a time. Other columns are not read and may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import held_out, small_batches, texts_of
from foldergrid.session import cut_lineage

FOLDS = 10
PSEUDO = 0.1
ENDING = 4                   # bytes of a word that decide its class
ENDING_BITS = 13
ENDINGS = 1 << ENDING_BITS   # hashed endings
COMPANY = 64                 # hashed neighbours that endings are compared by
CLASSES = 16
PAIRS = 1 << 14              # hashed pairs of preceding words
ROWS = 3 * ENDINGS + PAIRS   # of the weight table
ROUNDS = 2
RATE = 0.5
SMOOTH = 4.0
FREQUENT = 200_000           # words at most in the broadcast table, the most frequent ones
FREQUENT_BYTES = 8 << 20     # and bytes of them
END = b""                    # no word is empty
_HELD = 300_000              # words counted before they are passed on
_TOKENS = 1 << 16            # tokens that arrays are made for at a time


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def endings_of(words: list[bytes]) -> np.ndarray:
    """Number of the hashed ending of every word: its last bytes as one integer, multiplied and
    cut to the range. The end token's is 0."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = np.frombuffer(b"\0" * ENDING + b"".join(words), np.uint8)
    last = np.cumsum(lengths) + ENDING - 1
    value = np.zeros(len(words), np.uint32)
    for back in range(ENDING):
        value |= np.where(lengths > back, joined[last - back], 0).astype(np.uint32) << np.uint32(8 * back)
    return ((value * np.uint32(2654435761)) >> np.uint32(32 - ENDING_BITS)).astype(np.int64)


END_NUMBER = 0
# the features' rows of the weight table: (first, number)
TEMPLATES = [(0, ENDINGS), (ENDINGS, ENDINGS), (2 * ENDINGS, ENDINGS), (3 * ENDINGS, PAIRS)]


def features(endings: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the weight table for every token: (4, tokens). Before a document's first word
    stand end tokens; `starts` marks first words."""
    n = len(endings)
    place = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    out = np.empty((4, n), np.int64)
    for back in (1, 2, 3):
        own = out[back - 1]
        own[:back] = END_NUMBER
        own[back:] = endings[: max(n - back, 0)]
        own[place < back] = END_NUMBER
    out[3] = (out[0] * 40503 + out[1] * 9973) % PAIRS
    out += np.array([[first] for first, _ in TEMPLATES])
    return out


def log_classes(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Log probabilities (classes, tokens) under a weight table (classes, rows)."""
    total = np.empty((len(weights), rows.shape[1]), np.float32)
    for own, weight, constant in zip(total, weights, bias):
        np.take(weight, rows[0], out=own)
        for row in rows[1:]:
            own += weight[row]
        own += constant
    total -= total.max(0)
    total -= np.log(np.exp(total).sum(0))
    return total


def _tokens(texts: Iterator[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words and end tokens of several documents, where each ends), about _TOKENS at a time."""
    words, ends = [], []
    for text in texts:
        words += words_of(text)
        words.append(END)
        ends.append(len(words))
        if len(words) > _TOKENS:
            yield words, np.array(ends)
            words, ends = [], []
    if ends:
        yield words, np.array(ends)


def _documents(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(endings, whether each starts a document) of stored token sequences, in blocks."""
    held, size = [], 0
    for i in range(len(column)):
        own = np.frombuffer(column[i].as_py(), "<u2")
        held.append(own)
        size += len(own)
        if size > _TOKENS:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(sum(map(len, held)), bool)
    starts[np.cumsum([0, *map(len, held[:-1])])] = True
    return np.concatenate(held).astype(np.int64), starts


def _pieces(endings: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Overlapping pieces of a block that is a very long document: (endings, starts, the part
    of them that is new). The three tokens before a piece are repeated for its features."""
    for at in range(0, len(endings), _TOKENS):
        low = max(at - 3, 0)
        yield endings[low : at + _TOKENS], starts[low : at + _TOKENS], slice(at - low, None)


def _rows(values: np.ndarray) -> pa.RecordBatch:
    """Rows of a table of sums that are not all zero."""
    used = np.flatnonzero(values.any(1))
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), *[pa.array(values[used, c].astype(np.float64)) for c in range(values.shape[1])]],
        ["row", *[f"w{c}" for c in range(values.shape[1])]],
    )


def _summed(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """The sum of the tasks' tables. What reaches the driver is one table of fixed size."""
    names = [f"w{c}" for c in range(width)]
    out = np.zeros((rows, width))
    for r in parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[r["row"]] = r[1:]
    return out


def _table_schema(width: int) -> str:
    return "row int, " + ", ".join(f"w{c} double" for c in range(width))


def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often an ending stands beside each hashed neighbour, before (even columns of the
    hash) and after."""
    counts = np.zeros((ENDINGS, COMPANY))
    for batch in batches:
        for endings, starts in _documents(batch.column(0)):
            follows = ~starts[1:]
            left, right = endings[:-1][follows], endings[1:][follows]
            half = COMPANY // 2
            cells = np.concatenate([left * COMPANY + right % half, right * COMPANY + half + left % half])
            counts += np.bincount(cells, minlength=ENDINGS * COMPANY).reshape(ENDINGS, COMPANY)
    yield _rows(counts)


def classes_by_company(counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of every ending: weighted k-means of the square roots of the neighbour shares.
    Class 0 is the end token's; endings never seen get the class that is nearest to nothing."""
    size = counts.sum(1)
    points = np.sqrt(counts / np.maximum(size, 1)[:, None])
    seen = np.flatnonzero(size)
    out = np.ones(len(counts), np.int64)
    if len(seen):
        order = seen[np.argsort(-size[seen], kind="stable")]
        centres = [points[order[0]]]
        frequent = order[: 16 * classes]
        while len(centres) < classes - 1:  # among frequent endings the one that weighs and differs most
            apart = np.min([((points[frequent] - c) ** 2).sum(1) for c in centres], axis=0) * np.sqrt(size[frequent])
            centres.append(points[frequent[int(np.argmax(apart))]])
        centres = np.array(centres)
        for _ in range(12):
            nearest = (2 * points[seen] @ centres.T - (centres**2).sum(1)).argmax(1)
            for c in range(len(centres)):
                own = seen[nearest == c]
                if len(own):
                    centres[c] = np.average(points[own], axis=0, weights=size[own])
        out[seen] = 1 + (2 * points[seen] @ centres.T - (centres**2).sum(1)).argmax(1)
    out[END_NUMBER] = 0
    return out


def score_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    base_score is the add-0.1 unigram log10 probability, score the model's.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"), held_out(id_column, FOLDS).alias("_held"))

    @F.arrow_udf("binary")
    def sequences(column: pa.Array) -> pa.Array:
        out = []
        for words, ends in _tokens(texts_of(column)):
            numbers = endings_of(words).astype("<u2")
            out += [part.tobytes() for part in np.split(numbers, ends[:-1])]
        return pa.array(out, pa.binary())

    tokens = cut_lineage(own.select(sequences("_text").alias("endings"), "_held"))
    training = tokens.where("NOT _held").select("endings")
    counts = _word_counts(own)

    class_of = classes_by_company(_summed(training.mapInArrow(_company, _table_schema(COMPANY)), ENDINGS, COMPANY))

    @F.arrow_udf("int")
    def word_class(column: pa.Array) -> pa.Array:
        return pa.array(class_of[endings_of(column.to_pylist())].astype(np.int32)) if len(column) else pa.array([], pa.int32())

    per_class = {
        r["cls"]: r for r in counts.where("c > 0").withColumn("cls", word_class("word")).groupBy("cls")
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    }
    sizes = np.array([per_class[c]["n"] if c in per_class else 0 for c in range(CLASSES)], np.float64)
    kinds = np.array([per_class[c]["v"] if c in per_class else 0 for c in range(CLASSES)], np.float64)
    total, vocabulary = int(sizes.sum()), int(kinds.sum())
    mass = sizes + PSEUDO * (kinds + 1)
    bias = np.log(mass / mass.sum()).astype(np.float32)

    weights = _train(training, class_of, bias, rounds)
    scored = _local_scores(own, counts, class_of, weights, bias, mass, total)

    rare = scored.select("_row", F.explode("rare").alias("r")).select("_row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    joined = rare.join(counts.where(F.col("c") > 0).select("word", "c"), "word", "left").groupBy("_row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(PSEUDO))).alias("rare_log"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("rare_known"),
    )
    log_counts = F.col("frequent_log") + F.coalesce("rare_log", F.lit(0.0))
    return scored.drop("rare").join(joined, "_row", "left").select(
        F.col("_id").alias(id_column), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("frequent_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (log_counts - F.col("n_tokens") * F.lit(float(np.log10(total + PSEUDO * (vocabulary + 1))))).alias("base_score"),
        (log_counts + F.col("gain")).alias("score"),
    )


def _word_counts(own: DataFrame) -> DataFrame:
    """(word, c in training rows, a in all rows), the end token among the words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = Counter(), Counter()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([*seen, *held], pa.binary()), pa.array([*seen.values(), *[0] * len(held)], pa.int64()),
                 pa.array([*seen.values(), *held.values()], pa.int64())], ["word", "c", "a"],
            )
            seen.clear()
            held.clear()
            return out

        for rows in batches:
            for text, out in zip(texts_of(rows.column(0)), rows.column(1).to_pylist()):
                counter = held if out else seen
                counter.update(words_of(text))
                counter[END] += 1
                if len(seen) + len(held) > _HELD:
                    yield batch()
        yield batch()

    partial = own.select("_text", "_held").mapInArrow(count, "word binary, c bigint, a bigint")
    return cut_lineage(partial.groupBy("word").agg(F.sum("c").alias("c"), F.sum("a").alias("a")))


def _least_count(counts: DataFrame) -> int:
    """How often a word must occur to be among at most FREQUENT words and FREQUENT_BYTES bytes:
    words are counted per eighth of a power of two of their count, which is some 500 rows."""
    step = F.floor(8 * F.log2("a")).cast("int")
    bins = counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word")).alias("size"), F.min("a").alias("least")
    ).orderBy(F.desc("step")).collect()
    words = size = 0
    least = 1 << 62
    for row in bins:
        words, size = words + row["n"], size + row["size"]
        if words > FREQUENT or size > FREQUENT_BYTES:
            break
        least = row["least"]
    return least


def _train(training: DataFrame, class_of: np.ndarray, bias: np.ndarray, rounds: int) -> np.ndarray:
    """The weight table (classes, rows) after `rounds` passes over all training documents."""
    spark = training.sparkSession
    classes = spark.sparkContext.broadcast(class_of)

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ROWS * CLASSES)
        for batch in batches:
            for block in _documents(batch.column(0)):
                for endings, starts, new in _pieces(*block):
                    rows, cls = features(endings, starts)[:, new], classes.value[endings[new]]
                    for (first, size), row in zip(TEMPLATES, rows):
                        part = np.bincount((row - first) * CLASSES + cls, minlength=size * CLASSES)
                        counts[first * CLASSES : (first + size) * CLASSES] += part
        yield _rows(counts.reshape(ROWS, CLASSES))

    observed = _summed(training.mapInArrow(observe, _table_schema(CLASSES)), ROWS, CLASSES)
    share = np.exp(bias.astype(np.float64))
    prior = SMOOTH * share
    # under weights of zero the expected counts are known without a pass
    expected = observed.sum(1, keepdims=True) * share
    weights = 0.25 * np.log((observed + prior) / (expected + prior))
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(np.ascontiguousarray(weights.T, np.float32))

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            table, counts = now.value, np.zeros((CLASSES, ROWS))
            for batch in batches:
                for block in _documents(batch.column(0)):
                    for endings, starts, new in _pieces(*block):
                        rows = features(endings, starts)[:, new]
                        chances = np.exp(log_classes(rows, table, bias))
                        for (first, size), row in zip(TEMPLATES, rows):
                            own = row - first
                            for c in range(CLASSES):
                                counts[c, first : first + size] += np.bincount(own, chances[c], size)
            yield _rows(counts.T)

        expected = _summed(training.mapInArrow(expect, _table_schema(CLASSES)), ROWS, CLASSES)
        weights += RATE * (observed - expected) / ((observed + expected) / 2 + 2 * prior)
    return np.ascontiguousarray(weights.T, np.float32)


def _local_scores(
    own: DataFrame, counts: DataFrame, class_of: np.ndarray, weights: np.ndarray, bias: np.ndarray, mass: np.ndarray, total: int
) -> DataFrame:
    """What a document's score needs besides the counts of its rare words: a row number, the
    part of its frequent words, the gain of the class model, and the rare words themselves."""
    spark = own.sparkSession
    limit = _least_count(counts)
    frequent = {bytes(r["word"]): r["c"] for r in counts.where(F.col("a") >= limit).select("word", "c").collect()}
    shared = spark.sparkContext.broadcast((
        {w: float(np.log10(c + PSEUDO)) for w, c in frequent.items()}, {w for w, c in frequent.items() if c == 0},
        class_of, weights, np.log10(mass),
    ))
    word = pa.struct([("word", pa.binary()), ("n", pa.int64())])
    names = ["n_tokens", "frequent_log", "frequent_known", "gain", "rare"]

    @F.arrow_udf("struct<n_tokens: bigint, frequent_log: double, frequent_known: bigint, gain: double, rare: array<struct<word: binary, n: bigint>>>")
    def score(column: pa.Array) -> pa.Array:
        logs, unseen, classes, table, log_mass = shared.value
        done = []
        for words, ends in _tokens(texts_of(column)):
            begins = np.concatenate(([0], ends[:-1]))
            values = np.array(list(map(logs.get, words)), np.float64)  # of a rare word no number
            rare = np.isnan(values)
            known = ~rare
            if unseen:
                known &= ~np.fromiter(map(unseen.__contains__, words), bool, len(words))
            kinds, counts, stops = [], [], [0]
            at = np.flatnonzero(rare)
            cuts = np.searchsorted(at, ends).tolist()
            own = [words[i] for i in at.tolist()]
            for first, last in zip([0, *cuts], cuts):
                found = Counter(own[first:last])
                kinds += found.keys()
                counts += found.values()
                stops.append(len(kinds))
            lists = pa.ListArray.from_arrays(
                pa.array(stops, pa.int32()), pa.StructArray.from_arrays([pa.array(kinds, pa.binary()), pa.array(counts, pa.int64())], fields=list(word))
            )
            starts = np.zeros(len(words), bool)
            starts[begins] = True
            gains = _gains(endings_of(words), starts, classes, table, bias, log_mass)
            done.append(pa.StructArray.from_arrays([
                pa.array(ends - begins), pa.array(np.add.reduceat(np.where(rare, 0.0, values), begins)),
                pa.array(np.add.reduceat(known.astype(np.int64), begins)), pa.array(np.add.reduceat(gains, begins)), lists,
            ], names))
        if done:
            return pa.concat_arrays(done)
        kind = [("n_tokens", pa.int64()), ("frequent_log", pa.float64()), ("frequent_known", pa.int64()), ("gain", pa.float64()), ("rare", pa.list_(word))]
        return pa.array([], pa.struct(kind))

    local = own.select("_id", "_held", score("_text").alias("s")).select("_id", "_held", "s.*")
    return cut_lineage(local.withColumn("_row", F.monotonically_increasing_id()))


def _gains(endings: np.ndarray, starts: np.ndarray, classes, table, bias, log_mass) -> np.ndarray:
    """What the class model adds to every token's log10 probability, less the mass of its class."""
    parts = []
    for own, begin, new in _pieces(endings, starts):
        cls = classes[own[new]]
        chance = log_classes(features(own, begin)[:, new], table, bias)
        parts.append(chance[cls, np.arange(len(cls))] / np.log(10) - log_mass[cls])
    return np.concatenate(parts).astype(np.float64)
