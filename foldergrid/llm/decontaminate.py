"""Benchmark decontamination: a BM25 index of test items, searched with block-max WAND.

The items are the index, every passage of every document is a query. Impacts are divided by
the score an item has for its own text, so one threshold between 0 and 1 holds for all items:
the weighted share of an item's words that a passage holds. Passages overlap by half and are
twice as long as the longest item, so an item that stands in a text in one piece stands in
some passage whole. The block maxima come first, for all passages of a batch at once: the
largest impacts that a passage's words have in a block of items add up to a bound for all of
them, in two steps, wide blocks and then, where those pass, narrow ones. A long list of items
makes several indexes under the statistics of all items, so scores and passages do not depend
on how the list is cut. A list of more than MAX_BROADCAST_CHARS is not broadcast at all: the words that an item cannot reach the
threshold without are joined to the words of the texts, and a text meets the indexes that it shares such a word with. What is left is
searched with block-max WAND, which retrieves every item above the threshold. Then question and answer are verified: the share of their word n-grams that occur in the
passage must reach the overlap asked for, in both. A part so short that one changed word may
take it below the overlap counts the words that stand in the passage in its order as well.

Edge cases: null and empty texts hold nothing; items without a word are never found; repeated
items and repeated rows are found as often as they occur. An item without an answer of its own
is split: its last sentence, if it has several, is the answer; as that is a guess, the overlap
of the undivided item will do. An answer of one word must be there itself.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import free_name, small_batches, texts_of
from foldergrid.session import cut_lineage

RETRIEVE = 0.6       # weighted share of an item's words
OVERLAP = 0.5        # share of the n-grams of question and answer, or of the words in order of a short one
NGRAM, ANSWER_NGRAM = 5, 3   # words; answers are short
K1, B = 1.2, 0.75
MIN_PASSAGE = 64     # words that passages advance by, at least
ITEMS_PER_BLOCK = 8
ITEMS_PER_CELL = 2           # of a narrow block
MAX_INDEX_CHARS = 1 << 18    # text of the items in one broadcast index; more items make more indexes
MAX_BROADCAST_CHARS = 16 << 20   # text of the items in all broadcast indexes; longer lists are joined
TEXTS_PER_TASK = 20_000      # that meet one index in one task
_SLACK = 1e-4                # of bounds in single precision
_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BATCH_CHARS = 1 << 19


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


def question_and_answer(text: str | None) -> tuple[str, str]:
    """The last sentence of several is the answer."""
    parts = re.split(r"(?<=[.?!])\s+", (text or "").strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (parts[0], "")


def ngrams(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """Runs of `size` words; of fewer words the one run they are."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)}


def aligned(part: list[bytes], places: dict[bytes, list[int]], least: int) -> float:
    """Largest share of a part's words that stand in the passage at the same distances, give or
    take one word put in or left out; fewer than `least` words count as none."""
    offsets: dict[int, set[int]] = defaultdict(set)
    for i, word in enumerate(part):
        for j in places.get(word, ()):
            offsets[j - i].add(i)
            offsets[j - i + 1].add(i)
    most = max(map(len, offsets.values()), default=0)
    return most / len(part) if most >= min(least, len(part)) else 0.0


@dataclass
class Statistics:
    """Of all items that have a word."""

    items: int
    words: int
    longest: int   # words
    df: dict       # word -> items that have it; of a part's words at least


@dataclass
class ItemIndex:
    """Postings of normalised impacts, sorted by item and cut into blocks with their maxima."""

    ids: list
    parts: list = field(default_factory=list)      # [(words, their n-grams)] of question, answer and, if split by guess, both
    terms: dict = field(default_factory=dict)      # word -> number
    postings: list = field(default_factory=list)   # per word: ([item, …], [impact, …])
    peaks: list = field(default_factory=list)      # per word: the largest impact
    blocks: list = field(default_factory=list)     # per word: {block: the largest impact in it}
    stride: int = MIN_PASSAGE

    @staticmethod
    def build(items: list[tuple], size: int = NGRAM, guessed: bool = False, whole: Statistics | None = None) -> ItemIndex:
        """`items`: (id, question, answer); `guessed` if answers are last sentences; `whole` holds
        the statistics of a list of which these are a part. Items are put in the order of their
        rarest words, so that blocks hold items that share words."""
        split = [(key, words_of(q), words_of(a)) for key, q, a in items]
        split = [(key, q, a) for key, q, a in split if q or a]
        lengths = [len(q) + len(a) for _, q, a in split]
        whole = whole or Statistics(len(split), sum(lengths), max(lengths, default=0), Counter(word for _, q, a in split for word in {*q, *a}))
        df, n = whole.df, whole.items
        split.sort(key=lambda item: (max({*item[1], *item[2]}, key=lambda w: (df[w], w)), min({*item[1], *item[2]}, key=lambda w: (df[w], w))))
        index = ItemIndex([key for key, _, _ in split])
        lengths = [len(q) + len(a) for _, q, a in split]
        mean = whole.words / n if n else 1.0
        postings: dict[bytes, list] = defaultdict(list)
        for i, (_, q, a) in enumerate(split):
            counts = Counter(q + a)
            impact = {
                w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * lengths[i] / mean))
                for w, c in counts.items()
            }
            own = sum(impact.values())
            for w, value in impact.items():
                postings[w].append((i, value / own))
            parts = [(q, ngrams(q, size)), (a, ngrams(a, min(size, ANSWER_NGRAM)))]
            index.parts.append(parts + [(q + a, ngrams(q + a, size))] if guessed else parts)
        for word, entries in postings.items():
            index.terms[word] = len(index.postings)
            index.postings.append(([i for i, _ in entries], [value for _, value in entries]))
            index.peaks.append(max(value for _, value in entries))
            maxima: dict[int, float] = {}
            for i, value in entries:
                maxima[i // ITEMS_PER_BLOCK] = max(maxima.get(i // ITEMS_PER_BLOCK, 0.0), value)
            index.blocks.append(maxima)
        index.stride = max(MIN_PASSAGE, whole.longest)
        index._fill_maxima()
        return index

    def _fill_maxima(self) -> None:
        """Tables word x block of the largest impacts, for wide and for narrow blocks; the last
        row is that of words in no item."""
        wide = -(-len(self.ids) // ITEMS_PER_BLOCK) or 1
        self.narrow = np.zeros((len(self.postings) + 1, wide * (ITEMS_PER_BLOCK // ITEMS_PER_CELL)), np.float32)
        for term, (items, values) in enumerate(self.postings):
            np.maximum.at(self.narrow[term], np.array(items) // ITEMS_PER_CELL, np.array(values, np.float32))
        self.wide = self.narrow.reshape(len(self.postings) + 1, wide, -1).max(2, initial=0)

    def promising(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: float) -> np.ndarray:
        """Passages (spans of the word numbers `terms`) that may hold an item: those with a
        narrow block whose bound reaches the threshold."""
        none, lengths = len(self.postings), ends - starts
        if not self.ids or not lengths.sum():
            return np.zeros(0, np.int64)
        passage = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
        word = terms[place]
        known = word < none
        pairs = np.sort(passage[known] * (none + 1) + word[known])
        distinct = pairs[np.concatenate((np.ones(min(len(pairs), 1), bool), pairs[1:] != pairs[:-1]))]
        if not len(distinct):
            return np.zeros(0, np.int64)
        passage, word = np.divmod(distinct, none + 1)
        first = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        count = np.diff(np.append(first, len(passage)))
        row, block = np.nonzero(np.add.reduceat(self.wide[word], first, axis=0) >= threshold - _SLACK)
        if not len(row):
            return np.zeros(0, np.int64)
        cells = ITEMS_PER_BLOCK // ITEMS_PER_CELL
        table = self.narrow.reshape(none + 1, -1, cells)
        kept = []
        for at in range(0, len(row), 4096):  # (passage, block) pairs, each with all words of the passage
            own, where = row[at : at + 4096], block[at : at + 4096]
            size = count[own]
            begin = np.cumsum(size) - size
            each = np.arange(size.sum()) - np.repeat(begin, size) + np.repeat(first[own], size)
            sums = np.add.reduceat(table[word[each], np.repeat(where, size)], begin, axis=0)
            kept.append(passage[first[own[sums.max(1) >= threshold - _SLACK]]])
        return np.unique(np.concatenate(kept))

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: (item, score) of every item that scores the threshold or more."""
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]  # item, position, word
        found, limit = [], threshold - 1e-9
        while True:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                total += self.peaks[t]
                if total >= limit:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // ITEMS_PER_BLOCK
            if sum(self.blocks[t].get(block, 0.0) for _, _, t in cursors[: pivot + 1]) < limit:
                # no item of the block is reached by these words: on to the next block, or to
                # where another word comes in
                target = (block + 1) * ITEMS_PER_BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                self._advance(cursors, pivot + 1, target)
            elif cursors[0][0] == item:
                score = sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= limit:
                    found.append((item, score))
                self._advance(cursors, pivot + 1, item + 1)
            else:
                self._advance(cursors, pivot, item)

    def _advance(self, cursors: list, count: int, target: int) -> None:
        """Move the first cursors to the first posting at or after the target."""
        for cursor in cursors[:count]:
            items = self.postings[cursor[2]][0]
            cursor[1] = at = bisect_left(items, target, cursor[1])
            cursor[0] = items[at] if at < len(items) else len(self.ids)
        cursors[:] = [c for c in cursors if c[0] < len(self.ids)]

    def match(self, texts: list[str | None], threshold: float, overlap: float, size: int) -> list[list[dict]]:
        """For each text the items found and verified, each with its best passage."""
        split = [words_of(text) for text in texts]
        flat = [word for words in split for word in words]
        none = len(self.postings)
        terms = np.fromiter(map(self.terms.get, flat, repeat(none)), np.int64, len(flat))
        sizes = np.array([len(words) for words in split], np.int64)
        bases = np.cumsum(sizes) - sizes
        spans = [np.arange(0, max(n - self.stride, 1), self.stride) for n in sizes.tolist()]
        owner = np.repeat(np.arange(len(split)), [len(own) for own in spans])
        starts = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        ends = np.minimum(starts + 2 * self.stride, sizes[owner])
        best: list[dict[int, dict]] = [{} for _ in split]
        for k in self.promising(terms, bases[owner] + starts, bases[owner] + ends, threshold).tolist():
            text, a, b = int(owner[k]), int(starts[k]), int(ends[k])
            present = set(terms[bases[text] + a : bases[text] + b].tolist()) - {none}
            for hit in self._verified(self.search(present, threshold), split[text][a:b], overlap, size):
                hit["word"] = a
                old = best[text].get(hit["item"])
                if old is None or (hit["overlap"], hit["score"]) > (old["overlap"], old["score"]):
                    best[text][hit["item"]] = hit
        return [[{**found[i], "item": self.ids[i]} for i in sorted(found)] for found in best]

    def _verified(self, hits: list[tuple[int, float]], words: list[bytes], overlap: float, size: int):
        if not hits:
            return
        seen: dict[int, set] = {}
        places: dict[bytes, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            places[word].append(i)
        for item, score in hits:
            shares = []
            for at, (part, grams) in enumerate(self.parts[item]):
                length = len(next(iter(grams), ()))
                if length not in seen:
                    seen[length] = ngrams(words, length) if length else set()
                share = len(grams & seen[length]) / len(grams) if grams else 1.0
                if share < overlap and length > (1 - overlap) * len(grams):  # one changed word may be in so many n-grams
                    share = max(share, aligned(part, places, 1 if at == 1 else 2))
                shares.append(share)
            reached = max(min(shares[:2]), *shares[2:]) if len(shares) > 2 else min(shares)
            if reached >= overlap:
                yield {"item": item, "score": score, "question": shares[0], "answer": shares[1], "overlap": reached}


def _words(question: str, answer: str) -> Column:
    """struct<n, words>: the number of an item's words, and the distinct ones."""
    @F.arrow_udf("struct<n: bigint, words: array<binary>>")
    def counted(questions: pa.Array, answers: pa.Array) -> pa.Array:
        split = [words_of(q) + words_of(a) for q, a in zip(texts_of(questions), texts_of(answers))]
        kind = pa.struct([("n", pa.int64()), ("words", pa.list_(pa.binary()))])
        return pa.array([{"n": len(words), "words": list(dict.fromkeys(words))} for words in split], kind)

    return counted(F.col(question), F.col(answer))


@dataclass
class _Dealt:
    """Items (_item, _q, _a, _w), each in a share (_part) of about MAX_INDEX_CHARS, the statistics of all, and the number of
    items that have a word."""

    items: DataFrame
    parts: int
    total: Statistics
    df: DataFrame


def _chosen(items: DataFrame, item_id: str, question: str, answer: str | None) -> tuple[DataFrame, int]:
    """The columns that count, and how many bytes of text they hold."""
    columns = [F.col(f"`{item_id}`").alias("_item"), F.col(f"`{question}`").alias("_q"), (F.col(f"`{answer}`") if answer else F.lit(None).cast("string")).alias("_a")]
    chosen = items.select(*columns)
    size_of = F.coalesce(F.octet_length("_q"), F.lit(0)) + F.coalesce(F.octet_length("_a"), F.lit(0))
    return chosen, chosen.agg(F.sum(size_of.cast("bigint"))).first()[0] or 0


def _deal(chosen: DataFrame, chars: int) -> _Dealt:
    parts = -(-chars // MAX_INDEX_CHARS) or 1
    dealt = cut_lineage(chosen.select("*", F.pmod(F.xxhash64("_item", "_q"), F.lit(parts)).cast("int").alias("_part"), _words("_q", "_a").alias("_w")))
    total = dealt.where("_w.n > 0").agg(F.count(F.lit(1)).alias("items"), F.sum("_w.n").alias("words"), F.max("_w.n").alias("longest")).first()
    each = dealt.select(F.explode("_w.words").alias("word"))
    df = cut_lineage(each.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    return _Dealt(dealt, parts, Statistics(total["items"], total["words"] or 0, total["longest"] or 0, {}), df)


def _index_of(rows: list[tuple], split: bool, size: int, whole: Statistics | None) -> ItemIndex:
    rows = [(i, *question_and_answer(q)) for i, q, _ in rows] if split else rows
    return ItemIndex.build(sorted(rows, key=lambda r: (r[0] is None, str(r[0]), str(r[1]))), size, split, whole)


def _indexes(items: DataFrame, item_id: str, question: str, answer: str | None, size: int) -> list:
    """Broadcast indexes of all items, each of a measured size: a long list of items makes
    several, collected one after the other."""
    spark = small_batches(items.sparkSession)
    chosen, chars = _chosen(items, item_id, question, answer)
    if chars <= MAX_INDEX_CHARS:
        return [spark.sparkContext.broadcast(_index_of([tuple(r) for r in chosen.collect()], answer is None, size, None))]
    dealt, shares = _deal(chosen, chars), []
    for part in range(dealt.parts):
        own = dealt.items.where(F.col("_part") == part)
        known = dealt.df.join(own.select(F.explode("_w.words").alias("word")), "word", "left_semi").collect()
        whole = Statistics(dealt.total.items, dealt.total.words, dealt.total.longest, {bytes(r["word"]): r["df"] for r in known})
        rows = [tuple(r) for r in own.select("_item", "_q", "_a").collect()]
        shares.append(spark.sparkContext.broadcast(_index_of(rows, answer is None, size, whole)))
    return shares


def signature(index: ItemIndex, threshold: float) -> set[bytes]:
    """Words of which every passage has one that can reach the threshold for any item: of each item those of most weight,
    until the others stay below it together."""
    of_item: dict[int, list] = defaultdict(list)
    for word, term in index.terms.items():
        for item, impact in zip(*index.postings[term]):
            of_item[item].append((impact, word))
    found = set()
    for weights in of_item.values():
        rest = sum(impact for impact, _ in weights)
        for impact, word in sorted(weights, reverse=True):
            if rest < threshold - _SLACK:
                break
            found.add(word)
            rest -= impact
    return found


def _joined(
    docs: DataFrame, text: str, items: DataFrame, chars: int, split: bool, threshold: float, overlap: float, size: int
) -> DataFrame:
    """`docs` rows with `_hits`, for those that share a signature word with an index. No index is broadcast:
    its words and items are read by the task that its texts are dealt to, before them."""
    dealt = _deal(items, chars)
    kind = items.schema["_item"].dataType
    words = dealt.items.select("_part", F.explode("_w.words").alias("word")).distinct().join(dealt.df, "word")
    none = lambda t: F.lit(None).cast(t)
    heads = words.select("_part", F.lit(0).alias("_kind"), "word", "df", none(kind).alias("_item"), none("string").alias("_q"), none("string").alias("_a")).unionByName(
        dealt.items.select("_part", F.lit(1).alias("_kind"), none("binary").alias("word"), none("bigint").alias("df"), "_item", "_q", "_a"))
    heads = cut_lineage(heads)
    stream = _Stream(dealt.total, split, threshold, overlap, size)
    signs = heads.repartition("_part").sortWithinPartitions("_part", "_kind").mapInArrow(stream.signatures, "word binary, _part int").distinct()

    @F.arrow_udf("array<binary>")
    def distinct_words(column: pa.Array) -> pa.Array:
        return pa.array([list(dict.fromkeys(words_of(t))) for t in texts_of(column)], pa.list_(pa.binary()))

    numbered = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("_number"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{text}`").alias("_text")
    ))
    pairs = numbered.select("_number", F.explode(distinct_words("_text")).alias("word")).join(signs, "word").select("_number", "_part").distinct()
    pairs = cut_lineage(pairs)
    salts = pairs.groupBy("_part").agg(F.ceil(F.count(F.lit(1)) / TEXTS_PER_TASK).cast("int").alias("_salts"))
    asked = (
        pairs.join(salts, "_part").withColumn("_salt", F.pmod(F.xxhash64("_number"), F.col("_salts")).cast("int"))
        .join(numbered.select("_number", "_text"), "_number").select("_part", "_salt", F.lit(2).alias("_kind"), "_number", "_text")
    )
    # every task that texts of an index are dealt to reads its words and items
    copies = heads.join(salts, "_part").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    both = copies.unionByName(asked, allowMissingColumns=True).repartition("_part", "_salt").sortWithinPartitions("_part", "_salt", "_kind")
    both = both.select("_part", "_salt", "_kind", "word", "df", "_item", "_q", "_a", "_number", "_text")
    hit = f"struct<item: {kind.simpleString()}, score: double, question: double, answer: double, word: bigint>"
    found = both.mapInArrow(stream.hits, f"_number bigint, _hits array<{hit}>")
    return numbered.select("_number", "_doc").join(found, "_number").select("_doc.*", "_hits")


class _Stream:
    """Reads shares of items one after the other, and their texts after them."""

    def __init__(self, total: Statistics, split: bool, threshold: float, overlap: float, size: int):
        self.total, self.split, self.threshold, self.overlap, self.size = total, split, threshold, overlap, size

    def _build(self, df: dict, rows: list) -> ItemIndex:
        whole = Statistics(self.total.items, self.total.words, self.total.longest, df)
        return _index_of(rows, self.split, self.size, whole)

    def signatures(self, batches):
        now, df, rows = None, {}, []

        def words() -> pa.RecordBatch:
            found = sorted(signature(self._build(df, rows), self.threshold))
            return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([now] * len(found), pa.int32())], names=["word", "_part"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["_part"] != now:
                    if now is not None:
                        yield words()
                    now, df, rows = row["_part"], {}, []
                if row["_kind"] == 0:
                    df[row["word"]] = row["df"]
                else:
                    rows.append((row["_item"], row["_q"], row["_a"]))
        if now is not None:
            yield words()

    def hits(self, batches):
        now, df, rows, index = None, {}, [], None
        for batch in batches:
            numbers, found = [], []
            for row in batch.to_pylist():
                if (row["_part"], row["_salt"]) != now:
                    now, df, rows, index = (row["_part"], row["_salt"]), {}, [], None
                if row["_kind"] == 0:
                    df[row["word"]] = row["df"]
                elif row["_kind"] == 1:
                    rows.append((row["_item"], row["_q"], row["_a"]))
                else:
                    index = index or self._build(df, rows)
                    [own] = index.match([row["_text"]], self.threshold, self.overlap, self.size)
                    if own:
                        numbers.append(row["_number"])
                        found.append([{k: v for k, v in hit.items() if k != "overlap"} for hit in own])
            if numbers:
                item = pa.struct([("item", batch.schema.field("_item").type), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("word", pa.int64())])
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(found, pa.list_(item))], names=["_number", "_hits"])


def matches(
    text: Column, items: DataFrame, item_id: str = "item_id", question: str = "text", answer: str | None = None,
    threshold: float = RETRIEVE, overlap: float = OVERLAP, size: int = NGRAM,
) -> Column:
    """array<struct<item, score, question, answer, word>> of the items that a text holds: the
    retrieval score, the verified shares, and the word at which the best passage starts."""
    kind = items.schema[item_id].dataType.simpleString()
    found = [
        _matcher(shared, kind, threshold, overlap, size)(text)
        for shared in _indexes(items, item_id, question, answer, size)
    ]
    return F.concat(*found) if len(found) > 1 else found[0]


def _matcher(shared, kind: str, threshold: float, overlap: float, size: int):
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    schema = f"array<struct<item: {kind}, score: double, question: double, answer: double, word: bigint>>"
    arrow = to_arrow_type(_parse_datatype_string(schema))

    @F.arrow_udf(schema)
    def match(column: pa.Array) -> pa.Array:
        index, rows, held, chars = shared.value, [], [], 0
        for text in texts_of(column):
            held.append(text)
            chars += len(text or "")
            if chars > _BATCH_CHARS:
                rows += index.match(held, threshold, overlap, size)
                held, chars = [], 0
        rows += index.match(held, threshold, overlap, size)
        return pa.array([[{k: v for k, v in hit.items() if k != "overlap"} for hit in row] for row in rows], arrow)

    return match


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` with `_hits`, the items that each text holds; those without any may be missing."""
    chosen, chars = _chosen(items, "item_id", "text", None)
    if chars <= MAX_BROADCAST_CHARS:
        return docs.withColumn("_hits", matches(F.col("text"), items))
    small_batches(docs.sparkSession)
    return _joined(docs, "text", chosen, chars, True, RETRIEVE, OVERLAP, NGRAM)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for every document and test item found in it."""
    found = _found(docs.select("doc_id", "text"), items).select("doc_id", F.explode("_hits").alias("m"))
    return found.select(
        "doc_id", F.col("m.item").alias("item_id"), F.col("m.score").alias("score"), F.col("m.question").alias("question_overlap"),
        F.col("m.answer").alias("answer_overlap"), F.col("m.word").alias("first_word"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` in which no test item is found, with their columns as they are."""
    chosen, chars = _chosen(items, "item_id", "text", None)
    if chars <= MAX_BROADCAST_CHARS:
        return docs.where(F.size(matches(F.col("text"), items)) == 0)
    number = free_name(docs, "row")
    numbered = cut_lineage(docs.withColumn(number, F.monotonically_increasing_id()))
    leaked = _found(numbered.select(F.col(number), "text"), items).where(F.size("_hits") > 0).select(number).distinct()
    return numbered.join(leaked, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
