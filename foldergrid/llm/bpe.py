"""Byte-level BPE: encoding by the ranks of a vocabulary file, and decoding.

Pre-tokenisation uses no regular expression. Every codepoint is looked up in a class array.
A token may start depends on a small automaton over the classes; its transition functions
form a finite monoid, so functions compose by a table lookup and the state before every
character comes from an associative scan in numpy: block-wise, then over the blocks. The
slices between starts go through a cache of merged pairs.

Edge cases: a null text is the empty text, which has no ids. Texts are never cut, whatever
their length; long runs are merged with a heap. Repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.llm.common import chunks, free_name, small_batches, texts_of

# classes of codepoints
OTHER, LETTER, NUMBER, SPACE, QUOTE = range(5)
_TOP = 0x110000

# symbols of the automaton: a class, and for some what follows
L, N, P, Q2, Q3, LAST_SPACE, LAST_WHITE, WHITE, END = range(9)
# states: what the token being read is
FREE, IN_L, IN_N, IN_P, IN_W, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)
_STATES = 8
# the state that a symbol leads to where it starts a token
_OPENS = {
    L: IN_L, N: IN_N, P: IN_P, Q2: ONE_LEFT, Q3: TWO_LEFT,
    LAST_SPACE: AFTER_SPACE, LAST_WHITE: FREE, WHITE: IN_W, END: FREE,
}
# the symbols that a state takes in without starting a token
_STAYS = {
    IN_L: {L: IN_L},
    IN_N: {N: IN_N},
    IN_P: {P: IN_P, Q2: IN_P, Q3: IN_P},
    IN_W: {WHITE: IN_W},
    AFTER_SPACE: {L: IN_L, N: IN_N, P: IN_P, Q2: IN_P, Q3: IN_P},
    ONE_LEFT: {symbol: FREE for symbol in range(9)},
    TWO_LEFT: {symbol: ONE_LEFT for symbol in range(9)},
}
_SCAN_BLOCK = 64
_HEAP_FROM = 64
CACHE_ENTRIES = 250_000


def codepoint_ranges() -> list[tuple[int, int, int]]:
    """(first, end, class) of the codepoints that are letters, numbers or white space, by the
    tables of the tiktoken library, which the ids have to agree with."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, _TOP))))
    single = {bytes([i]): i for i in range(256)}
    found = []
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        matched = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        points = np.frombuffer(matched.decode().encode("utf-32-le"), "<u4").astype(np.int64)
        cuts = np.flatnonzero(np.diff(points) != 1) + 1
        found += [(int(run[0]), int(run[-1]) + 1, kind) for run in np.split(points, cuts) if len(run)]
    return found


def _class_array(ranges: list[tuple[int, int, int]]) -> np.ndarray:
    table = np.zeros(_TOP, np.uint8)
    for first, end, kind in ranges:
        table[first:end] = kind
    table[ord("'")] = QUOTE
    return table


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each symbol, composition table, state after a function from a state,
    whether a symbol starts a token in a state)."""
    step = np.zeros((_STATES, 9), np.uint8)
    starts = np.ones((_STATES, 9), bool)
    for state in range(_STATES):
        for symbol in range(9):
            taken = _STAYS.get(state, {}).get(symbol)
            starts[state, symbol] = taken is None
            step[state, symbol] = _OPENS[symbol] if taken is None else taken
    functions = {tuple(range(_STATES)): 0}  # 0 is the identity
    symbols = [functions.setdefault(tuple(step[:, s]), len(functions)) for s in range(9)]
    generators, queue = [tuple(step[:, s]) for s in range(9)], list(functions)
    for f in queue:  # grows while it is read
        for g in generators:
            h = tuple(g[state] for state in f)
            if h not in functions:
                functions[h] = len(functions)
                queue.append(h)
    after = np.array(list(functions), np.uint8)
    compose = np.array([[functions[tuple(after[g][after[f]])] for g in range(len(after))] for f in range(len(after))])
    return np.array(symbols, np.uint16), compose.astype(np.uint16), after, starts


def _scan(functions: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """For every position the composition of all functions up to and including it."""
    n = len(functions)
    if n <= _SCAN_BLOCK:
        out, held = np.empty_like(functions), 0
        for i, f in enumerate(functions.tolist()):
            held = compose[held, f]
            out[i] = held
        return out
    size = len(compose)
    flat = compose.ravel()
    blocks = -(-n // _SCAN_BLOCK)
    padded = np.zeros(blocks * _SCAN_BLOCK, functions.dtype)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, _SCAN_BLOCK).T)
    for j in range(1, _SCAN_BLOCK):
        columns[j] = flat[columns[j - 1] * size + columns[j]]
    before = np.zeros(blocks, functions.dtype)
    before[1:] = _scan(columns[-1], compose)[:-1]
    return flat[before[None, :] * size + columns].T.reshape(-1)[:n]


def token_starts(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a token starts at each codepoint. `ends` are the positions that stand between
    two texts; each counts as a token of its own."""
    symbols_of, compose, after, starts = _monoid()
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = classes[points]
    kind[ends] = OTHER
    white = kind == SPACE
    followed = np.zeros(n, bool)  # by a character of the same text that is not white
    followed[:-1] = ~white[1:]
    at_end = np.zeros(n, bool)
    at_end[ends] = True
    followed[:-1] &= ~at_end[1:]
    symbol = np.full(n, P, np.uint8)
    symbol[kind == LETTER] = L
    symbol[kind == NUMBER] = N
    symbol[white] = WHITE
    last = white & followed
    symbol[last] = LAST_WHITE
    symbol[last & (points == 0x20)] = LAST_SPACE
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        padded = np.append(points, [0, 0])
        padded[ends] = 0
        one, two = padded[quotes + 1], padded[quotes + 2]
        pairs = one * 256 + np.where(two < 256, two, 0)
        symbol[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = Q2
        known = [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]
        symbol[quotes[np.isin(pairs, known) & (one < 256)]] = Q3
    symbol[ends] = END
    reached = after[_scan(symbols_of[symbol], compose), FREE]
    state = np.zeros(n, np.uint8)
    state[1:] = reached[:-1]
    return starts[state, symbol]


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the adjacent pair of the lowest rank, the leftmost of
    equals, until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) < _HEAP_FROM:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, 1 << 31) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == 1 << 31:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 31)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 31)
        return [ranks[part] for part in parts]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it was merged away
    before = list(range(-1, n - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if end[i]]


class _Merged(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers; emptied when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge_pairs(piece.encode(), self.ranks), "<u4").tobytes()
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(piece) <= _HEAP_FROM:
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary. Made once per Python worker."""

    def __init__(self, rank_file: bytes, ranges: list[tuple[int, int, int]]):
        ranks = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.merged = _Merged(ranks)
        self.classes = _class_array(ranges)
        self.tokens = {rank: token for token, rank in ranks.items()}
        top = max(ranks.values(), default=-1) + 1
        self.lengths = np.zeros(top, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.first = np.concatenate(([0], np.cumsum(self.lengths)))
        self.bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(top)), np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(text) + 1 for text in texts]) - 1
        starts = np.flatnonzero(token_starts(points, ends, self.classes))
        slot = np.searchsorted(starts, ends)  # the end marks among the starts
        bounds = starts.tolist()
        out, at, ids_of = [], 0, self.merged.__getitem__
        for stop in slot.tolist():
            own = bounds[at : stop + 1]
            out.append(b"".join([ids_of(joined[a:b]) for a, b in zip(own, own[1:])]))
            at = stop + 1
        return out

    def offsets(self, ids: bytes) -> bytes:
        """Where each token ends in the bytes of the text, as unsigned 32-bit integers."""
        return np.cumsum(self.lengths[np.frombuffer(ids, "<u4")]).astype("<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        lengths = self.lengths[numbers]
        stops = np.cumsum(lengths)
        if not len(stops) or not stops[-1]:
            return b""
        shift = np.repeat(self.first[numbers] - (stops - lengths), lengths)
        return self.bytes[shift + np.arange(stops[-1])].tobytes()

    def decode_slice(self, ids: bytes, offsets: bytes, start: int, stop: int) -> bytes:
        """Bytes [start, stop) of the text: only the tokens that cover them are decoded."""
        ends = np.frombuffer(offsets, "<u4").astype(np.int64)
        first, last = np.searchsorted(ends, [start, stop], side="right")
        base = int(ends[first - 1]) if first else 0
        part = self.decode(ids[4 * int(first) : 4 * (int(last) + 1)])
        return part[max(start - base, 0) : max(stop - base, 0)]


_codecs: dict[str, Codec] = {}


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file in the hands of every task. The file is read once on the driver and
    broadcast; `max_bytes` bounds it (vocabularies of public tokenizers take a few MB)."""

    spark: SparkSession
    path: str
    max_bytes: int = 64 << 20

    def _codec(self):
        small_batches(self.spark)
        with open(self.path, "rb") as file:
            ranks = file.read(self.max_bytes + 1)
        if len(ranks) > self.max_bytes:
            raise ValueError(f"The vocabulary {self.path} is larger than {self.max_bytes} bytes.")
        shared = self.spark.sparkContext.broadcast((ranks, codepoint_ranges()))
        name = hashlib.sha256(ranks).hexdigest()

        def codec() -> Codec:
            if name not in _codecs:  # a reused worker keeps its codec and the pairs it has merged
                _codecs.clear()
                _codecs[name] = Codec(*shared.value)
            return _codecs[name]

        return codec

    def encode(self, text: Column) -> Column:
        """struct<ids: binary, offsets: binary> of a text: ids as little-endian unsigned 32-bit
        integers, the byte offset at which each token ends likewise."""
        codec = self._codec()
        kind = pa.struct([("ids", pa.binary()), ("offsets", pa.binary())])

        @F.arrow_udf("ids binary, offsets binary")
        def encoded(column: pa.Array) -> pa.Array:
            own, done = codec(), []
            for part in chunks(texts_of(column)):
                ids = own.encode(part)
                arrays = [pa.array(ids, pa.binary()), pa.array([own.offsets(i) for i in ids], pa.binary())]
                done.append(pa.StructArray.from_arrays(arrays, fields=list(kind)))
            return pa.concat_arrays(done) if done else pa.array([], kind)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for; null ids are none."""
        codec = self._codec()

        @F.arrow_udf("binary")
        def decoded(column: pa.Array) -> pa.Array:
            own = codec()
            return pa.array([own.decode(i.as_py() or b"") for i in column], pa.binary())

        return decoded(ids)

    def decode_slice(self, encoded: Column, start: Column, stop: Column) -> Column:
        """Bytes [start, stop) of the text behind an encoded struct."""
        codec = self._codec()

        @F.arrow_udf("binary")
        def sliced(column: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
            own = codec()
            rows = zip(column.to_pylist(), first.to_pylist(), last.to_pylist())
            return pa.array([own.decode_slice(e["ids"], e["offsets"], a, b) for e, a, b in rows], pa.binary())

        return sliced(encoded, start, stop)


def encode_and_decode(docs: DataFrame, text: str, path: str) -> DataFrame:
    """`docs` with `ids`, `offsets` and `decoded`: the round trip of every whole text.
    Columns of these names are replaced."""
    tokenizer = Tokenizer(docs.sparkSession, path)
    kept = docs.drop("ids", "offsets", "decoded") if text not in ("ids", "offsets", "decoded") else docs
    encoded = free_name(kept, "encoded")
    return (
        kept.withColumn(encoded, tokenizer.encode(F.col(f"`{text}`")))
        .withColumns({"ids": F.col(f"{encoded}.ids"), "offsets": F.col(f"{encoded}.offsets")}).drop(encoded)
        .withColumn("decoded", tokenizer.decode(F.col("ids")))
    )


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    done = encode_and_decode(docs.select("doc_id", "text"), "text", path)
    return done.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
