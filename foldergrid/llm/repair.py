"""Repair of conversations: the cheapest edits after which system, user and assistant take turns.

Every way to edit a conversation is a path through a DAG whose nodes are (turns read, state of the
role pattern `(s?(ua)+)?`, letters written). An edge's weight is one whole number: its cost in the
high digits, and its letter in the low digits at the place that the letter has in the
audit. Letters have a fixed width, ascend as their ASCII codes do, and zero stands behind the last one, so the
smallest sum of weights is the smallest cost and among equals the ASCII-least audit: an ordinary
minimum over whole numbers decides everything, and the audit is read off the number.

Edits are Keep, Rerole (to user or assistant), Delete and Insert (an empty turn of user or assistant). Where an insertion costs
more than two deletions no cheapest repair has one: taking it out together with a turn beside it (and with a system turn
that would be left alone) leaves a valid dialogue and costs less, so its edges are left out. Then all paths
to a node have written as many letters, and after BLOCK turns the letters of each node give way to
its rank among the (at most four) nodes, which orders as the letters did: numbers stay short at any
length, and a conversation takes time in proportion to its turns.

Turns are shuffled once, by conversation, sorted there (Spark's sort, which spills) and read as a
stream: a task holds an Arrow batch, at most four numbers and running digests, and one byte a turn for the audit.
A digest of a repaired dialogue is by nature one sequence, so the turns of one conversation are read by one
task, one after the other, but never held.

Edge cases: null roles and texts read as one space; a null conversation id is a conversation of its own; null turn
numbers come first. Turns with equal numbers are ordered by role and text, so the result
does not depend on how rows arrive; repeated rows are duplicates. Roles that begin with another letter than s, u, a
cannot be kept. Very long texts are read whole. Other columns are not read and may have any names. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldergrid.llm.common import small_batches

LETTERS = " DIKR"  # digit of a letter = its place here; the first one is the padding
_DELETE, _INSERT, _KEEP, _REROLE = 1, 2, 3, 4
BITS = 3
BLOCK = 128

# states of the role pattern: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def inserts_pay(self) -> bool:
        return self.insert <= 2 * self.delete


def _following(state: int) -> tuple[int, str]:
    """The state after the turn that must come next, and its role."""
    return (ASSISTANT, "assistant") if state == USER else (USER, "user")


@lru_cache(maxsize=4096)
def edges(state: int, initial: str, fault: int, costs: Costs) -> tuple:
    """(letter, cost, state after, role or None for the turn's own, writes the turn)."""
    found = [(_DELETE, costs.delete, state, None, False)]
    if fault in (BLANK, DUPLICATE):
        return tuple(found)
    more = costs.truncated if fault == TRUNCATED else 0
    after, role = _following(state)
    if initial == "s" and state == START:
        found.append((_KEEP, costs.keep + more, SYSTEM, None, True))
    if initial == role[0]:
        found.append((_KEEP, costs.keep + more, after, None, True))
    found.append((_REROLE, costs.rerole + more, after, role, True))
    return tuple(found)


class Lattice:
    """The cheapest repairs of the turns read so far: for each node its number, the digest of
    the text written, and the letters of earlier blocks."""

    def __init__(self, costs: Costs = Costs()):
        self.costs, self.inserting = costs, costs.inserts_pay()
        self.width, self.read_in_block = BLOCK, 0
        self.nodes = {(START, 0): (0, hashlib.sha256(), None)}

    def _weight(self, cost: int, letter: int, place: int) -> int:
        # one digit more than the letters have: the rank of what came before the block
        return (cost << BITS * (self.width + 1)) + (letter << BITS * (self.width - 1 - place))

    @staticmethod
    def _written(digest, state: int, role: str, text: str):
        digest = digest.copy()
        digest.update(f"{'' if state == START else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        return digest

    def read(self, role: str, text: str, fault: int) -> None:
        if self.inserting:
            self._insert(2)
        elif self.read_in_block == BLOCK:
            self._end_block()
        best: dict = {}
        for (state, place), (number, digest, before) in self.nodes.items():
            for letter, cost, after, new_role, writes in edges(state, role[:1], fault, self.costs):
                key, sum_ = (after, place + 1), number + self._weight(cost, letter, place)
                if key not in best or sum_ < best[key][0]:
                    best[key] = (sum_, digest, before, state, new_role, writes)
        self.nodes = {
            key: (number, self._written(digest, state, new_role or role, text) if writes else digest, before)
            for key, (number, digest, before, state, new_role, writes) in best.items()
        }
        self.read_in_block += 1

    def _insert(self, times: int) -> None:
        """Up to `times` insertions before the next turn; room for their letters and the turn's."""
        longest = max(place for _, place in self.nodes) + times + 1
        if longest >= self.width:
            more = max(BLOCK, longest)
            self.nodes = {key: (number << BITS * more, *rest) for key, (number, *rest) in self.nodes.items()}
            self.width += more
        for _ in range(times):
            for (state, place), (number, digest, before) in list(self.nodes.items()):
                after, role = _following(state)
                key, sum_ = (after, place + 1), number + self._weight(self.costs.insert, _INSERT, place)
                if key not in self.nodes or sum_ < self.nodes[key][0]:
                    self.nodes[key] = (sum_, self._written(digest, state, role, ""), before)

    def _letters(self, number: int) -> str:
        digits = (number >> BITS * (self.width - 1 - i) & (1 << BITS) - 1 for i in range(self.width))
        return "".join(LETTERS[d] for d in digits if d)

    def _end_block(self) -> None:
        """Letters give way to their rank, and make room for those of the next block."""
        below = BITS * (self.width + 1)
        order = sorted(self.nodes, key=lambda key: self.nodes[key][0] & (1 << below) - 1)
        nodes = {}
        for rank, key in enumerate(order):
            number, digest, before = self.nodes[key]
            ranked = (number >> below << below) + (rank << BITS * self.width)
            nodes[(key[0], 0)] = (ranked, digest, (before, self._letters(number)))
        self.nodes, self.read_in_block = nodes, 0

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, sha256 of the repaired dialogue)"""
        if self.inserting:
            self._insert(2)
        number, digest, before = min((self.nodes[key] for key in self.nodes if key[0] in ACCEPTING), key=lambda node: node[0])
        parts = [self._letters(number)]
        while before:
            before, letters = before
            parts.append(letters)
        return number >> BITS * (self.width + 1), "".join(reversed(parts)), digest.hexdigest()


def fault_of(text: str, repeated: bool) -> int:
    shown = text.strip(_SPACES)
    if not shown:
        return BLANK
    if repeated:
        return DUPLICATE
    return FINE if shown[-1] in ".!?" else TRUNCATED


class _Conversation:
    def __init__(self, conv, costs: Costs):
        self.conv, self.lattice = conv, Lattice(costs)
        self.first = self.last = self.initial = None
        self.distinct = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def read(self, turn, role: str, text: str, repeated: bool) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.distinct += turn != self.last
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        fault = fault_of(text, repeated)
        self.faults[fault] += 1
        self.lattice.read(role, text, fault)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, *self.lattice.result())


AUDIT_COLUMNS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    space = F.lit(" ")
    return turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"), present.alias("present"),
    )


def audits(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: str | None = None, costs: Costs = Costs(),
) -> DataFrame:
    """One row per conversation: missing turn numbers, faults, illegal neighbours, and its cheapest
    repair as cost, audit and digest. `present` may name a boolean column: rows where it is not
    true are no turns, but their conversations are in the result."""
    small_batches(turns.sparkSession)
    there = F.lit(True) if present is None else F.coalesce(F.col(f"`{present}`"), F.lit(False))
    rows = _ordered(turns, conv, turn, role, text, there).repartition("conv")
    # the same shuffle serves both: duplicates are looked for within their conversation
    seen = Window.partitionBy("conv", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = rows.withColumn("repeated", F.row_number().over(seen) > 1)
    sorted_ = marked.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "repeated")
    kind = rows.schema["conv"].dataType.simpleString()

    def repaired(batches):
        conv_type, now, done = None, None, []
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for c, number, role, text, present, repeated in zip(*(column.to_pylist() for column in batch.columns)):
                if now is None or now.conv != c:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(c, costs)
                if present:
                    now.read(number, role, text, repeated)
            if len(done) >= 1000:
                yield _batch(done, conv_type)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield _batch(done, conv_type)

    return sorted_.mapInArrow(repaired, f"conv {kind}, {AUDIT_COLUMNS}").withColumnRenamed("conv", conv)


def _batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    types = [conv_type] + [pa.int64()] * 6 + [pa.string()] * 2
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def repaired_turns(
    turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns after repair: (conversation, place, edit, turn, role, text), `found` being what
    `audits` says of the same turns. Inserted turns have no number. The audit of a conversation is
    sorted before its turns and meets them in one task, where they pass as a stream."""
    small_batches(turns.sparkSession)
    rows = _ordered(turns, conv, turn, role, text, F.lit(True)).withColumn("audit", F.lit(None).cast("string"))
    heads = found.select(
        F.col(f"`{conv}`").alias("conv"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), F.lit(False).alias("present"), F.col("audit"),
    )
    both = rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "present", F.asc_nulls_first("turn"), "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()

    def edited(batches):
        letters, state, place, conv = _Ahead(iter("")), START, 0, None
        for batch in batches:
            out = []
            # a conversation may span batches: what is left of its audit goes on
            for c, number, role, text, present, audit in zip(*(column.to_pylist() for column in batch.columns)):
                if not present:
                    letters, conv = _Ahead(iter(audit)), c
                    state, place = _inserted(out, c, letters, START, 0)
                    continue
                edit = letters.take()
                if edit in "KR":
                    after, wanted = _following(state)
                    if edit == "K":
                        wanted, after = role, SYSTEM if state == START and role[:1] == "s" else after
                    out.append((conv, place, edit, number, wanted, text))
                    state, place = after, place + 1
                state, place = _inserted(out, conv, letters, state, place)
            if out:
                columns = list(zip(*out))
                types = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["conv", "place", "edit", "turn", "role", "text"])

    schema = f"conv {kind}, place bigint, edit string, turn bigint, role string, text string"
    return both.mapInArrow(edited, schema).withColumnRenamed("conv", conv)


class _Ahead:
    """Letters with a look at the next one."""

    def __init__(self, letters):
        self.letters = letters
        self.next = next(letters, "")

    def take(self) -> str:
        letter, self.next = self.next, next(self.letters, "")
        return letter


def _inserted(out: list, conv, letters: _Ahead, state: int, place: int) -> tuple[int, int]:
    """Write the insertions that come before the next turn."""
    while letters.next == "I":
        state, role = _following(state)
        out.append((conv, place, letters.take(), None, role, ""))
        place += 1
    return state, place
