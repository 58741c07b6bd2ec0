"""Repair of conversation structure at least cost, by Four-Russians block tables.

A repaired conversation is empty or an optional system row and then pairs of user and assistant rows: a deterministic automaton of four states.
Its rows are symbols of nine kinds, and the cost of the cheapest edits from some row to the end is a vector with an entry a state. Less its least entry,
only few such vectors occur. For each of them and each block of ``BLOCK`` symbols the vector before the block and what
the least entry gains are tabulated, so the costs of a conversation are one lookup a block, from its end to its start. Edits are then
read from the start: a block is expanded backward from the vector behind it, and of the cheapest edits the first by letter is taken,
which gives the least sequence of letters among all cheapest ones.

Spark orders the rows, marks duplicates and streams each conversation in order through a task twice: once as symbols, and once as texts next
to their edits. A task holds a byte a row for the conversation in work, never its texts; sorting and windows spill.
"""

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.arrays import pieces
from souk.session import materialize

#: Symbols of a block.
BLOCK = 3
# The costs of edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States: nothing yet, a system row, a user row waiting for its answer, an answer.
START, SYSTEM, ASKED, ANSWERED = range(4)
#: The role that is allowed in a state besides a system row at the start, and the state that it leads to.
EXPECTED = {START: ("user", ASKED), SYSTEM: ("user", ASKED), ASKED: ("assistant", ANSWERED), ANSWERED: ("user", ASKED)}
INITIALS = "sua"
#: A symbol is twice the role's place (one more if truncated), or DEAD for rows that must go.
DEAD = 8
FAR = 1 << 20

BLANK, REPEATED, CUT = 1, 2, 3  # faults of a row; 0 is none


def kept_state(state: int, role: int) -> int | None:
    """The state after a row that keeps its role; ``role`` 3 is any that conversations have not."""
    if role == 3:
        return None
    if role == 0:
        return SYSTEM if state == START else None
    expected, to = EXPECTED[state]
    return to if expected[0] == INITIALS[role] else None


def _edits(symbol: int, after: tuple[int, ...], state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost to the end, next state)`` of the edits of a row in a state, inserts left out; by letter."""
    found = [("D", DELETE + after[state], state)]
    if symbol != DEAD:
        extra = TRUNCATED * (symbol % 2)
        to = kept_state(state, symbol // 2)
        if to is not None:
            found.append(("K", extra + after[to], to))
        to = EXPECTED[state][1]
        found.append(("R", REROLE + extra + after[to], to))
    return found


def before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs to the end in front of a row, given those behind it."""
    plain = [min(cost for _, cost, _ in _edits(symbol, after, state)) for state in range(4)]
    asked = min(plain[ASKED], INSERT + plain[ANSWERED])
    answered = min(plain[ANSWERED], INSERT + plain[ASKED])
    return min(plain[START], INSERT + asked), min(plain[SYSTEM], INSERT + asked), asked, answered


@dataclass(frozen=True)
class Tables:
    """Normalised vectors by number; the vector before each symbol or block, and what is added to the least entry."""

    vectors: list[tuple[int, ...]]
    one: list[list[int]]
    one_added: list[list[int]]
    block: list[list[int]]
    block_added: list[list[int]]
    last: int
    last_least: int


@functools.cache
def tables() -> Tables:
    """All vectors that can stand behind a row, and every block before them: some thousand entries a vector."""

    def normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        least = min(vector)
        return tuple(v - least for v in vector), least

    # behind the last row: nothing or an answer may end a conversation, else rows are inserted
    end, least = normal((0, 2 * INSERT, INSERT, 0))
    vectors, number = [end], {end: 0}
    one: list[list[int]] = []
    one_added: list[list[int]] = []
    for vector in vectors:  # grows
        steps = [normal(before(symbol, vector)) for symbol in range(DEAD + 1)]
        for found, _ in steps:
            if found not in number:
                number[found] = len(vectors)
                vectors.append(found)
        one.append([number[found] for found, _ in steps])
        one_added.append([added for _, added in steps])
    block, block_added = [], []
    for start in range(len(vectors)):
        to, added = [], []
        for symbols in product(range(DEAD + 1), repeat=BLOCK):
            at, cost = start, 0
            for symbol in reversed(symbols):
                cost += one_added[at][symbol]
                at = one[at][symbol]
            to.append(at)
            added.append(cost)
        block.append(to)
        block_added.append(added)
    return Tables(vectors, one, one_added, block, block_added, 0, least)


def cheapest(symbols: bytes) -> tuple[int, str]:
    """The least cost of a conversation's repair and the letters of its edits, least in ASCII of all cheapest ones."""
    t, n = tables(), len(symbols)
    whole = n - n % BLOCK
    codes = np.frombuffer(symbols[:whole], np.uint8).reshape(-1, BLOCK).astype(np.int64) @ (DEAD + 1) ** np.arange(BLOCK - 1, -1, -1)
    at, cost = t.last, t.last_least
    for symbol in reversed(symbols[whole:]):
        cost += t.one_added[at][symbol]
        at = t.one[at][symbol]
    behind = bytearray() if len(t.vectors) < 256 else []
    for code in reversed(codes.tolist()):
        behind.append(at)  # the vector behind the block
        cost += t.block_added[at][code]
        at = t.block[at][code]
    cost += t.vectors[at][START]
    letters, state = [], START
    for first in range(0, n, BLOCK):
        some = symbols[first : first + BLOCK]
        number = behind[len(behind) - 1 - first // BLOCK] if first < whole else t.last
        vectors = [number]
        for symbol in reversed(some):
            vectors.append(t.one[vectors[-1]][symbol])
        for k, symbol in enumerate(some):
            after = vectors[len(some) - 1 - k]
            state = _row(letters, symbol, after, state)
    letters.append(_tail(state))
    return cost, "".join(letters)


@functools.cache
def _choice(symbol: int, after: int, state: int) -> tuple[str, int]:
    """The letters of the edits from a state over one row, and the state after it."""
    vector = tables().vectors[after]
    costs = before(symbol, vector)
    letters = ""
    while True:
        options = _edits(symbol, vector, state)
        to = EXPECTED[state][1]
        options.append(("I", INSERT + costs[to], None))
        letter, _, following = min((o for o in options if o[1] == costs[state]), key=lambda o: o[0])
        letters += letter
        if letter != "I":
            return letters, following
        state = to


def _row(letters: list[str], symbol: int, after: int, state: int) -> int:
    text, state = _choice(symbol, after, state)
    letters.append(text)
    return state


def _tail(state: int) -> str:
    return {START: "", SYSTEM: "II", ASKED: "I", ANSWERED: ""}[state]


def _faults(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, digest, live, initial, fault)`` of every row, each conversation in one task."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    marked = rows.select(
        "conv", "turn", "role", "digest", "live", F.substring("role", 1, 1).alias("initial"),
        F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(0).cast("byte").alias("own"),
    )
    # all windows and sorts below use this one shuffle
    placed = marked.repartition("conv")
    same = Window.partitionBy("conv", "live", "role", "digest").orderBy("turn")
    again = (F.row_number().over(same) > 1) & (F.col("own") != BLANK)
    return placed.select("conv", "turn", "role", "digest", "live", "initial", F.when(again, REPEATED).otherwise(F.col("own")).cast("byte").alias("fault"))


IN_ORDER = ("turn", "role", "digest")
MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {', '.join(f'{m} long' for m in MEASURES)}, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: _Conversation | None = None
        out_schema: pa.Schema | None = None
        for batch in batches:
            out_schema = out_schema or _arrow(batch.schema.field(0).type)
            columns = [c.to_pylist() for c in batch.columns]
            for conv, turn, live, initial, fault in zip(*columns, strict=True):
                if state is None or state.conv != conv:
                    if state is not None:
                        done.append(state.result())
                    state = _Conversation(conv)
                if live:
                    state.add(turn, initial, fault)
            if len(done) >= 1024:
                yield _batch(done, out_schema)
                done = []
        if state is not None:
            yield _batch([*done, state.result()], out_schema)

    ordered = _faults(rows).sortWithinPartitions("conv", *IN_ORDER).select("conv", "turn", "live", "initial", "fault")
    return ordered.mapInArrow(run, schema)


def _arrow(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", kind), *((m, pa.int64()) for m in MEASURES), ("audit", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv: object):
        self.conv = conv
        self.low: int | None = None
        self.turn: int | None = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]
        self.initial: str | None = None
        self.symbols = bytearray()

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.turn = turn
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        role = INITIALS.find(initial) if initial else -1
        self.symbols.append(DEAD if fault in (BLANK, REPEATED) else 2 * (3 if role < 0 else role) + (fault == CUT))

    def result(self) -> tuple:
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        cost, audit = cheapest(bytes(self.symbols))
        return (self.conv, gaps, self.faults[BLANK], self.faults[REPEATED], self.faults[CUT], self.illegal, cost, audit)


class _Text:
    """The digest of a repaired conversation while its texts pass by."""

    def __init__(self, row: tuple):
        self.row, self.audit = row, row[-1]
        self.at, self.state, self.rows = 0, START, 0
        self.digest = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1

    def _expected(self) -> str:
        role, self.state = EXPECTED[self.state]
        return role

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self._expected(), "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = kept_state(self.state, INITIALS.find(role[:1]))
            self._line(role, text)
        elif letter == "R":
            self._line(self._expected(), text)

    def result(self) -> tuple:
        self.inserts()
        return (*self.row, self.digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``(conv, turn, role, text, live)``: its faults, the cheapest edits and a digest of the repaired text.

    Rows are ordered by turn, nulls first, then by role and a digest of the text, so the result does not depend on how they are
    stored. Nulls of role and text are one blank. Rows that are not ``live`` do not count but their
    conversation has a row: without live ones zeros, no edits and the digest of nothing. A null ``conv`` is a conversation too. Empty tables give no rows.
    """
    texts = rows.select(
        "conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "live"
    ).withColumn("digest", F.unhex(F.md5("text")))
    found = materialize(audits(texts), "conversation-edits")
    # the edits of a conversation come before its rows in the same task
    results = [F.lit(None).cast(t).alias(c) for c, t in found.dtypes if c != "conv"]
    shown = texts.where("live").select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", *results)
    empty = [F.lit(None).cast(t).alias(c) for c, t in shown.dtypes[2:6]]
    heads = found.select("conv", F.lit(0).alias("kind"), *empty, *MEASURES, "audit")
    ordered = heads.unionByName(shown).repartition("conv").sortWithinPartitions("conv", "kind", *IN_ORDER)
    stream = ordered.select("conv", "kind", "role", "text", *MEASURES, "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: _Text | None = None
        schema: pa.Schema | None = None
        for batch in pieces(batches, 4096):
            schema = schema or _arrow(batch.schema.field(0).type).append(pa.field("repaired_sha256", pa.string()))
            conv, kind, role, text, *more = (c.to_pylist() for c in batch.columns)
            for k, head in enumerate(kind):
                if head == 0:
                    if state is not None:
                        done.append(state.result())
                    state = _Text((conv[k], *(m[k] for m in more)))
                else:
                    state.add(role[k], text[k])
            if len(done) >= 1024:
                yield _batch(done, schema)
                done = []
        if state is not None:
            yield _batch([*done, state.result()], schema)

    kinds = ", ".join(f"{c} {t}" for c, t in found.dtypes)
    return stream.mapInArrow(run, f"{kinds}, repaired_sha256 string")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows for :func:`repair` with faults put in after a checksum of conversation and turn: of twenty parts one is dropped, one
    emptied, one loses its end marks, one is repeated and one gets the role of a user. Nulls are one blank for it."""
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col(conv_col).cast("string"), blank), F.coalesce(F.col(turn_col).cast("string"), blank))
    part: Column = F.col("part")
    told = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"), (F.crc32(name) % 20).alias("part"),
    )
    return told.select(
        "conv", "turn",
        F.when(part == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(part == 1, "").when(part == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (part != 0).alias("live"),
        F.explode(F.when(part == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
