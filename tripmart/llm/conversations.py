"""Repair of a conversation's structure at least cost.

Messages may be kept (0), given the role of user or assistant (1), deleted (2; the only
choice for blank and repeated ones), and empty messages inserted (5); a truncated message
that stays costs 5 more.  What is left must read ``(s?(ua)+)?`` in initials of roles.  An
edit is a letter (D, I, K, R), and of the cheapest edits the least string of letters counts.

Method: weights are single integers.  Their high digits are the cost; below these lie digits
of a fixed width, one for each place of the audit, zero where the audit has ended.  To put an
edit in front adds its cost and its digit at the first place and moves the others one place
on, which keeps their order, so the least integer over a directed graph of (message, state)
decides cost and letters at once, from the last message to the first.  A conversation is
taken in pieces of ``PIECE`` messages: the values at a piece's end are the costs of what
follows and, as one more digit, the rank of its letters.  Ranks suffice, as no cheapest
repair inserts (an inserted message and its partner can go instead: 2 for 5), so that equal
costs have audits of equal length.

Three jobs in one plan: repeats are counted and joined (no set of seen texts); messages
without their texts come to one task for each conversation, in order, which holds about three
bytes a message; letters and messages with texts come in order to the task that hashes them
as they pass.  SHA-256 runs through a conversation from start to end, so this one step cannot
be divided; it holds one batch of rows at a time.

Defined cases: a null conversation, turn, role or text counts as one space in the damage key
and as role and text; null conversations are one conversation; messages of one turn go by
role, then the first 256 characters of the text, then its digest; an empty role, or one that
begins with no s, u or a, cannot be kept; equal rows are copies of each other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

# ---- fixed values of the task -------------------------------------------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
DROP, EMPTY, STRIP, REPEAT, AS_USER = 0, 1, 2, 3, 4
DAMAGE_CLASSES = 20
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL_PAIRS = {"su", "ua", "au"}
#: state -> initial -> next state, and the states in which a conversation may end
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
# -------------------------------------------------------------------------------------
#: Digits of the letters, in their order; zero is the padding.
LETTERS = ".DIKR"
DIGIT_BITS = 3
PIECE = 512
INITIALS = ".sua"
#: What a message is, besides its initial: nothing, one that must go, a truncated one.
SOUND, MUST_GO, CUT = 0, 1, 2
TURN_ORDER = ["turn", "role", "head", "digest"]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage; ``dropped`` rows keep only their conversation."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % DAMAGE_CLASSES
    text = (
        F.when(kind == EMPTY, "")
        .when(kind == STRIP, F.translate(text_of("text"), ENDS, ""))
        .when(kind != DROP, text_of("text"))
    )
    times = F.when(kind == REPEAT, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == AS_USER, "user").otherwise(text_of("role")).alias("role"),
        text.alias("text"),
        (kind == DROP).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def _described(rows: DataFrame) -> DataFrame:
    """The order of messages, and what their texts tell."""
    body = F.rtrim("text", F.lit(WHITE))
    return rows.select(
        "*",
        F.substring("text", 1, 256).alias("head"),
        F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256)).alias("digest"),
        (body == "").alias("is_blank"),
        (~F.substring(body, -1, 1).isin(*ENDS)).alias("is_cut"),
    )


def _light(described: DataFrame) -> DataFrame:
    """Messages without texts, with the turn in which their like first appeared if there are several."""
    light = described.drop("text")
    first = (
        light.filter(~F.col("dropped") & ~F.col("is_blank"))
        .groupBy("conv_id", "digest")
        .agg(
            F.count("*").alias("times"),
            F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"),
        )
        .filter("times > 1")
        .select(F.col("conv_id").alias("of"), F.col("digest").alias("like"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("like"))
    return light.join(first, same, "left").select(
        "conv_id",
        "dropped",
        *TURN_ORDER,
        "is_blank",
        "is_cut",
        (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("is_later"),
        F.col("first").isNotNull().alias("is_repeated"),
    )


def _weights(codes: bytes, ends: list[int | None]) -> tuple[list[int | None], int]:
    """Least weight of the piece from each state, and the weight's digits.

    ``ends``: for each state at the piece's end what follows, as (cost, rank) in one
    integer with the rank as its last digit; None where nothing can follow.
    """
    width = len(codes) + (2 * len(codes) + 15) // 5 + 5
    below = DIGIT_BITS * width
    top = below - DIGIT_BITS
    mask = (1 << below) - 1

    def put(cost: int, letter: int, weight: int) -> int:
        high, low = weight >> below, weight & mask
        return (high + cost) << below | letter << top | low >> DIGIT_BITS

    def insert(values: list[int | None]) -> list[int | None]:
        # Two rounds reach every state: no three inserted messages in a row are cheapest.
        for _ in range(2):
            for state, steps in enumerate(STEPS):
                for initial, to in steps.items():
                    if initial != "s" and values[to] is not None:
                        weight = put(INSERT, 2, values[to])
                        if values[state] is None or weight < values[state]:
                            values[state] = weight
        return values

    digit = (1 << DIGIT_BITS) - 1
    values = insert(
        [None if end is None else (end >> DIGIT_BITS) << below | (end & digit) << top for end in ends]
    )
    for code in reversed(codes):
        what, own = code >> 2, INITIALS[code & 3]
        extra = TRUNCATED if what == CUT else 0
        before: list[int | None] = []
        for state, steps in enumerate(STEPS):
            found = [] if values[state] is None else [put(DELETE, 1, values[state])]
            if what != MUST_GO:
                for initial, to in steps.items():
                    if values[to] is None:
                        continue
                    if initial == own:
                        found.append(put(KEEP + extra, 3, values[to]))
                    if initial != "s":
                        found.append(put(REROLE + extra, 4, values[to]))
            before.append(min(found, default=None))
        values = insert(before)
    return values, width


def _step(state: int, letter: str, initial: str) -> int:
    """The state after an edit; a state allows one role besides a kept one."""
    if letter == "D":
        return state
    if letter == "K":
        return STEPS[state][initial]
    return next(to for own, to in STEPS[state].items() if own != "s")


def cheapest(codes: bytes, piece: int = PIECE) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of a conversation.

    codes: a byte for each message, its initial's place in ``INITIALS`` plus four times
    ``SOUND``, ``MUST_GO`` or ``CUT``.
    """
    ends: list[int | None] = [0 if state in FINAL else None for state in range(len(STEPS))]
    solved = []
    starts = range(0, max(len(codes), 1), piece)
    for start in reversed(starts):
        values, width = _weights(codes[start : start + piece], ends)
        solved.append((start, values, width))
        mask = (1 << DIGIT_BITS * width) - 1
        ranks = sorted({value & mask for value in values if value is not None})
        ends = [
            None
            if value is None
            else (value >> DIGIT_BITS * width) << DIGIT_BITS | ranks.index(value & mask) + 1
            for value in values
        ]
    cost = ends[0] >> DIGIT_BITS
    letters, state = [], 0
    for start, values, width in reversed(solved):
        left, row = values[state] & ((1 << DIGIT_BITS * width) - 1), start
        last = start == starts[-1]
        place = DIGIT_BITS * (width - 1)
        stop = min(start + piece, len(codes))
        while True:
            letter = LETTERS[left >> place & ((1 << DIGIT_BITS) - 1)]
            if row == stop and (letter != "I" or not last):
                break
            place -= DIGIT_BITS
            letters.append(letter)
            state = _step(state, letter, INITIALS[codes[row] & 3] if letter == "K" else "")
            row += letter != "I"
    return cost, "".join(letters)


class _Conversation:
    """What is counted while a conversation's messages pass in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = self.initial = None

    def add(self, turn, role, digest, blank, cut, later, repeated) -> None:
        again = repeated and (later or self.before == (turn, digest))
        self.before = (turn, digest)
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        what = SOUND
        if blank:
            self.blank, what = self.blank + 1, MUST_GO
        elif again:
            self.duplicate, what = self.duplicate + 1, MUST_GO
        elif cut:
            self.truncated, what = self.truncated + 1, CUT
        self.codes.append(4 * what + max(INITIALS.find(initial or "."), 0))

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = cheapest(bytes(self.codes))
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (self.conv_id, gaps, *counts, cost, audit)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)],
        schema=schema,
    )


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            columns = batch.slice(start, 256).to_pydict().values()
            yield from zip(*columns, strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == limit:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _decider(schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for conv_id, dropped, turn, role, _, digest, blank, cut, later, repeated in _tuples(batches):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.row()
                now = _Conversation(conv_id)
            if not dropped:
                now.add(turn, role, digest, blank, cut, later, repeated)
        if now is not None:
            yield now.row()

    return lambda batches: _batched(rows(batches), schema)


class _Repaired:
    """The hash of a repaired conversation, fed message by message."""

    def __init__(self, counts: tuple):
        self.counts, self.letters = counts, counts[-1]
        self.place = self.state = 0
        self.any, self.hash = False, hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "replace"))
        self.any = True

    def _insertions(self) -> None:
        while self.letters[self.place : self.place + 1] == "I":
            self._reroled("")
            self.place += 1

    def _reroled(self, text: str) -> None:
        initial, self.state = next(
            (own, to) for own, to in STEPS[self.state].items() if own != "s"
        )
        self._write(ROLES[initial], text)

    def add(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.letters[self.place]
        self.place += 1
        if letter == "K":
            self.state = STEPS[self.state][role[0]]
            self._write(role, text)
        elif letter == "R":
            self._reroled(text)

    def row(self) -> tuple:
        self._insertions()
        return (*self.counts, self.hash.hexdigest())


def _hasher(schema: pa.Schema, n_counts: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for is_message, role, text, *counts in _tuples(batches):
            if is_message:
                now.add(role, text)
                continue
            if now is not None:
                yield now.row()
            now = _Repaired(tuple(counts[:n_counts]))
        if now is not None:
            yield now.row()

    return lambda batches: _batched(rows(batches), schema)


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    turns = [F.col(name).asc_nulls_first() for name in TURN_ORDER]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, *turns)


def repaired(conversations: DataFrame) -> DataFrame:
    """Per conversation: faults after damage, cost and letters of its repair, the repair's hash."""
    described = _described(damaged(conversations))
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    counted = (
        f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long,"
        " illegal long, cost long, audit string"
    )
    light = _in_order(_light(described))
    empty = conversations.sparkSession.createDataFrame([], counted)
    decided = light.mapInArrow(_decider(to_arrow_schema(empty.schema)), counted)
    kept = described.filter(~F.col("dropped")).select("conv_id", *TURN_ORDER, "text")
    both = decided.withColumn("is_message", F.lit(False)).unionByName(
        kept.withColumn("is_message", F.lit(True)), allowMissingColumns=True
    )
    ordered = _in_order(both, "is_message").select("is_message", "role", "text", *empty.columns)
    result = f"{counted}, repaired_sha256 string"
    full = conversations.sparkSession.createDataFrame([], result)
    return ordered.mapInArrow(_hasher(to_arrow_schema(full.schema), len(empty.columns)), result)
