"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import conversations
from tripmart.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def search(codes: bytes) -> tuple[int, str]:
    """Least (cost, letters) over every series of edits, with one inserted message at most a gap."""
    best = None
    choices = []
    for code in codes:
        what, own = code >> 2, ".sua"[code & 3]
        late = 5 if what == 2 else 0
        options = [("D", "", 2)]
        if what != 1:
            options += [("K", own, late), ("R", "u", 1 + late), ("R", "a", 1 + late)]
        choices.append([("", "", 0), ("I", "u", 5), ("I", "a", 5)])
        choices.append(options)
    choices.append([("", "", 0), ("I", "u", 5), ("I", "a", 5)])
    for series in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(initial for _, initial, _ in series)):
            found = (sum(cost for *_, cost in series), "".join(letter for letter, *_ in series))
            best = found if best is None else min(best, found)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 5, 6, 7, 9, 10, 11, 2, 3]), max_size=4), st.integers(1, 5))
def test_cheapest_of_all_edits(codes, piece):
    assert conversations.cheapest(bytes(codes), piece) == search(bytes(codes))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 2, 3, 2, 3, 6, 10, 11]), max_size=40), st.integers(1, 9))
def test_pieces_change_nothing(codes, piece):
    assert conversations.cheapest(bytes(codes), piece) == conversations.cheapest(bytes(codes), 100)


def plain(rows: list[tuple]) -> dict:
    """The contract, row by row."""

    def value(field):
        return " " if field is None else str(field)

    found = {}
    for conv_id in {row[0] for row in rows}:
        messages = []
        for _, turn, role, text in (row for row in rows if row[0] == conv_id):
            kind = zlib.crc32(f"{value(conv_id)}:{value(turn)}".encode()) % 20
            role, text = value(role), value(text)
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            message = (turn, "user" if kind == 4 else role, text)
            messages += [message] * (2 if kind == 3 else 1)
        messages.sort(
            key=lambda m: (
                m[0] is not None,
                m[0] or 0,
                m[1].encode(),
                m[2][:256].encode(),
                hashlib.sha256(f"{m[1]}\0{m[2]}".encode()).digest(),
            )
        )
        codes, faults, seen = [], {"blank": 0, "duplicate": 0, "truncated": 0}, set()
        for _, role, text in messages:
            body, what = text.strip(WHITE), 0
            if not body:
                what, faults["blank"] = 1, faults["blank"] + 1
            elif (role, text) in seen:
                what, faults["duplicate"] = 1, faults["duplicate"] + 1
            elif body[-1] not in ".!?":
                what, faults["truncated"] = 2, faults["truncated"] + 1
            seen.add((role, text))
            codes.append(4 * what + max(".sua".find(role[:1] or "."), 0))
        cost, audit = conversations.cheapest(bytes(codes))
        turns = {m[0] for m in messages if m[0] is not None}
        kept, state = [], ""
        for letter, (_, role, text) in zip(audit, messages, strict=True):
            if letter == "R":
                role = "assistant" if state.endswith("u") else "user"
            if letter != "D":
                state += role[0]
                kept.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", state)
        pairs = itertools.pairwise(m[1][:1] for m in messages)
        found[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *faults.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return found


def found_by(spark, rows, schema=SCHEMA):
    table = conversations.repaired(spark.createDataFrame(rows, schema))
    result = table.collect()
    assert len({row.conv_id for row in result}) == len(result)
    return {row.conv_id: tuple(row)[1:] for row in result}


def test_query_against_plain_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    result = QUERIES["op11_conversation_repair"](spark, folder).collect()
    assert {row.conv_id: tuple(row)[1:] for row in result} == plain(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    long_text = "word " * 400_000 + "end."
    rows = [
        (1, None, None, None), (1, None, "user", "no turn."), (1, 3, "user", "same?"),
        (1, 3, "user", "same?"), (1, 3, "assistant", "tie."), (1, 9, "", "no role."),
        (1, 10, "Tool", "other."), (2, 0, "user", long_text), (2, 1, "assistant", long_text),
        (None, 1, "user", "null conversation."), (None, None, None, ""), (None, 2, "assistant", "é　"),
        *[(3, 5, "user", "again.")] * 40, (4, 0, "system", "\t\n"), (5, 1, "user", "cut"),
    ]
    assert found_by(spark, rows) == plain(rows)


def test_all_dropped_and_empty(spark):
    gone = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    none = hashlib.sha256(b"").hexdigest()
    assert found_by(spark, [(*gone, "user", "x.")]) == {gone[0]: (0, 0, 0, 0, 0, 0, "", none)}
    assert found_by(spark, []) == {}


def test_clashing_and_extra_columns(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}.", 7, "x") for t in range(6)]
    schema = f"{SCHEMA}, digest int, is_message string"
    assert found_by(spark, rows, schema) == plain([row[:4] for row in rows])


@pytest.mark.parametrize("size", [3000])
def test_long_conversation(spark, size):
    rows = [(8, t, "user" if t % 3 else "assistant", f"t{t % 1000}{'.' if t % 7 else ''}") for t in range(size)]
    assert found_by(spark, rows) == plain(rows)
