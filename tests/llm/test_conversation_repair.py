"""Conversation repair: the parse against all edits, faults and digests against a reading in plain Python."""

import hashlib
import itertools
import random
import re

import pytest

from roadledger.llm.conversation_repair import damaged, judged, repair_conversations, repaired_digests, structure_reports
from roadledger.llm.role_grammar import Repair, advance, repaired_roles

WHOLE = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows, inserts=3):
    """The least (cost, audit) of all edits of (initial, must_delete, truncated) rows."""
    best = (3 * len(rows), "D" * len(rows))

    def go(place, out, cost, audit, left):
        nonlocal best
        if cost > best[0]:
            return
        if place == len(rows):
            if WHOLE.match(out):
                best = min(best, (cost, audit))
        if left:
            for role in "ua":
                go(place, out + role, cost + 2, audit + "I", left - 1)
        if place < len(rows):
            initial, must, cut = rows[place]
            go(place + 1, out, cost + 3, audit + "D", inserts)
            if not must:
                go(place + 1, out + (initial or "?"), cost + cut, audit + "K", inserts)
                for role in "ua":
                    go(place + 1, out + role, cost + 2 + cut, audit + "R", inserts)

    go(0, "", 0, "", inserts)
    return best


def parsed(rows):
    repair = Repair()
    for row in rows:
        repair.row(*row)
    return repair.result()


def test_parse_finds_the_least_audit():
    pick = random.Random(3)
    for length in range(4):
        for initials in itertools.product("suax", repeat=length):
            rows = [(c, pick.random() < 0.15, pick.random() < 0.3) for c in initials]
            assert parsed(rows) == cheapest(rows)
    for _ in range(15):
        rows = [(pick.choice("suauax"), pick.random() < 0.15, pick.random() < 0.3) for _ in range(pick.randrange(4, 6))]
        assert parsed(rows) == cheapest(rows, 2)


def test_long_sequences_meet_few_configurations():
    pick = random.Random(4)
    before = advance.cache_info().currsize
    rows = [(pick.choice("suauauaux "), pick.random() < 0.1, pick.random() < 0.2) for _ in range(50_000)]
    cost, audit = parsed(rows)
    assert advance.cache_info().currsize - before < 2000
    roles = {"s": "system", "u": "user", "a": "assistant"}
    out = repaired_roles(audit, [roles.get(r[0], r[0]) for r in rows])
    assert WHOLE.match("".join(role[0] for _, role, _ in out))
    assert cost == sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + sum(rows[place][2] for _, _, place in out if place is not None)


def by_hand(rows):
    """Reports and digests of (conv, turn, role, text) rows."""
    out = {}
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = sorted([r[1:] for r in rows if r[0] == conv], key=lambda r: (
            r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in mine:
            ended = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            faults.append("blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = parsed([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(mine, faults)])
        turns = {r[0] for r in mine} - {None}
        lines = [f"{role}:{mine[place][2] if place is not None else ''}" for _, role, place in repaired_roles(audit, [r[1] for r in mine])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None)
    return out


def awkward_turns():
    pick = random.Random(9)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 5, "assistant", "Yes! \n"), (1, 5, "tool", "x?"),
            (None, 1, "user", "a."), (None, None, "system", ""), (2, 1, "", "."), (3, 3, "user", " \t\n"), (4, -2, "assistant", "no end"),
            (5, 1, "user", "é" * 20000 + "!"), (5, 2, "assistant", "fin "), (5, 2, "assistant", "fin ")]
    for conv in range(10, 60):
        for turn in range(pick.randrange(1, 14)):
            role = pick.choice(["user", "assistant", "system", "user", "assistant", "tool", None])
            rows.append((conv, pick.choice([turn, turn, None]), role, pick.choice(["Yes.", "No", "", None, f"{turn}!", "a: b?\nuser: c."])))
    return rows


def test_reports_and_digests(spark):
    rows = awkward_turns()
    turns = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, same string, copy int")
    repaired, reports = repair_conversations(turns.repartition(3))
    digests = {r.conv: r.digest for r in repaired_digests(repaired).collect()}
    found = {r.conv: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")], digests.get(r.conv))
             for r in reports.collect()}
    assert found == by_hand(rows)
    whole = {}
    for r in sorted(repaired.collect(), key=lambda r: r.place):
        whole[r.conv] = whole.get(r.conv, "") + r.role[0]
    assert all(WHOLE.match(text) for text in whole.values())


def test_empty_and_damage(spark):
    layout = "conv_id bigint, turn bigint, role string, text string"
    repaired, reports = repair_conversations(spark.createDataFrame([], layout))
    assert repaired.count() == 0 and reports.count() == 0
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    out = damaged(spark.createDataFrame(rows, layout)).collect()
    import zlib
    expected = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        expected += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("size", [1, 7])
def test_rows_of_one_conversation_may_span_batches(spark, size):
    rows = awkward_turns()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        reports = structure_reports(judged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
        assert {r.conv: r.audit for r in reports.collect()} == {conv: row[6] for conv, row in by_hand(rows).items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
