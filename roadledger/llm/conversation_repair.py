"""Conversation structure repair: faults by grouping, then a generalised LR parse with weighted edits over sorted rows.

Rows of a conversation are taken by turn (nulls first); rows that share a turn by role, then by the SHA-256 of role and
text. A row's first fault counts: blank, duplicate (its role and text were there before), truncated (no end mark).
Repeats are found by counts that are combined before their shuffle; of equal rows one number is kept and written out
again. The parse reads narrow rows (no texts) that are sorted by conversation and streams them through the repair of
``role_grammar``: what it holds is the live stacks and their audits, one letter a row. A second stream sends the audit
ahead of the conversation's rows and writes the repaired rows. A conversation of any length is read in order by one
task, which its audit demands, but never held there.

Defined results: null role and text are one space; a null conversation id is one conversation; a null turn comes first
and does not count for gaps; a role is judged by its first character, and kept rows keep their whole role; an empty
role has no initial and fits nowhere; a reroled or inserted row is ``user`` or ``assistant``, whichever the grammar
wants next; an inserted row has an empty text; an empty table gives no rows; other columns are neither read nor
returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadledger.llm.common import settings
from roadledger.llm.role_grammar import DELETE, INSERT, KEEP, Repair, following
from roadledger.session import written

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACE = r"\x20\x09-\x0D"
#: Neighbouring initials that may stand next to each other.
PAIRS = {"su", "ua", "au"}
ORDER = ["conv", "turn", "role", "same", "copy"]
#: Rows with texts sent to Python at a time.
TEXT_ROWS = 1000
_REPORT = ("conv bigint, rows bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string")
_REPAIRED = "conv bigint, place bigint, turn bigint, edit string, role string, text string"


def judged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, same, copy, fault), written; equal rows are told apart by ``copy``."""
    def plain(name: str) -> Column:
        return F.coalesce(turns[name].cast("string"), F.lit(" "))

    rows = turns.select(turns[conv_col].cast("bigint").alias("conv"), turns[turn_col].cast("bigint").alias("turn"),
                        plain(role_col).alias("role"), plain(text_col).alias("text"))
    same = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same")
    # What a key has is stored before it is joined back: only then can AQE split a key with very many rows.
    held = written(rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies")).select("*", same), "turns")
    first = written(held.groupBy("conv", "same").agg(F.min(F.struct("turn")).alias("first")), "first-turns")
    here, there = held.alias("h"), first.alias("f")
    met = here.join(there, F.col("h.conv").eqNullSafe(F.col("f.conv")) & (F.col("h.same") == F.col("f.same"))).select(
        "h.*", F.col("h.turn").eqNullSafe(F.col("f.first.turn")).alias("is_first"))
    spread = met.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    return written(spread.select(
        "conv", "turn", "role", "text", "same", "copy",
        F.when(~F.regexp_like("text", F.lit(f"[^{SPACE}]")), BLANK)
        .when(~F.col("is_first") | (F.col("copy") > 1), DUPLICATE)
        .when(~F.regexp_like("text", F.lit(rf"[.!?][{SPACE}]*+\z")), TRUNCATED).otherwise(SOUND).alias("fault")), "judged")


class _Conversation:
    """What is counted on the way through one conversation."""

    def __init__(self) -> None:
        self.repair, self.rows, self.faults, self.illegal = Repair(), 0, [0, 0, 0, 0], 0
        self.low = self.last_turn = None
        self.turns, self.before = 0, None

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.last_turn, self.turns = turn, self.turns + 1
        self.illegal += self.before is not None and self.before + initial not in PAIRS
        self.before = initial
        self.rows += 1
        self.faults[fault] += 1
        self.repair.row(initial, fault in (BLANK, DUPLICATE), fault == TRUNCATED)

    def report(self, conv: int | None) -> tuple:
        gaps = 0 if self.low is None else self.last_turn - self.low + 1 - self.turns
        return (conv, self.rows, gaps, *self.faults[BLANK:], self.illegal, *self.repair.result())


def _table(rows: list[tuple], layout: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in layout.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
                                      names=[name for name, _ in fields])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition."""
    conv, at = None, None
    for batch in batches:
        out = []
        for key, turn, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault")]):
            if at is None or key != conv:
                if at is not None:
                    out.append(at.report(conv))
                conv, at = key, _Conversation()
            at.row(turn, initial, fault)
        yield _table(out, _REPORT)
    if at is not None:
        yield _table([at.report(conv)], _REPORT)


def structure_reports(rows: DataFrame) -> DataFrame:
    """Faults, illegal neighbours, cost and audit of every conversation of ``judged`` rows; written."""
    narrow = rows.select("conv", "turn", "role", "same", "copy", F.substring("role", 1, 1).alias("initial"), "fault")
    placed = narrow.repartition("conv").sortWithinPartitions(*ORDER)
    return written(placed.select("conv", "turn", "initial", "fault").mapInArrow(_reports, _REPORT), "reports")


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of a sorted partition in which a conversation's audit comes before its rows."""
    audit, at, place, before = "", 0, 0, ""
    conv, out = None, []

    def written_row(edit: str, turn: int | None, role: str, text: str) -> None:
        nonlocal place, before
        role = role if edit == KEEP else following(before)
        out.append((conv, place, turn, edit, role, text))
        place, before = place + 1, role[:1]

    def inserts() -> None:
        nonlocal at
        while audit[at:at + 1] == INSERT:
            written_row(INSERT, None, "", "")
            at += 1

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "audit")]
        for key, turn, role, text, given in zip(*columns):
            if given is not None:
                conv, audit, at, place, before = key, given, 0, 0, ""
                inserts()  # those before the first row
                continue
            if audit[at] != DELETE:
                written_row(audit[at], turn, role, text)
            at += 1
            inserts()
        yield _table(out, _REPAIRED)
        out.clear()


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Repaired rows (conv, place from 0, turn, edit, role, text), each conversation in order within one partition."""
    ahead = reports.select("conv", F.lit(0).alias("late"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                           F.lit("").alias("text"), F.lit("").alias("same"), F.lit(0).cast("bigint").alias("copy"), "audit")
    texts = rows.select("conv", F.lit(1).alias("late"), "turn", "role", "text", "same", "copy",
                        F.lit(None).cast("string").alias("audit"))
    placed = ahead.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "late", *ORDER[1:])
    return placed.select("conv", "turn", "role", "text", "audit").mapInArrow(_rewritten, _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest = None, None
    for batch in batches:
        out = []
        for key, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "place", "role", "text")]):
            if place == 0:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = key, hashlib.sha256()
            digest.update(("\n" * (place > 0) + f"{role}:{text}").encode())
        yield _table(out, "conv bigint, digest string")
    if digest is not None:
        yield _table([(conv, digest.hexdigest())], "conv bigint, digest string")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv, digest of the ``role:text`` lines) of conversations that have repaired rows.

    ``repaired`` comes straight from ``repaired_turns``: its order within partitions is relied on.
    """
    return repaired.mapInArrow(_digests, "conv bigint, digest string")


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(repaired rows, report per conversation); the reports are written, the repaired rows are not."""
    rows = judged(turns, conv_col, turn_col, role_col, text_col)
    reports = structure_reports(rows)
    with settings(turns.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(TEXT_ROWS)):
        return repaired_turns(rows, reports), reports


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` rows (conv_id, turn, role, text) with faults put in by the checksum of their id and turn."""
    def plain(name: str) -> Column:
        return F.coalesce(turns[name].cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = turns.select(turns["conv_id"], turns["turn"], plain("role").alias("role"), plain("text").alias("text"),
                        kind.alias("kind")).where("kind <> 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"), copies.alias("_copy")).drop("_copy")
