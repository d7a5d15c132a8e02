"""Chat formatting by DataFrame expressions: sort collected turns, merge neighbours of one role, concatenate.

A conversation becomes ``<s>`` and its blocks. A block holds adjacent turns of one role between that role's marks, its
turns parted by ``[TURN]``. Inside texts and role names every ``<``, ``[`` and backslash is written as an escape, so no
mark can occur there and the turns can be read back exactly. ``loss_spans`` are the places of the assistant's
(escaped) texts in ``formatted``, by code points.

Defined results: null text or role is empty; turns are sorted by (turn, role, text), nulls first, so repeated rows
stay as repeated turns; a null conv_id is one conversation; roles without marks of their own get the general ones; an
empty table gives no rows; other columns are neither read nor returned. One conversation is one output row, so its
turns meet in one task whatever the operator does; the work grows with its turns and its characters, not with their
squares: places are running sums over the sorted rows, and no step copies what the earlier ones made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, TURN = "<s>", "[TURN]"
#: role: (opening mark, closing mark)
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[ASST] ", "</s>")}
OTHER_OPEN, OTHER_MID, OTHER_CLOSE = "[ROLE]", "[/ROLE] ", " [/OTHER]"
#: In this order; every backslash of an escaped text starts one of the three.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("[", "\\o")]
#: Code points that a formatted conversation is cut into to be read at given places.
CHUNK = 1024


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _by_role(role: Column, end: int, other: Column) -> Column:
    named = [F.when(role == name, F.lit(marks[end])) for name, marks in MARKS.items()]
    return F.coalesce(*named, other)


def _opening(role: Column) -> Column:
    return _by_role(role, 0, F.concat(F.lit(OTHER_OPEN), escaped(role), F.lit(OTHER_MID)))


def _closing(role: Column) -> Column:
    return _by_role(role, 1, F.lit(OTHER_CLOSE))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of (conv, turn, role, text) with ``first`` (opens a run of its role) and the span of the text in the result."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.select("*", F.coalesce(F.col("role") != F.lag("role").over(order), F.lit(True)).alias("first"),
                       F.coalesce(F.col("role") != F.lead("role").over(order), F.lit(True)).alias("last"),
                       F.char_length(escaped(F.col("text"))).cast("bigint").alias("length"))
    before = F.when(F.col("first"), F.char_length(_opening(F.col("role")))).otherwise(F.lit(len(TURN)))
    after = F.when(F.col("last"), F.char_length(_closing(F.col("role")))).otherwise(F.lit(0))
    upto = F.sum(before + F.col("length") + after).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("start", upto - after - F.col("length") + F.lit(len(START)))


def _blocks(turns: Column, starts: Column) -> Column:
    """array<struct<role, texts>>: runs of turns of one role, from the places where they start to the next ones."""
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(turns)))
    return F.zip_with(starts, ends, lambda s, e: F.struct(
        F.get(turns, s)["role"].alias("role"),
        F.transform(F.sequence(s, e - 1), lambda i: escaped(F.get(turns, i)["text"])).alias("texts")))


def _pieces(blocks: Column) -> Column:
    """array<string> in order: marks, and the texts themselves."""

    def block(b: Column) -> Column:
        texts = F.array_join(b["texts"], TURN)
        return F.concat(_opening(b["role"]), texts, _closing(b["role"]))

    return F.transform(blocks, block)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``."""
    rows = turns.select(turns[conv_col].alias("conv"), turns[turn_col].alias("turn"),
                        F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"),
                        F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"))
    # The running sums leave the rows where the aggregate wants them: one exchange.
    rows = _placed(rows).groupBy("conv").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text", "start", "length", "first"))).alias("turns"))
    starts = F.array_compact(F.transform("turns", lambda t, i: F.when(t["first"], i)))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(t["start"], t["length"]))
    rows = rows.select("conv", "turns", starts.alias("starts"), spans.alias("spans"))
    rows = rows.select("conv", "spans", _blocks(F.col("turns"), F.col("starts")).alias("blocks"))
    rows = rows.select("conv", "spans", _pieces(F.col("blocks")).alias("pieces"))
    return rows.select(F.col("conv").alias(conv_col), F.concat(F.lit(START), F.array_join("pieces", "")).alias("formatted"),
                       F.col("spans").alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    marks = [marks[0] for marks in MARKS.values()] + [OTHER_OPEN]
    ahead = "|".join(m.replace("[", r"\[").replace("]", r"\]") for m in marks)
    blocks = F.split(F.substring(formatted, len(START) + 1, 2**31 - 1), f"(?={ahead})")

    def between(b: Column, opening: Column, closing: Column) -> Column:
        return F.substring(b, opening + 1, F.char_length(b) - opening - closing)

    def block(b: Column) -> Column:
        other_end = F.locate(OTHER_MID, b) - 1  # 0-based place of the second mark of a general role
        role = F.coalesce(*[F.when(F.startswith(b, F.lit(m[0])), F.lit(name)) for name, m in MARKS.items()],
                          unescaped(F.substring(b, F.lit(len(OTHER_OPEN) + 1), other_end - len(OTHER_OPEN))))
        named = [F.when(F.startswith(b, F.lit(m[0])), between(b, F.lit(len(m[0])), F.lit(len(m[1])))) for m in MARKS.values()]
        body = F.coalesce(*named, between(b, other_end + len(OTHER_MID), F.lit(len(OTHER_CLOSE))))
        return F.transform(F.split(body, r"\[TURN\]"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, block))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""

    def read(chunks: Column, s: Column) -> Column:
        end = s["start"] + s["length"]

        def part(k: Column) -> Column:
            low, high = F.greatest(s["start"], k * CHUNK), F.least(end, (k + 1) * CHUNK)
            return F.substring(F.get(chunks, k.cast("int")), (low - k * CHUNK + 1).cast("int"), (high - low).cast("int"))

        places = F.sequence(F.floor(s["start"] / CHUNK), F.floor((end - 1) / CHUNK))
        return F.when(s["length"] == 0, F.lit("")).otherwise(unescaped(F.array_join(F.transform(places, part), "")))

    # A list of one, so that the text is cut up once and not again for every span.
    cut = F.array(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    return F.transform(cut, lambda chunks: F.array_join(F.transform(spans, lambda s: read(chunks, s)), ""))[0]
