"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Tokens are summed by cell (one cell per combination of source, language and topic; combined before the shuffle).
Raking goes over the margins in turn and scales the cells until each margin's shares meet its targets; the cell table
stays a DataFrame and is written once a round. A document is then kept with its cell's probability: wanted tokens over
tokens there. No cell can give more than it has: cells at probability 1 are held, and the free cells of a margin value
are scaled to what is left of its goal. A target above all tokens of its value cannot be met by any sample; its goal is
those tokens, and the other margins' goals are lowered to the same total (``margin_report`` says so). The draw is a
digest of the id, so it is the same in every run and at every cluster size. DataFrame functions only.

Defined results: a null margin value is a class of its own (the empty string); null text has no tokens; documents of a
cell without tokens are kept with ``keep_share``; rows that share an id are kept or left together; an empty table
gives no rows; other columns are left as they are, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadledger.llm.common import dropped, narrow_join, text_of
from roadledger.session import written

WORD = r"[^\x20\x09-\x0D]+"
#: Share of all tokens to keep, and rounds of raking.
KEEP_SHARE, ROUNDS = 0.5, 8
#: A target is the margin's share of tokens to this power, made to add up to 1: below 1, rare values gain.
TEMPER = 0.7
SEED = "mix-1"


def topic_of(text: Column) -> Column:
    """Kind of a text, by what it holds anywhere."""
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.contains(text, F.lit("icensed under ")) | F.contains(text, F.lit("eleased under ")), "licensed")
            .when(F.regexp_like(text, F.lit("[0-9]{8}")), "record").otherwise("prose"))


def draw(ident: Column, seed: str = SEED) -> Column:
    """A number from 0 to below 1 that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(seed))), 1, 8),
                  16, 10).cast("double") / F.lit(float(2**32))


def _reachable(cells: DataFrame, targets: dict[str, float | dict[str, float]], keep_share: float) -> DataFrame:
    """``cells`` with ``cap`` and a goal per margin value: the target's share of what is to be kept, at most all there is.

    Shares are of all tokens. What unreachable targets leave over is taken from the goals of the other margins alike,
    so all margins ask for the same total. A few numbers per margin reach the driver, whatever the size of the table.
    """
    cells = cells.withColumn("cap", F.col("weight") / F.lit(keep_share))
    totals = {}
    for margin, target in targets.items():
        of_value = Window.partitionBy(margin)
        held = F.sum("weight").over(of_value)
        if isinstance(target, dict):
            raw = F.coalesce(*[F.when(F.col(margin) == value, F.lit(float(goal))) for value, goal in target.items()], F.lit(0.0))
        else:
            raw = F.pow(held, F.lit(float(target)))
        # A value's number is counted once: by its cells' equal parts of it.
        cells = cells.withColumns({f"raw_{margin}": raw, f"part_{margin}": 1 / F.count("*").over(of_value),
                                   f"most_{margin}": F.sum("cap").over(of_value)})
    cells = written(cells, "cells")
    sums = cells.agg(*[F.sum(F.col(f"raw_{m}") * F.col(f"part_{m}")).alias(m) for m in targets]).first()
    goal = {m: F.least(F.col(f"raw_{m}") / F.lit(float(sums[m] or 1.0)), F.col(f"most_{m}")) for m in targets}
    sums = cells.agg(*[F.sum(goal[m] * F.col(f"part_{m}")).alias(m) for m in targets]).first()
    total = min((float(sums[m] or 0.0) for m in targets), default=0.0)
    goals = {f"goal_{m}": goal[m] * F.lit(total / (float(sums[m] or 0.0) or 1.0)) for m in targets}
    return cells.withColumns(goals).drop(*[f"{kind}_{m}" for kind in ("raw", "part", "most") for m in targets])


def _raked(cells: DataFrame, margin: str) -> DataFrame:
    """Cells scaled so that every value of ``margin`` has its goal. Cells at their cap do not grow: if a value needs
    more, its other cells make up for them."""
    of_value, weight = Window.partitionBy(margin), F.col("weight")
    full = weight >= F.col("cap")
    cells = cells.withColumns({"held": F.sum("weight").over(of_value),
                               "full": F.sum(F.when(full, weight).otherwise(0.0)).over(of_value)})
    goal, free = F.col(f"goal_{margin}"), F.col("held") - F.col("full")
    factor = (F.when(F.col("held") <= 0, 0.0).when(goal <= F.col("held"), goal / F.col("held"))
              .when(full | (free <= 0), 1.0).otherwise((goal - F.col("full")) / free))
    return cells.withColumn("weight", F.least("cap", weight * factor)).drop("held", "full")


def mixed_cells(rows: DataFrame, targets: dict[str, float | dict[str, float]], keep_share: float = KEEP_SHARE,
                rounds: int = ROUNDS) -> DataFrame:
    """Margins, tokens, ``weight`` (share of all kept tokens wanted of the cell), goals and ``probability`` of every
    cell of ``rows`` (the margin columns and ``tokens``); written."""
    spark, margins = rows.sparkSession, list(targets)
    counted = written(rows.groupBy(*margins).agg(F.sum("tokens").alias("tokens")), "cells")
    all_tokens = float(counted.agg(F.sum("tokens")).first()[0] or 0)
    share = F.col("tokens") / F.lit(all_tokens) if all_tokens else F.lit(0.0)
    cells = _reachable(counted.withColumn("weight", share), targets, keep_share)
    for _ in range(rounds):
        before, cells = cells, written(reduce(_raked, margins, cells), "cells")
        dropped(spark, before)
    chance = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("cap"))).otherwise(keep_share)
    out = written(cells.withColumn("probability", chance), "mixture")
    dropped(spark, counted, cells)
    return out


def margin_report(cells: DataFrame, margin: str) -> DataFrame:
    """(value, goal, most, got): shares of the tokens to keep that a value was to have, could have, and has."""
    return cells.groupBy(F.col(margin).alias("value")).agg(
        F.max(f"goal_{margin}").alias("goal"), F.sum("cap").alias("most"), F.sum("weight").alias("got"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict | None = None,
            topic: Column | None = None, keep_share: float = KEEP_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """``__mix_row`` (the whole row of ``docs``), ``__mix_source``, ``__mix_lang``, ``__mix_topic``, ``__mix_tokens``,
    ``__mix_probability`` and ``__mix_kept``."""
    targets = targets or {"source": TEMPER, "lang": TEMPER, "topic": TEMPER}
    columns = {"source": docs["source"], "lang": docs["lang"],
               "topic": topic_of(text_of(docs, text_col)) if topic is None else topic}
    # The row travels as one struct, so no name in it meets a name used here.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__mix_row"),
                       *[F.coalesce(c.cast("string"), F.lit("")).alias(f"__mix_{m}") for m, c in columns.items()],
                       F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("bigint").alias("__mix_tokens"),
                       draw(docs[id_col]).alias("__mix_draw"))
    margins = {f"__mix_{m}": t for m, t in targets.items()}
    cells = mixed_cells(rows.select(*margins, F.col("__mix_tokens").alias("tokens")), margins, keep_share, rounds)
    chances = written(cells.select(*margins, F.col("probability").alias("__mix_probability")), "chances")
    placed = narrow_join(rows, chances, list(margins), "left")
    return placed.withColumn("__mix_kept", F.col("__mix_draw") < F.col("__mix_probability"))


def mixed_sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps, with all their columns."""
    return mixture(docs, **options).where("__mix_kept").select("__mix_row.*")
