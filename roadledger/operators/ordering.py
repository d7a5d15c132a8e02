"""Order-dependent operators that never bring a whole group or table into one task.

An unpartitioned window would. Here the rows are range-partitioned and sorted once, written to the
shared work folder (one file per partition), and every later step needs only that table plus one
small offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadledger.session import shuffle_width, written

_PART, _POS = "_part", "_pos"


def _ranged(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` in global order: column ``_part`` gives the partition, files keep the order inside it."""
    width = shuffle_width(df.sparkSession)
    placed = (df.repartitionByRange(width, *order).sortWithinPartitions(*order)
              .withColumn(_PART, F.spark_partition_id()))
    return written(placed, label)


def _offsets(table: DataFrame, start: int) -> list[int]:
    """Number of the first row of each partition, and last the number after the last row."""
    counts = dict(table.groupBy(_PART).count().collect())
    offsets = [start]
    for part in range(max(counts, default=-1) + 1):
        offsets.append(offsets[-1] + counts.get(part, 0))
    return offsets


def _numbered(table: DataFrame, offsets: list[int], name: str) -> DataFrame:
    base = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    return (table.withColumn(_POS, F.col("_metadata.row_index"))
            .withColumn(name, F.element_at(base, F.col(_PART) + 1) + F.col(_POS))
            .drop(_PART, _POS))


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_number",
                start: int = 1) -> DataFrame:
    """Dense global row numbers in the given order, which should be total.

    One range shuffle; the number is the partition's offset plus the position in its file, so
    there is no window and no second shuffle. Only one count per partition reaches the driver.
    """
    table = _ranged(df, order, "numbered")
    return _numbered(table, _offsets(table, start), name)


def running_totals(df: DataFrame, group: Sequence[str], value: str, amounts: Sequence[str]) -> DataFrame:
    """Running sums of ``amounts`` in order of ``value`` within each group.

    ``df`` has one row per (group, value), i.e. duplicates are already added up, so a range
    partition holds a bounded share of any group however hot a value was in the input. Adds
    ``<amount>_upto`` (this row included) and ``<amount>_total`` (the whole group).
    """
    table = _ranged(df, [F.col(c) for c in (*group, value)], "running")
    chunk = table.groupBy(*group, _PART).agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
    # The totals have one row per group and partition that holds a piece of it.
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = chunk.select(
        *group, _PART,
        *[F.coalesce(F.sum(f"_{a}").over(before), F.lit(0)).alias(f"_{a}_before") for a in amounts],
        *[F.sum(f"_{a}").over(whole).alias(f"{a}_total") for a in amounts])
    here = Window.partitionBy(*group, _PART).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = table.select("*", *[F.sum(a).over(here).alias(f"_{a}_here") for a in amounts])
    joined = local.join(offsets, [*group, _PART])
    kept = [c for c in df.columns]
    return joined.select(
        *kept,
        *[(F.col(f"_{a}_here") + F.col(f"_{a}_before")).alias(f"{a}_upto") for a in amounts],
        *[f"{a}_total" for a in amounts])


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns turned into rows (feature, value), nulls and NaN dropped, as doubles."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    tall = wide.unpivot(list(keep), list(columns), "feature", "value")
    return tall.where(F.col("value").isNotNull() & ~F.isnan("value"))


def quantile_positions(totals: DataFrame, group: Sequence[str], value: str, amount: str,
                       probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles from running totals; one row per group, array ``quantiles``.

    Position p*(n-1) counts from 0; a value covers the positions from its total before to its
    total so far, so each quantile needs at most two rows, found by a conditional maximum.
    """
    upto, total = F.col(f"{amount}_upto"), F.col(f"{amount}_total")
    before = upto - F.col(amount)
    picks = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (total - 1)
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            inside = (before <= at) & (at < upto)
            picks.append(F.max(F.when(inside, F.col(value))).alias(f"_{side}{i}"))
    found = totals.groupBy(*group).agg(F.max(f"{amount}_total").alias("_n"), *picks)
    result = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        weight = position - F.floor(position)
        result.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * weight)
    return found.select(*group, F.array(*result).alias("quantiles"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns in one pass: (feature, quantiles)."""
    counts = long_values(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    totals = running_totals(counts, ["feature"], "value", ["n"])
    return quantile_positions(totals, ["feature"], "value", "n", probabilities)


def chronological_split(df: DataFrame, order: Sequence[Column], cuts: Sequence[float],
                        names: Sequence[str], name: str = "split") -> DataFrame:
    """Consecutive shares of the ordered rows; cut i falls after the first int(n * cut) rows.

    Only the order columns are sorted. The value found at each cut then splits the whole rows by a
    comparison, so those are neither shuffled nor written. If equal rows lie on both sides of a cut
    no value separates them, and the whole rows are numbered instead.
    """
    keys = [f"_order{i}" for i in range(len(order))]
    narrow = df.select(*[c.alias(k) for c, k in zip(order, keys)])
    table = _ranged(narrow, [F.col(k) for k in keys], "order")
    offsets = _offsets(table, 0)
    n = offsets[-1]
    ends = [int(n * cut) for cut in cuts]
    # At most two rows per cut, as texts, which cast back to the same values.
    near = {row["_rank"]: [row[k] for k in keys] for row in _numbered(table, offsets, "_rank")
            .where(F.col("_rank").isin([r for e in ends for r in (e - 1, e)]))
            .select("_rank", *[F.col(k).cast("string").alias(k) for k in keys]).collect()}
    if any(e - 1 in near and e in near and near[e - 1] == near[e] for e in ends):
        rank = F.col("_rank")
        rows = number_rows(df, order, name="_rank", start=0)
        tests = [rank < e for e in ends]
    else:
        rows = df
        kinds = [f.dataType for f in narrow.schema.fields]
        place = F.struct(*[c.alias(k) for c, k in zip(order, keys)])

        def before(end: int) -> Column:
            if end not in near:
                return F.lit(end >= n)
            return place < F.struct(*[F.lit(v).cast(kind).alias(k) for v, kind, k in zip(near[end], kinds, keys)])

        tests = [before(e) for e in ends]
    label = None
    for inside, part in zip(tests, names):
        label = F.when(inside, part) if label is None else label.when(inside, part)
    return rows.withColumn(name, label.otherwise(names[-1])).drop("_rank")
