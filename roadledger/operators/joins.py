"""Key lookups, star joins, insert-or-ignore and constraint checks.

A side is broadcast only as a stored table whose rows and bytes are known to be few; beyond that it
is shuffled. What may be hot then is a key of the big side, so the shuffled case salts exactly the
keys found to be hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadledger.session import planned_bytes, side_by_side, stored, written

# At most this many keys can each hold more than 1/256 of the rows, so the list is bounded.
HOT_KEY_LIMIT = 256
SALTS = 64
# Rows and (file) bytes a stored table may have to be broadcast.
SMALL_TABLE, SMALL_BYTES = 200_000, 16 << 20
# Rows of a table of two numbers, which takes some 70 bytes a row where it is sent.
NARROW_TABLE = 1_000_000


def is_small(table: DataFrame, rows: int = SMALL_TABLE) -> bool:
    """Whether a stored table may be sent to every task."""
    return planned_bytes(table) <= SMALL_BYTES and table.count() <= rows


def sent_if_small(table: DataFrame, rows: int = SMALL_TABLE) -> DataFrame:
    """A stored table, marked to be broadcast if it is small, whatever size Spark itself would broadcast."""
    return F.broadcast(table) if is_small(table, rows) else table


def hot_keys(df: DataFrame, on: Sequence[str], sample: float = 0.01) -> list[tuple]:
    """The keys that hold over 1/256 of the rows of a sample of ``df``, which should be a stored table.

    The sample is added up before its shuffle. It only decides where salt is spent: a key missed or listed wrongly changes no result.
    """
    drawn = df.select(*on).sample(sample, seed=7)
    counted = written(drawn.groupBy(*on).agg(F.count("*").alias("_n")), "key_sample")
    top = counted.orderBy(F.desc("_n")).limit(HOT_KEY_LIMIT).collect()
    total = counted.agg(F.sum("_n")).first()[0] or 0
    return [tuple(row[c] for c in on) for row in top if row["_n"] >= 8 and row["_n"] * HOT_KEY_LIMIT > total]


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                hot: Sequence[tuple] | None = None, null_safe: bool = False) -> DataFrame:
    """Equi-join (inner or left) that spreads the hot keys of ``left`` over many tasks.

    Left rows of a hot key get a salt from a hash of their own values (the same on any retry);
    the few right rows of those keys are copied once per salt. All other rows keep salt 0. A key is
    looked up by its hash in a set; another key of the same hash is salted on both sides alike.
    Without ``hot`` the keys are sought in ``left``, which then should be a stored table.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting keeps results only for inner and left joins")
    keys = hot_keys(left, on) if hot is None else hot
    if not keys:
        return joined_on(left, right, on, how, null_safe)

    kinds = [left.schema[c].dataType for c in on]
    marks = [F.xxhash64(*[F.lit(v).cast(kind) for v, kind in zip(key, kinds)]) for key in keys]

    def is_hot(df: DataFrame) -> Column:
        return F.xxhash64(*[df[c].cast(kind) for c, kind in zip(on, kinds)]).isin(*marks)

    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(SALTS)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot(left), salt).otherwise(F.lit(0)))
    copies = right.withColumn("_salt", F.explode(
        F.when(is_hot(right), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return joined_on(salted, copies, [*on, "_salt"], how, null_safe).drop("_salt")


def joined_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    """Join on equal names, keeping the left side's columns once; optionally null equals null."""
    if not null_safe:
        return left.join(right, list(on), how)
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in on])
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in on])


def sized_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
               null_safe: bool = False, hot: Sequence[tuple] | None = None) -> DataFrame:
    """Broadcasts ``right`` (stored first, if it isn't) if it is small, else shuffles with hot keys salted.

    ``hot`` are keys known to be hot in ``left``; an empty list says that none is.
    """
    right = stored(right, "sized")
    if is_small(right):
        return joined_on(left, F.broadcast(right), on, how, null_safe)
    return salted_join(left, right, on, how, hot, null_safe)


def lookup_key(facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], key: str,
               default: int = 1, null_safe: bool = False) -> DataFrame:
    """Adds the surrogate key of the matching dimension row; ``on`` maps fact to dimension columns.

    The dimension is first reduced to its least key per join value, so rows never multiply.
    Unmatched rows get ``default``. With ``null_safe`` a null matches a null.
    """
    one = (dimension.select(key, *[F.col(d).alias(f) for f, d in on.items()])
           .groupBy(*on).agg(F.min(key).alias(key)))
    return sized_join(facts, one, list(on), "left", null_safe).withColumn(
        key, F.coalesce(F.col(key), F.lit(default).cast("bigint")))


def star_join(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]],
              fact_columns: Sequence[str] | None = None) -> DataFrame:
    """Inner joins of a fact table to (dimension, key, columns wanted), pruned on both sides.

    Every dimension is a stored table (or made one), so its size is known: small ones are broadcast and
    the facts stay where they are; larger ones are joined last, with the hot keys of the facts salted.
    """
    keys = [key for _, key, _ in dims]
    kept = list(fact_columns) if fact_columns is not None else [c for c in facts.columns if c not in keys]
    result = facts.select(*dict.fromkeys([*kept, *keys]))
    def sized_side(dim: DataFrame, key: str, columns: Sequence[str]) -> tuple[DataFrame, str, bool]:
        wanted = stored(dim.select(key, *[c for c in columns if c != key]), "dimension")
        return wanted, key, is_small(wanted)

    sized = side_by_side(*[partial(sized_side, *dim) for dim in dims]) if dims else []
    for wanted, key, small in sorted(sized, key=lambda d: not d[2]):
        result = result.join(F.broadcast(wanted), key) if small else salted_join(result, wanted, [key], hot=hot_keys(facts, [key]))
    wanted = [c for _, _, columns in dims for c in columns]
    return result.select(*dict.fromkeys([*kept, *wanted]))


def null_safe_match(left: DataFrame, right: DataFrame, on: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in on])


def only_new(candidates: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Insert-or-ignore: candidates whose natural key the table does not hold yet (null = null)."""
    known = existing.select(*on)
    return candidates.join(known, null_safe_match(candidates, known, on), "left_anti")


def only_new_to_history(candidates: DataFrame, history: DataFrame, on: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """As ``only_new`` for a history far larger than the batch: its keys are first cut down to those of the
    batch, which are sent to where the history lies while they are few. Both sides should be stored tables;
    ``wanted`` are the batch's distinct keys, where they are stored already."""
    wanted = written(candidates.select(*on).distinct(), "wanted_keys") if wanted is None else wanted
    small, known = is_small(wanted), history.select(*on)
    asked = F.broadcast(wanted) if small else wanted
    held = written(known.join(asked, null_safe_match(known, wanted, on), "left_semi").distinct(), "held_keys")
    return candidates.join(F.broadcast(held) if is_small(held) else held, null_safe_match(candidates, held, on), "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows_with_key")).where("rows_with_key > 1")


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    return (child.where(F.col(child_key).isNotNull())
            .join(known, F.col(child_key) == F.col("_parent"), "left_anti"))


def attach_weather(incidents: DataFrame, readings: DataFrame, when: str, values: Sequence[str],
                   fallback: Mapping[str, object]) -> DataFrame:
    """Hourly weather of the 0.01-degree site and hour of each incident.

    The readings are reduced to one row per site and hour first. A missing reading (or value) is
    replaced by the given fallback columns.
    """
    def site(df: DataFrame, clock: str) -> list:
        return [F.round(F.col("latitude").cast("decimal(10,6)"), 2).alias("_lat"),
                F.round(F.col("longitude").cast("decimal(10,6)"), 2).alias("_lon"),
                F.date_trunc("hour", F.col(clock)).cast("timestamp_ntz").alias("_hour")]

    hourly = (readings.select(*site(readings, "weather_timestamp"), *values)
              .groupBy("_lat", "_lon", "_hour")
              .agg(*[F.min(v).alias(f"_seen_{v}") for v in values]))
    placed = incidents.select("*", *site(incidents, when))
    joined = salted_join(placed, hourly, ["_lat", "_lon", "_hour"], "left")
    return joined.select(*incidents.columns, *[
        F.coalesce(F.col(f"_seen_{v}"), fallback[v]).alias(v) for v in values])
