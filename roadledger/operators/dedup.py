"""Duplicate handling by aggregation, so a hot key is reduced before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType

from roadledger.operators.joins import sized_join
from roadledger.session import written


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order; nulls count as one key value."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def keep_first_by_id(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    """As ``keep_first`` for wide rows with a unique ``row_id``: only keys, order and ids are sorted and
    shuffled, and the rows that aren't first leave by a join with the few ids of the repeats."""
    return flag_repeats(df, keys, order, row_id).where("NOT is_repeat").drop("is_repeat")


def flag_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: Sequence[str],
                 name: str = "is_repeat") -> DataFrame:
    """Marks every row but the first of its key; nulls count as one key value.

    Only keys, order and ids are shuffled: the least id of every key is reduced before its shuffle, so a hot key is no
    matter. The ids of the firsts are then told to the wide rows as bits, and those stay where they are. Where ids are
    no whole numbers or not unique, or their bits are too many for a broadcast, rows and ids meet in a join instead.
    ``df`` should be a stored table.
    """
    if not isinstance(df.schema[row_id[-1]].dataType, (IntegerType, LongType)) or not unique_ids(df, row_id):
        return flag_repeats_by_join(df, keys, order, row_id, name)
    ids = {f"_id{i}": F.col(c) for i, c in enumerate(row_id)}
    least = df.select(*dict.fromkeys([*keys, *order, *row_id])).groupBy(*keys).agg(
        F.min(F.struct(*order, *[c.alias(i) for i, c in ids.items()])).alias("_least"))
    firsts = least.select(*[F.col(f"_least.{i}").alias(c) for i, c in zip(ids, row_id)])
    marked = written(row_bits(firsts, row_id), "first_bits")
    if marked.count() * BITS_LENGTH > BITS_BYTES:
        return flag_repeats_by_join(df, keys, order, row_id, name)
    *rest, last = row_id
    bits = F.broadcast(marked.withColumnsRenamed({c: f"_of_{c}" for c in rest}))
    here = reduce(lambda a, c: a & (F.col(c) == F.col(f"_of_{c}")), rest, F.expr(f"bitmap_bucket_number(`{last}`)") == F.col("_bucket"))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in row_id])
    found = df.join(bits, here, "left").withColumn(name, known & ~F.coalesce(has_bit("_bits", last), F.lit(False)))
    return found.select(*df.columns, name)


def flag_repeats_by_join(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: Sequence[str],
                         name: str = "is_repeat") -> DataFrame:
    """As ``flag_repeats``, by three narrow steps before the wide rows are touched: keys held twice or more (a count,
    reduced before its shuffle), the rows of those keys, and among them all but the least per key.
    What is joined to the wide rows is the ids of the repeats: broadcast while there are few, else spread evenly,
    even if one key holds most rows."""
    several = written(df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys), "several")
    if several.isEmpty():
        return df.withColumn(name, F.lit(False))
    narrow = df.select(*dict.fromkeys([*keys, *order, *row_id]))
    rows = sized_join(narrow, several, keys, "inner", null_safe=True)
    ids = {f"_id{i}": F.col(c) for i, c in enumerate(row_id)}
    least = rows.groupBy(*keys).agg(F.min(F.struct(*order, *[c.alias(i) for i, c in ids.items()])).alias("_least"))
    firsts = least.select(*[F.col(f"_least.{i}").alias(c) for i, c in zip(ids, row_id)])
    repeats = written(rows.select(*row_id).join(firsts, list(row_id), "left_anti"), "repeats")
    marked = repeats.withColumn(name, F.lit(True))
    return sized_join(df, marked, row_id, "left", hot=[]).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


# Bytes that the bits of all row ids may have to be sent to every task, and those of one row of bits.
BITS_BYTES, BITS_LENGTH = 64 << 20, 4096


def id_words(rows: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Row ids, the last column a whole number, as bits: the other columns, ``_bucket`` (32,768 numbers), ``_word`` (64 of
    them), ``_word_bits`` and the number of ``_rows``. Ids are brought together before they become bits, as the bits of a few
    ids would be larger than those. A word is a number, so words are added up in a hash table and no id is sorted."""
    *rest, last = row_id
    at = f"bitmap_bit_position(`{last}`)"
    placed = rows.dropna(subset=list(row_id)).select(
        *rest, F.expr(f"bitmap_bucket_number(`{last}`)").alias("_bucket"), F.expr(f"CAST({at} AS INT)").alias("_at"))
    return placed.repartition(*rest, "_bucket").groupBy(*rest, "_bucket", F.expr("CAST(_at div 64 AS INT)").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, _at % 64))").alias("_word_bits"), F.count("*").alias("_rows"))


def row_bits(rows: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Bitmaps of row ids: the other columns, ``_bucket`` and ``_bits``, the words of its 32,768 numbers in order."""
    words = id_words(rows, row_id).groupBy(*row_id[:-1], "_bucket").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_word_bits"))).alias("_words"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS_LENGTH // 8 - 1)), lambda w: F.coalesce(F.try_element_at("_words", w), F.lit(0).cast("bigint")))
    return words.select(*row_id[:-1], "_bucket", bits.alias("_bits"))


def unique_ids(rows: DataFrame, row_id: Sequence[str]) -> bool:
    """Whether no row id without nulls comes twice; true of none."""
    return id_words(rows, row_id).where("_rows > bit_count(_word_bits)").isEmpty()


def has_bit(bits: str, number: str) -> Column:
    """Whether the bit of a number is set in its bitmap; null without a bitmap."""
    at = f"bitmap_bit_position(`{number}`)"
    return F.expr(f"getbit({bits}[CAST({at} div 64 AS INT)], CAST({at} % 64 AS INT)) = 1")


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
