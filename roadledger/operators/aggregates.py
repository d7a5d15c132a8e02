"""Marts and dashboard summaries.

The marts add up the fact table by its foreign keys before any dimension is joined: what then
travels is one row per combination of keys, however hot a key is, and the result is the same as
joining first because every dimension key is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadledger.functions.calendar import DAY_NAMES, weekend_label
from roadledger.functions.geo import grid, hex_cell
from roadledger.operators.joins import star_join

SEVERITIES = ["Fatal", "Serious", "Slight"]


def pre_summed(facts: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Fact rows added up by foreign keys: ``records`` and the named sums."""
    return facts.groupBy(*keys).agg(
        F.count("*").alias("records"), *[F.sum(c).alias(c) for c in sums])


def hourly_sums(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pre_summed(facts, [*by, "date_key", "severity_key"], ["number_of_casualties", "number_of_vehicles"])


def hourly_severity_mart(facts: DataFrame, dates: DataFrame, severities: DataFrame) -> DataFrame:
    return hourly_severity_mart_of(hourly_sums(facts), dates, severities)


def hourly_severity_mart_of(summed: DataFrame, dates: DataFrame, severities: DataFrame) -> DataFrame:
    """The mart from ``hourly_sums``, which may be split by more keys."""
    keys = ["day_name", "day_of_week", "hour", "time_of_day", "severity_name"]
    joined = star_join(summed, [(dates, "date_key", keys[:4]), (severities, "severity_key", keys[4:])])
    return joined.groupBy(*keys).agg(
        F.sum("records").alias("accident_count"),
        F.sum("number_of_casualties").alias("total_casualties"),
        F.sum("number_of_vehicles").alias("total_vehicles"))


def weather_road_sums(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return facts.groupBy(*by, "weather_key", "road_key", "severity_key").agg(
        F.count("*").alias("records"),
        F.sum("number_of_casualties").alias("casualties"),
        F.count("number_of_casualties").alias("counted"))


def weather_road_mart(facts: DataFrame, weather: DataFrame, roads: DataFrame,
                      severities: DataFrame) -> DataFrame:
    return weather_road_mart_of(weather_road_sums(facts), weather, roads, severities)


def weather_road_mart_of(summed: DataFrame, weather: DataFrame, roads: DataFrame,
                         severities: DataFrame) -> DataFrame:
    """The mart from ``weather_road_sums``, which may be split by more keys."""
    keys = ["weather_condition", "weather_risk_level", "road_type", "road_surface_conditions",
            "speed_limit", "severity_name"]
    joined = star_join(summed, [(weather, "weather_key", keys[:2]), (roads, "road_key", keys[2:5]),
                                (severities, "severity_key", keys[5:])])
    return joined.groupBy(*keys).agg(
        F.sum("records").alias("accident_count"),
        F.sum("casualties").alias("total_casualties"),
        F.round(F.try_divide(F.sum("casualties"), F.sum("counted")), 2).alias("avg_casualties_per_accident"))


def severity_counts(weight: Column) -> list[Column]:
    return [F.sum(F.when(F.col("severity_name") == s, weight).otherwise(0)).alias(f"{s.lower()}_count")
            for s in SEVERITIES]


def hotspot_sums(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pre_summed(facts, [*by, "location_key", "severity_key"], ["number_of_casualties"])


def hotspot_mart(facts: DataFrame, locations: DataFrame, severities: DataFrame,
                 min_count: int = 1) -> DataFrame:
    return hotspot_mart_of(hotspot_sums(facts), locations, severities, min_count)


def hotspot_mart_of(summed: DataFrame, locations: DataFrame, severities: DataFrame,
                    min_count: int = 1) -> DataFrame:
    """The mart from ``hotspot_sums``, which may be split by more keys."""
    joined = star_join(summed, [
        (locations, "location_key", ["latitude", "longitude", "local_authority", "urban_or_rural"]),
        (severities, "severity_key", ["severity_name"])])
    return (joined.groupBy(grid(F.col("latitude"), 3).alias("lat_binned"),
                           grid(F.col("longitude"), 3).alias("lon_binned"),
                           "local_authority", "urban_or_rural")
            .agg(F.sum("records").alias("accident_count"), *severity_counts(F.col("records")),
                 F.sum("number_of_casualties").alias("total_casualties"))
            .where(F.col("accident_count") >= min_count))


def kpis(df: DataFrame) -> DataFrame:
    """One row of headline figures; the mean is rounded half to even."""
    return df.agg(
        F.count("*").alias("total_accidents"),
        *[F.count_if(F.col("severity_name") == s).alias(f"{s.lower()}_count") for s in SEVERITIES],
        F.sum("number_of_casualties").alias("total_casualties"),
        F.bround(F.avg("number_of_vehicles"), 2).alias("avg_vehicles"))


def records(weight: str | None, condition: Column | None = None) -> Column:
    """Number of records, or of those that meet a condition; with a weight, rows stand for so many records."""
    if weight is None:
        return F.count("*") if condition is None else F.count_if(condition)
    return F.sum(weight) if condition is None else F.sum(F.when(condition, F.col(weight)).otherwise(0))


def value_counts(df: DataFrame, column: str, name: str = "records", weight: str | None = None) -> DataFrame:
    return (df.dropna(subset=[column]).groupBy(column).agg(records(weight).alias(name))
            .orderBy(F.desc(name), column))


def cross_counts(df: DataFrame, first: str, second: str, name: str = "records", weight: str | None = None) -> DataFrame:
    return df.dropna(subset=[first, second]).groupBy(first, second).agg(records(weight).alias(name))


def weekend_sums(df: DataFrame, flag: str, by: str, amount: str, name: str) -> DataFrame:
    return (df.dropna(subset=[by])
            .groupBy(weekend_label(F.col(flag)).alias("weekend_label"), by)
            .agg(F.sum(amount).alias(name)))


def day_hour_pivot(df: DataFrame, day: str, hour: str, counted: str) -> DataFrame:
    """One row per weekday in calendar order, one column per hour, counts of non-null values."""
    spark = df.sparkSession
    days = spark.range(1, 8).select(
        F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("id").cast("int")).alias(day),
        F.col("id").cast("int").alias("day_order"))
    counts = df.groupBy(day).agg(*[
        F.count(F.when(F.col(hour) == h, F.col(counted))).alias(f"h{h:02d}") for h in range(24)])
    return days.join(counts, day, "left").fillna(0).orderBy("day_order")


def share_by(df: DataFrame, key: str, column: str, values: Sequence[str], weight: str | None = None) -> DataFrame:
    """Percentage of each listed value among the non-null values within ``key``; absent ones 0."""
    known = df.dropna(subset=[key, column])
    return known.groupBy(key).agg(*[
        (records(weight, F.col(column) == v) / records(weight) * F.lit(100.0)).alias(f"{v.lower()}_pct")
        for v in values])


def melted(df: DataFrame, key: str, columns: Sequence[str], variable: str = "variable",
           value: str = "value") -> DataFrame:
    return df.unpivot([key], list(columns), variable, value)


def authority_ranking(df: DataFrame, authority: str, counted: str, top: int | None = None,
                      weight: str | None = None) -> DataFrame:
    """Areas by number of records, with the worst outcomes and casualties; ``top`` keeps the first."""
    ranked = (df.dropna(subset=[authority]).groupBy(authority)
              .agg(records(weight, F.col(counted).isNotNull()).alias("total_accidents"),
                   records(weight, F.col("severity_name") == "Fatal").alias("fatalities"),
                   records(weight, F.col("severity_name") == "Serious").alias("serious"),
                   F.sum("number_of_casualties").alias("total_casualties"))
              .orderBy(F.desc("total_accidents"), authority))
    return ranked if top is None else ranked.limit(top)


def hierarchy_counts(df: DataFrame, outer: str, inner: str, weight: str | None = None) -> DataFrame:
    """Counts of (outer, inner) and of outer alone, told apart by ``level`` (2 and 1)."""
    pairs = cross_counts(df, outer, inner, weight=weight)
    return (pairs.rollup(outer, inner).agg(F.sum("records").alias("records"),
                                           F.grouping_id().alias("_g"))
            .where("_g < 3")
            .select(outer, inner, (F.lit(2) - F.col("_g")).cast("int").alias("level"), "records"))


def centroid(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude",
             default: tuple[float, float] = (52.5, -1.5), weight: str | None = None) -> DataFrame:
    def mean(column: str) -> Column:
        if weight is None:
            return F.avg(column)
        known = F.sum(F.when(F.col(column).isNotNull(), F.col(weight)).otherwise(0))
        return F.try_divide(F.sum(F.col(column) * F.col(weight)), known)

    return df.agg(F.coalesce(mean(latitude), F.lit(default[0])).alias("mid_latitude"),
                  F.coalesce(mean(longitude), F.lit(default[1])).alias("mid_longitude"))


def hex_density(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude",
                radius_m: float = 5000.0, weight: str | None = None) -> DataFrame:
    cells = hex_cell(F.col(latitude), F.col(longitude), radius_m)
    return (df.dropna(subset=[latitude, longitude])
            .groupBy(*[c.alias(name) for name, c in cells.items()])
            .agg(records(weight).alias("records")))


def class_shares(df: DataFrame, split: str, column: str) -> DataFrame:
    """Share of each class within its split, to 4 digits; the totals come from the class counts."""
    counts = df.dropna(subset=[column]).groupBy(split, column).agg(F.count("*").alias("records"))
    totals = counts.groupBy(split).agg(F.sum("records").alias("_total"))
    return (counts.join(totals, split)
            .select(split, column, "records", F.bround(F.col("records") / F.col("_total"), 4).alias("share")))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights N / (K * n)."""
    counts = df.groupBy(label).agg(F.count("*").alias("records"))
    whole = counts.agg(F.sum("records").alias("_n"), F.count("*").alias("_k"))
    # ``whole`` is one row by construction.
    return counts.join(F.broadcast(whole)).select(
        label, "records", (F.col("_n") / (F.col("_k") * F.col("records"))).alias("class_weight"))


def at_least(df: DataFrame, n: int) -> bool:
    """Whether there are ``n`` rows, reading no more than that."""
    return df.limit(n).count() >= n


def best_row(df: DataFrame, measure: str, sequence: str) -> DataFrame:
    """The row with the greatest measure, the first in sequence among equals."""
    return df.orderBy(F.desc(measure), sequence).limit(1)
