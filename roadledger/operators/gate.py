"""Ordered data-quality gate: one reason per rejected row, the first rule that fails."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from roadledger.operators.dedup import flag_repeats


@dataclass(frozen=True)
class Rule:
    """``failed`` is true where a row breaks the rule; a null counts as not failed."""

    code: str
    message: str
    failed: Column

    @property
    def reason(self) -> str:
        return f"{self.code}: {self.message}"


# Bounds, accepted codes and messages of the incident rules.
LATITUDE_BOUNDS = (49.0, 61.5)
LONGITUDE_BOUNDS = (-8.5, 2.5)
MAX_SPEED = 100
MIN_DATE_LENGTH = 8
SEVERITY_SPELLINGS = ["1", "2", "3", "Fatal", "Serious", "Slight"]
MESSAGES = {
    "INVALID_COORDINATES": "Lat/Lon out of plausible geographic bounds",
    "MISSING_DATETIME": "Accident date is null or invalid format",
    "INVALID_SPEED_LIMIT": "Speed limit not in range [10, 100]",
    "INVALID_SEVERITY": "Severity not mapped to 1, 2, or 3",
    "DUPLICATE_ACCIDENT_INDEX": "Duplicate key collision",
}


def outside(value: Column, low: float, high: float) -> Column:
    """Null, NaN or out of the closed range."""
    number = value.cast("double")
    return number.isNull() | F.isnan(number) | (number < low) | (number > high)


def incident_rules(repeat_flag: str = "is_repeat", lowest_speed: int | None = None) -> list[Rule]:
    """The five rules in order. Speeds above 0 pass unless ``lowest_speed`` asks for more."""
    speed = F.col("speed_limit")
    slow = speed <= 0 if lowest_speed is None else speed < lowest_speed
    checks = {
        "INVALID_COORDINATES": outside(F.col("latitude"), *LATITUDE_BOUNDS)
        | outside(F.col("longitude"), *LONGITUDE_BOUNDS),
        "MISSING_DATETIME": F.col("accident_date").isNull()
        | (F.length("accident_date") < MIN_DATE_LENGTH),
        "INVALID_SPEED_LIMIT": speed.isNull() | slow | (speed > MAX_SPEED),
        "INVALID_SEVERITY": F.col("accident_severity").isNull()
        | ~F.col("accident_severity").cast("string").isin(SEVERITY_SPELLINGS),
        "DUPLICATE_ACCIDENT_INDEX": F.col(repeat_flag),
    }
    return [Rule(code, MESSAGES[code], failed) for code, failed in checks.items()]


def first_failure(rules: Sequence[Rule]) -> Column:
    """Reason of the first failing rule, null for a row that passes them all."""
    chain = None
    for rule in rules:
        chain = F.when(rule.failed, rule.reason) if chain is None else chain.when(rule.failed, rule.reason)
    return chain


def gate(df: DataFrame, rules: Sequence[Rule], reason: str = "rejection_reason") -> DataFrame:
    return df.withColumn(reason, first_failure(rules))


def incident_gate(staged: DataFrame, key: str = "accident_index", order: Sequence[str] = ("arrival",),
                  row_id: Sequence[str] = ("batch_id", "arrival"), lowest_speed: int | None = None,
                  extra_rules: Sequence[Rule] = ()) -> DataFrame:
    """Staged incidents with a rejection reason; repeats are judged over all rows read."""
    flagged = flag_repeats(staged, [key], order, row_id)
    return gate(flagged, [*incident_rules(lowest_speed=lowest_speed), *extra_rules]).drop("is_repeat")


def passed(gated: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    return gated.where(F.col(reason).isNull()).drop(reason)


def failed(gated: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    return gated.where(F.col(reason).isNotNull())


def accounting(gated: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """One row: total = valid + rejected."""
    return gated.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(reason).isNull()).alias("valid"),
        F.count(reason).alias("rejected"))


def reason_counts(gated: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    return failed(gated, reason).groupBy(reason).agg(F.count("*").alias("records"))


def envelopes(gated: DataFrame, entity: str, identifier: str | None, payload: Sequence[str],
              ordinal: str | None = None, reason: str = "rejection_reason") -> DataFrame:
    """Rejected rows as quarantine records: identifier, reason and the row as JSON with its nulls."""
    rejected = failed(gated, reason)
    if identifier in rejected.columns:
        name = F.coalesce(F.col(identifier).cast("string"), F.lit("None"))
    else:
        name = F.concat(F.lit("ROW_"), F.col(ordinal).cast("string"))
    batch = F.col("batch_id") if "batch_id" in rejected.columns else F.lit("UNKNOWN")
    return rejected.select(
        F.lit(entity).alias("source_entity"),
        name.alias("record_identifier"),
        F.col(reason),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("raw_payload"),
        *([F.col(ordinal)] if ordinal else []),
        batch.alias("batch_id"))


# Scoring input bounds and defaults of absent fields.
SCORING_DEFAULTS = {
    "day_name": "Friday", "time_of_day": "Evening Rush", "urban_or_rural": "Urban",
    "road_type": "Single carriageway", "speed_limit": 30, "light_conditions": "Daylight",
    "road_surface_conditions": "Dry", "weather_condition": "Fine no high winds",
    "temperature_c": 12.0, "precipitation_mm": 0.0, "visibility_m": 10000.0,
    "wind_speed_kmh": 15.0, "number_of_vehicles": 2, "number_of_casualties": 1,
}
SCORING_BOUNDS = {
    "hour": (0, 23), "latitude": LATITUDE_BOUNDS, "longitude": LONGITUDE_BOUNDS,
    "speed_limit": (10, 100), "number_of_vehicles": (1, 20), "number_of_casualties": (1, 20),
}


def scoring_input(df: DataFrame) -> DataFrame:
    """Fills absent fields with their defaults and adds the reason of the first bound broken."""
    filled = df
    for name, default in SCORING_DEFAULTS.items():
        value = F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        filled = filled.withColumn(name, value)
    rules = [Rule("INVALID_" + name.upper(), f"{name} not in [{low}, {high}]", outside(F.col(name), low, high))
             for name, (low, high) in SCORING_BOUNDS.items()]
    return gate(filled, rules)


def in_any(df: DataFrame, **choices: Sequence) -> DataFrame:
    """Slicers: keeps rows whose columns are in the chosen lists; an empty list keeps nothing."""
    kept = df
    for name, values in choices.items():
        kept = kept.where(F.col(name).isin(list(values)) if values else F.lit(False))
    return kept


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has a value."""
    return df.dropna(subset=list(columns))
