"""Star-schema build: gate, dimensions, key lookups, facts, marts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadledger.functions.calendar import UNPARSED_TIME, calendar_columns, incident_time
from roadledger.functions.severity import severity_code
from roadledger.functions.weather import inferred_columns
from roadledger.operators import aggregates
from roadledger.operators.dedup import distinct_rows, keep_first
from roadledger.operators.gate import Rule, accounting, envelopes, incident_gate, passed
from roadledger.operators.joins import attach_weather, lookup_key, null_safe_match, only_new, sized_join, star_join
from roadledger.operators.ordering import number_rows
from roadledger.operators.skipping import key_filters, only_new_by_filters
from roadledger.schemas import READING_ORDER
from roadledger.session import side_by_side, written
from roadledger.sources.collisions import PLACE
from roadledger.sources.reports import save_quarantine_summary
from roadledger.sources.warehouse import Warehouse

REGION = "UK Region"
ROAD_KEY_COLUMNS = ["road_type", "speed_limit", "light_conditions", "road_surface_conditions"]
FACT_COLUMNS = ["accident_index", "date_key", "location_key", "road_key", "weather_key", "severity_key",
                "number_of_vehicles", "number_of_casualties"]
LOCATION_KEY_COLUMNS = ["latitude", "longitude", "urban_or_rural", "local_authority"]


def prepared(valid: DataFrame, day_first: bool = True, fallback: str | None = UNPARSED_TIME) -> DataFrame:
    """Valid incidents with their time, date key and severity key."""
    timed = valid.withColumn("dt", incident_time(
        F.col("accident_date"), F.col("accident_time"), day_first, fallback))
    return timed.withColumns({
        "date_key": calendar_columns(F.col("dt"))["date_key"],
        "severity_key": severity_code(F.col("accident_severity"))})


def date_rows(incidents: DataFrame) -> DataFrame:
    """One row per hour; everything else follows from the key, so only keys are made distinct."""
    parts = {"year": "date_key div 1000000", "month": "date_key div 10000 % 100",
             "day": "date_key div 100 % 100", "hour": "date_key % 100"}
    start = F.expr("make_timestamp_ntz({year}, {month}, {day}, {hour}, 0, 0)".format(
        **{name: f"cast({e} as int)" for name, e in parts.items()}))
    hours = incidents.select("date_key").distinct().withColumn("_start", start)
    derived = calendar_columns(F.col("_start")) | {"date_key": F.col("date_key")}
    return hours.select(*[c.alias(name) for name, c in derived.items()])


def location_rows(incidents: DataFrame, region: str = REGION) -> DataFrame:
    places = incidents.select("latitude", "longitude", F.col("urban_or_rural_area").alias("urban_or_rural"),
                              "local_authority")
    return distinct_rows(places, LOCATION_KEY_COLUMNS).withColumn("region", F.lit(region))


def road_rows(incidents: DataFrame) -> DataFrame:
    return distinct_rows(incidents, ROAD_KEY_COLUMNS)


def weather_rows(incidents: DataFrame) -> DataFrame:
    """One row per condition text with its inferred attributes."""
    conditions = incidents.select(F.col("weather_conditions").alias("weather_condition")).distinct()
    return conditions.select("weather_condition", *[
        c.alias(name) for name, c in inferred_columns(F.col("weather_condition")).items()])


def with_keys(rows: DataFrame, key: str, order: list[str], after: int = 0) -> DataFrame:
    """Dense surrogate keys following ``after`` in natural-key order."""
    return number_rows(rows, [F.col(c) for c in order], name=key, start=after + 1)


def extend_dimension(warehouse: Warehouse, table: str, rows: DataFrame, key: str | None,
                     natural: list[str]) -> None:
    """Insert-or-ignore into a dimension, numbering the new rows after the greatest key."""
    fresh = only_new(rows, warehouse.read(table), natural)
    if key is not None:
        fresh = with_keys(fresh, key, natural, warehouse.max_key(table, key))
    warehouse.append(table, fresh)


def with_dimension_keys(incidents: DataFrame, locations: DataFrame, roads: DataFrame, weather: DataFrame,
                        full_location_key: bool = False) -> DataFrame:
    """Adds location, road and weather keys; unmatched rows get key 1."""
    place = {"latitude": "latitude", "longitude": "longitude"}
    if full_location_key:
        place |= {"urban_or_rural_area": "urban_or_rural", "local_authority": "local_authority"}
    keyed = lookup_key(incidents, locations, place, "location_key", null_safe=full_location_key)
    keyed = lookup_key(keyed, roads, {c: c for c in ROAD_KEY_COLUMNS}, "road_key", null_safe=True)
    return lookup_key(keyed, weather, {"weather_conditions": "weather_condition"}, "weather_key", null_safe=True)


def fact_rows(keyed: DataFrame, order: Sequence[str] = READING_ORDER) -> DataFrame:
    """One row per accident index, the first in reading order."""
    return keep_first(keyed.select(*FACT_COLUMNS, *order), ["accident_index"], list(order)).select(*FACT_COLUMNS)


def numbered_facts(facts: DataFrame, after: int) -> DataFrame:
    """Unique, increasing keys without ordering the facts; they leave gaps like a sequence does."""
    return facts.withColumns({
        "accident_key": F.lit(after + 1).cast("bigint") + F.monotonically_increasing_id(),
        "date_month": month_of(F.col("date_key")), "created_at": F.current_timestamp()})


def month_of(date_key: Column) -> Column:
    """The month that facts are stored by."""
    return F.floor(date_key / 10000).cast("int")


def add_fact_filters(warehouse: Warehouse, rows: DataFrame) -> None:
    """A segment of the Bloom filters over ``rows`` (accident_index, date_month). It is written before the facts: a load
    that ends in between leaves bits too many, never too few."""
    segment = key_filters(rows, ["accident_index"], "date_month", uuid.uuid4().hex)
    warehouse.append("fact_filters", segment.hint("rebalance", "date_month"))


def not_yet_facts(warehouse: Warehouse, incidents: DataFrame) -> DataFrame:
    """Incidents whose index is no fact; only months whose filters may hold one are read."""
    facts, filters = warehouse.read("fact_incidents"), warehouse.read("fact_filters")
    if filters.isEmpty():
        if facts.isEmpty():
            return incidents
        # Facts from before there were filters.
        add_fact_filters(warehouse, facts.select("accident_index", "date_month"))
        filters = warehouse.read("fact_filters")
    return only_new_by_filters(incidents, facts, filters, ["accident_index"], "date_month")


def validate_and_quarantine(warehouse: Warehouse, batch_id: str | None = None,
                            report_folder: str | None = None, strict_dates: bool = False,
                            day_first: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """Gate of the staged rows: writes the quarantine and its summary, returns valid rows and counts.

    The judged rows are written once, because the valid part feeds every dimension. Rows of a batch
    already in quarantine are not written again.
    """
    extra = []
    if strict_dates:
        unreadable = incident_time(F.col("accident_date"), F.col("accident_time"), day_first, None).isNull()
        extra = [Rule("UNPARSEABLE_DATETIME", "Accident date or time is no real time", unreadable)]
    staged = warehouse.read("stg_incidents", batch_id)
    gated = written(incident_gate(staged, order=READING_ORDER, extra_rules=extra), "gated")
    counts = accounting(gated).first().asDict()
    if counts["rejected"]:
        payload = [c for c in staged.columns if c not in PLACE]
        records = envelopes(gated, "stg_accidents_raw", "accident_index", payload, ordinal="arrival")
        fresh = only_new(records, warehouse.read("quarantine", batch_id), ["batch_id", "arrival"])
        base = warehouse.max_key("quarantine", "rejection_id")
        warehouse.append("quarantine", fresh.withColumns({
            "rejection_id": F.lit(base + 1).cast("bigint") + F.monotonically_increasing_id(),
            "rejected_at": F.current_timestamp()}))
        if report_folder:
            save_quarantine_summary(gated, report_folder)
    return passed(gated), counts


def load_star(warehouse: Warehouse, valid: DataFrame, day_first: bool = True,
              full_location_key: bool = False, unique: bool = False) -> None:
    """Dimensions and facts from valid rows; loading the same rows again changes nothing.

    ``unique`` says that no accident index repeats, as in rows from the gate, and saves the
    shuffle that would make sure of it.
    """
    incidents = prepared(valid, day_first)
    side_by_side(
        lambda: extend_dimension(warehouse, "dim_date", date_rows(incidents), None, ["date_key"]),
        lambda: extend_dimension(warehouse, "dim_location", location_rows(incidents), "location_key", LOCATION_KEY_COLUMNS),
        lambda: extend_dimension(warehouse, "dim_road", road_rows(incidents), "road_key", ROAD_KEY_COLUMNS),
        lambda: extend_dimension(warehouse, "dim_weather", weather_rows(incidents), "weather_key", ["weather_condition"]))
    # Rows that are facts already leave before any lookup, so a repeated load looks up nothing.
    fresh = written(not_yet_facts(warehouse, incidents), "fresh")
    if fresh.isEmpty():
        return
    add_fact_filters(warehouse, fresh.select("accident_index", month_of(F.col("date_key")).alias("date_month")))
    keyed = with_dimension_keys(fresh, warehouse.read("dim_location"), warehouse.read("dim_road"),
                                warehouse.read("dim_weather"), full_location_key)
    facts = keyed.select(*FACT_COLUMNS) if unique else fact_rows(keyed)
    numbered = numbered_facts(facts, warehouse.max_key("fact_incidents", "accident_key"))
    # Months together, so that each gets few files; a month of many rows is split again by size.
    warehouse.append("fact_incidents", numbered.hint("rebalance", "date_month"))


# The columns of each star projection, by dimension.
VIEW_COLUMNS: Mapping[str, list[str]] = {
    "dim_date": ["full_date", "year", "month", "day_of_week", "hour", "is_weekend", "time_of_day"],
    "dim_location": ["latitude", "longitude", "urban_or_rural"],
    "dim_road": ROAD_KEY_COLUMNS,
    "dim_weather": ["weather_condition", "temperature_c", "precipitation_mm", "visibility_m", "wind_speed_kmh"],
    "dim_severity": ["severity_code", "severity_name"],
}
TRAINING_COLUMNS = {**VIEW_COLUMNS,
                    "dim_date": ["full_date", "year", "month", "day_name", "hour", "is_weekend", "time_of_day"]}
DASHBOARD_COLUMNS = {**TRAINING_COLUMNS,
                     "dim_location": ["latitude", "longitude", "urban_or_rural", "local_authority"],
                     "dim_weather": [*VIEW_COLUMNS["dim_weather"], "weather_risk_level"]}
DRIFT_COLUMNS = {
    "dim_date": ["full_date"], "dim_location": ["latitude", "longitude"], "dim_road": ["speed_limit"],
    "dim_weather": ["temperature_c", "precipitation_mm", "wind_speed_kmh"], "dim_severity": ["severity_name"]}
FACT_MEASURES = ["accident_index", "number_of_vehicles", "number_of_casualties"]
DIMENSION_KEYS = {"dim_date": "date_key", "dim_location": "location_key", "dim_road": "road_key",
                  "dim_weather": "weather_key", "dim_severity": "severity_key"}


def star(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]],
         measures: list[str] = FACT_MEASURES) -> DataFrame:
    """Facts joined to the dimensions named in ``columns``; any subset of dimensions may be named."""
    dims = [(tables[d], DIMENSION_KEYS[d], cols) for d, cols in columns.items()]
    return star_join(tables["fact_incidents"], dims, measures)


def summed_star(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]], by: Sequence[str] = (),
                sums: Sequence[str] = ()) -> DataFrame:
    """The star added up by foreign keys (and the fact columns ``by``) before any dimension is joined:
    ``records`` and ``sums`` per combination."""
    dims = [(tables[d], DIMENSION_KEYS[d], cols) for d, cols in columns.items()]
    summed = aggregates.pre_summed(tables["fact_incidents"], [*[key for _, key, _ in dims], *by], sums)
    return star_join(summed, dims, [*by, "records", *sums])


def pair_counts(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Counts of several pairs of dashboard or fact columns: (first_name, second_name, first_value,
    second_value, records), values as text.

    One pass over the facts counts each pair by its two keys, added up before the shuffle; dimensions
    are joined to those counts only.
    """
    place = {c: d for d, columns in DASHBOARD_COLUMNS.items() for c in columns}
    keys = {c: DIMENSION_KEYS[place[c]] if c in place else c for pair in pairs for c in pair}
    entries = F.array(*[F.struct(F.lit(n).alias("pair"), F.col(keys[a]).cast("bigint").alias("first"),
                                 F.col(keys[b]).cast("bigint").alias("second")) for n, (a, b) in enumerate(pairs)])
    counted = written(tables["fact_incidents"].select(F.explode(entries).alias("e")).groupBy("e.pair", "e.first", "e.second")
                      .agg(F.count("*").alias("records")), "pair_counts")
    parts = []
    for n, pair in enumerate(pairs):
        part = counted.where(F.col("pair") == n).drop("pair")
        for side, column in zip(("first", "second"), pair):
            if column in place:
                values = tables[place[column]].select(F.col(keys[column]).cast("bigint").alias(side), F.col(column).alias(f"{side}_value"))
                part = sized_join(part, values, [side], hot=[])
            else:
                part = part.withColumn(f"{side}_value", F.col(side))
        named = [F.col(f"{side}_value").cast("string").alias(f"{side}_value") for side in ("first", "second")]
        part = part.select(*named, "records").dropna().groupBy("first_value", "second_value").agg(F.sum("records").alias("records"))
        parts.append(part.select(F.lit(pair[0]).alias("first_name"), F.lit(pair[1]).alias("second_name"), "first_value",
                                 "second_value", "records"))
    return reduce(DataFrame.unionByName, parts)


def star_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.read(name) for name in ["fact_incidents", *DIMENSION_KEYS]}


# Facts added up by month and foreign keys: what a refresh keeps of months that did not change.
MONTH_SUMS = {"sum_hourly": aggregates.hourly_sums, "sum_weather_road": aggregates.weather_road_sums,
              "sum_hotspots": aggregates.hotspot_sums}


def marts(tables: Mapping[str, DataFrame], sums: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three marts, from the sums by month."""
    severities = tables["dim_severity"]
    return {
        "agg_hourly_severity_mart": aggregates.hourly_severity_mart_of(sums["sum_hourly"], tables["dim_date"], severities),
        "agg_weather_road_risk_mart": aggregates.weather_road_mart_of(
            sums["sum_weather_road"], tables["dim_weather"], tables["dim_road"], severities),
        "agg_location_hotspots_mart": aggregates.hotspot_mart_of(sums["sum_hotspots"], tables["dim_location"], severities),
    }


def stale_months(facts: DataFrame, sums: DataFrame | None) -> list[int | None]:
    """Months whose facts are more than their sums hold. Facts are only ever added, so the numbers tell; they come
    from the partitions of the files, and a calendar has few months."""
    held = facts.groupBy("date_month").agg(F.count("*").alias("n"))
    if sums is not None:
        done = sums.groupBy("date_month").agg(F.sum("records").alias("n"))
        held = held.join(F.broadcast(done), null_safe_match(held, done, ["date_month", "n"]), "left_anti")
    return [row["date_month"] for row in held.select("date_month").collect()]


def refresh_marts(warehouse: Warehouse) -> None:
    """Adds up the facts of the months that changed, then rebuilds the marts from the sums of all months."""
    tables = star_tables(warehouse)
    facts = tables["fact_incidents"]
    # The least sum is written last: it says which months the others hold.
    known = warehouse.read_mart("sum_hourly") if warehouse.has_mart("sum_hourly") else None
    months = stale_months(facts, known)
    if months:
        named = [m for m in months if m is not None]
        changed = F.col("date_month").isin(named) | (F.col("date_month").isNull() if None in months else F.lit(False))
        first, *others = MONTH_SUMS.items()
        side_by_side(*[partial(warehouse.replace_months, name, add(facts.where(changed), ["date_month"])) for name, add in others])
        warehouse.replace_months(first[0], first[1](facts.where(changed), ["date_month"]))
    if warehouse.has_mart("sum_hourly"):
        sums = {name: warehouse.read_mart(name) for name in MONTH_SUMS}
    else:
        sums = {name: add(facts) for name, add in MONTH_SUMS.items()}
    side_by_side(*[partial(warehouse.save_mart, name, mart) for name, mart in marts(tables, sums).items()])
    star(tables, VIEW_COLUMNS).createOrReplaceTempView("v_model_training_dataset")


def with_site_weather(incidents: DataFrame, readings: DataFrame) -> DataFrame:
    """Measured hourly weather of each incident, inferred values where there is no reading."""
    inferred: Mapping[str, Column] = inferred_columns(F.col("weather_conditions"))
    measured = readings.select(
        "latitude", "longitude", "weather_timestamp",
        F.col("temperature_2m").cast("double").alias("temperature_c"),
        F.col("precipitation").cast("double").alias("precipitation_mm"),
        F.col("visibility").cast("double").alias("visibility_m"),
        F.col("wind_speed_10m").cast("double").alias("wind_speed_kmh"))
    names = ["temperature_c", "precipitation_mm", "visibility_m", "wind_speed_kmh"]
    return attach_weather(incidents, measured, "dt", names, inferred)


def run_etl(warehouse: Warehouse, batch_id: str | None = None, report_folder: str | None = None,
            strict_dates: bool = False, day_first: bool = True) -> dict[str, int]:
    """Gate, star load and mart refresh of the staged rows; returns the gate's counts."""
    warehouse.init()
    valid, counts = validate_and_quarantine(warehouse, batch_id, report_folder, strict_dates, day_first)
    if counts["valid"]:
        load_star(warehouse, valid, day_first, unique=True)
        refresh_marts(warehouse)
    return counts
