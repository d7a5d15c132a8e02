"""Declared table layouts of the incident warehouse and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampType()
COORD, SMALL_DEC, WIDE_DEC = T.DecimalType(10, 6), T.DecimalType(5, 2), T.DecimalType(8, 2)


def _layout(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Column names of the published collision file, in file order.
COLLISION_FILE_COLUMNS = [
    "collision_index", "collision_year", "collision_ref_no", "location_easting_osgr",
    "location_northing_osgr", "longitude", "latitude", "police_force", "collision_severity",
    "number_of_vehicles", "number_of_casualties", "date", "day_of_week", "time",
    "local_authority_district", "local_authority_ons_district", "local_authority_highway",
    "local_authority_highway_current", "first_road_class", "first_road_number", "road_type",
    "speed_limit", "junction_detail_historic", "junction_detail", "junction_control",
    "second_road_class", "second_road_number", "pedestrian_crossing_human_control_historic",
    "pedestrian_crossing_physical_facilities_historic", "pedestrian_crossing", "light_conditions",
    "weather_conditions", "road_surface_conditions", "special_conditions_at_site",
    "carriageway_hazards_historic", "carriageway_hazards", "urban_or_rural_area",
    "did_police_officer_attend_scene_of_accident", "trunk_road_flag", "lsoa_of_accident_location",
    "enhanced_severity_collision", "collision_injury_based", "collision_adjusted_severity_serious",
    "collision_adjusted_severity_slight",
]

# File column -> staging column, in staging order.
COLLISION_TO_STAGING = {
    "collision_index": "accident_index",
    "date": "accident_date",
    "time": "accident_time",
    "latitude": "latitude",
    "longitude": "longitude",
    "collision_severity": "accident_severity",
    "number_of_vehicles": "number_of_vehicles",
    "number_of_casualties": "number_of_casualties",
    "speed_limit": "speed_limit",
    "road_type": "road_type",
    "light_conditions": "light_conditions",
    "weather_conditions": "weather_conditions",
    "road_surface_conditions": "road_surface_conditions",
    "urban_or_rural_area": "urban_or_rural_area",
    "local_authority_district": "local_authority",
}

INGESTION_AUDIT = _layout(
    ("batch_id", S), ("source_name", S), ("file_or_endpoint", S), ("status", S),
    ("records_ingested", I), ("records_rejected", I), ("started_at", TS), ("completed_at", TS),
    ("error_message", S),
)

# ``arrival`` is unique in a batch and follows the lines within a block of a source file, so the
# columns of READING_ORDER put all rows in the order of their files and lines.
READING_ORDER = ["ingested_at", "batch_id", "source_file", "source_block", "arrival"]
STG_INCIDENTS = _layout(
    ("accident_index", S), ("accident_date", S), ("accident_time", S), ("latitude", COORD),
    ("longitude", COORD), ("accident_severity", S), ("number_of_vehicles", I),
    ("number_of_casualties", I), ("speed_limit", I), ("road_type", S), ("light_conditions", S),
    ("weather_conditions", S), ("road_surface_conditions", S), ("urban_or_rural_area", S),
    ("local_authority", S), ("ingested_at", TS), ("source_file", S), ("source_block", L), ("arrival", L),
    ("batch_id", S),
)

STG_WEATHER = _layout(
    ("weather_timestamp", TS), ("latitude", COORD), ("longitude", COORD),
    ("temperature_2m", SMALL_DEC), ("precipitation", SMALL_DEC), ("wind_speed_10m", SMALL_DEC),
    ("visibility", WIDE_DEC), ("weather_code", I), ("weather_description", S),
    ("ingested_at", TS), ("batch_id", S),
)

QUARANTINE = _layout(
    ("rejection_id", L), ("source_entity", S), ("record_identifier", S), ("rejection_reason", S),
    ("raw_payload", S), ("rejected_at", TS), ("arrival", L), ("batch_id", S),
)

DIM_DATE = _layout(
    ("date_key", I), ("full_date", T.DateType()), ("year", I), ("quarter", I), ("month", I),
    ("month_name", S), ("day_of_month", I), ("day_of_week", I), ("day_name", S), ("is_weekend", B),
    ("hour", I), ("time_of_day", S),
)

DIM_LOCATION = _layout(
    ("location_key", L), ("latitude", COORD), ("longitude", COORD), ("urban_or_rural", S),
    ("local_authority", S), ("region", S),
)

DIM_ROAD = _layout(
    ("road_key", L), ("road_type", S), ("speed_limit", I), ("light_conditions", S),
    ("road_surface_conditions", S),
)

DIM_WEATHER = _layout(
    ("weather_key", L), ("weather_condition", S), ("temperature_c", SMALL_DEC),
    ("precipitation_mm", SMALL_DEC), ("visibility_m", WIDE_DEC), ("wind_speed_kmh", SMALL_DEC),
    ("weather_risk_level", S),
)

DIM_SEVERITY = _layout(
    ("severity_key", I), ("severity_code", I), ("severity_name", S), ("severity_description", S),
)

FACT_INCIDENTS = _layout(
    ("accident_key", L), ("accident_index", S), ("date_key", I), ("location_key", L),
    ("road_key", L), ("weather_key", L), ("severity_key", I), ("number_of_vehicles", I),
    ("number_of_casualties", I), ("created_at", TS), ("date_month", I),
)

# Blocks of the Bloom filters over accident_index, by month and load.
FACT_FILTERS = _layout(
    ("segment", S), ("blocks", L), ("block", L), *[(f"w{k}", L) for k in range(8)], ("date_month", I),
)

EXPERIMENT_RUNS = _layout(
    ("run_name", S), ("params", T.MapType(S, S)), ("metrics", T.MapType(S, D)),
    ("tags", T.MapType(S, S)), ("logged_at", TS),
)

# The severity dimension.
SEVERITY_ROWS = [
    (1, 1, "Fatal", "Accidents involving at least one fatality"),
    (2, 2, "Serious", "Accidents involving severe/hospitalizing injuries"),
    (3, 3, "Slight", "Accidents involving minor or slight injuries"),
]


def severity_rows(spark: SparkSession) -> DataFrame:
    """The severity dimension as inline rows, whose size the planner knows."""
    rows = ", ".join(f"({key}, {code}, '{name}', '{text}')" for key, code, name, text in SEVERITY_ROWS)
    names = ", ".join(DIM_SEVERITY.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS severity({names})")


TABLES = {
    "ingestion_audit": INGESTION_AUDIT,
    "stg_incidents": STG_INCIDENTS,
    "stg_weather": STG_WEATHER,
    "quarantine": QUARANTINE,
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "dim_road": DIM_ROAD,
    "dim_weather": DIM_WEATHER,
    "dim_severity": DIM_SEVERITY,
    "fact_incidents": FACT_INCIDENTS,
    "fact_filters": FACT_FILTERS,
    "experiment_runs": EXPERIMENT_RUNS,
}

PARTITIONED_BY = {
    "fact_incidents": ["date_month"],
    "fact_filters": ["date_month"],
    "stg_incidents": ["batch_id"],
    "stg_weather": ["batch_id"],
    "quarantine": ["batch_id"],
}

# Model inputs and the class coding (0 is the majority class).
NUMERIC_FEATURES = [
    "hour", "speed_limit", "temperature_c", "precipitation_mm", "visibility_m", "wind_speed_kmh",
    "number_of_vehicles", "number_of_casualties", "hour_sin", "hour_cos",
]
CATEGORICAL_FEATURES = [
    "day_name", "time_of_day", "urban_or_rural", "road_type", "light_conditions",
    "road_surface_conditions", "weather_condition",
]
CLASS_LABELS = ["Slight", "Serious", "Fatal"]
CLASS_SEVERITY_CODES = [3, 2, 1]
