"""Weather code, inferred attributes and risk grade expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# WMO weather interpretation codes and their texts.
WMO_DESCRIPTIONS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow fall",
    73: "Moderate snow fall",
    75: "Heavy snow fall",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    95: "Thunderstorm",
}
WMO_OTHER = "Clear / Normal"

# Attributes inferred from words of the condition text, first match wins.
INFERRED = {
    "temperature_c": ([("Fine", 14.5), ("Rain", 8.0), ("Snow", 1.5)], 10.0),
    "precipitation_mm": ([("Fine", 0.0), ("Rain", 3.5)], 1.0),
    "visibility_m": ([("Fine", 10000.0), ("Rain", 4000.0)], 800.0),
    "wind_speed_kmh": ([("Fine", 12.0), ("high winds", 28.0)], 16.0),
}


def wmo_description(code: Column) -> Column:
    pairs = [F.lit(part) for pair in WMO_DESCRIPTIONS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(WMO_OTHER))


def inferred_attribute(name: str, condition: Column) -> Column:
    """One of ``INFERRED`` from the condition text; a null text takes the default."""
    words, default = INFERRED[name]
    chain = F.when(F.lit(False), F.lit(default))
    for word, value in words:
        chain = chain.when(condition.contains(word), F.lit(value))
    return chain.otherwise(F.lit(default))


def risk_level(condition: Column, temperature: Column, precipitation: Column) -> Column:
    severe = condition.contains("Snow") | condition.contains("Ice") | (precipitation > 5.0) | (temperature < 0)
    moderate = condition.contains("Rain") | condition.contains("Fog") | (precipitation > 0.5)
    return F.when(severe, "Severe").when(moderate, "Moderate").otherwise("Low")


def inferred_columns(condition: Column) -> dict[str, Column]:
    """The four attributes and the grade of a condition text, by name."""
    columns = {name: inferred_attribute(name, condition) for name in INFERRED}
    columns["weather_risk_level"] = risk_level(
        F.coalesce(condition, F.lit("")), columns["temperature_c"], columns["precipitation_mm"])
    return columns
