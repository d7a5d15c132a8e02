"""Severity codes, prediction labels, risk score and the rule-based severity estimate."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadledger.schemas import CLASS_LABELS, CLASS_SEVERITY_CODES

# Accepted severity spellings, the code of everything else, and score weights.
SEVERITY_CODES = {"1": 1, "Fatal": 1, "2": 2, "Serious": 2, "3": 3, "Slight": 3}
OTHER_SEVERITY = 3
RISK_WEIGHTS = [0.1, 0.5, 1.0]


def severity_code(value: Column) -> Column:
    pairs = [F.lit(part) for pair in SEVERITY_CODES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value.cast("string")), F.lit(OTHER_SEVERITY))


def class_index(code: Column) -> Column:
    """Severity code 3, 2, 1 -> class 0, 1, 2; any other code has no class."""
    return F.when(code.isin(CLASS_SEVERITY_CODES), F.lit(3) - code).cast("int")


def class_label(index: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(v) for v in CLASS_LABELS]), index.cast("int") + 1)


def class_severity_code(index: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(v) for v in CLASS_SEVERITY_CODES]), index.cast("int") + 1)


def risk_score(probabilities: list[Column]) -> Column:
    """Weighted sum of the class probabilities, to 4 digits, half to even."""
    total = F.lit(RISK_WEIGHTS[0]) * probabilities[0]
    for weight, p in zip(RISK_WEIGHTS[1:], probabilities[1:]):
        total = total + F.lit(weight) * p
    return F.bround(total, 4)


def probability_map(probabilities: list[Column]) -> Column:
    parts: list[Column] = []
    for label, p in zip(CLASS_LABELS, probabilities):
        parts += [F.lit(label), F.bround(p, 4)]
    return F.create_map(*parts)


def arg_max(values: list[Column]) -> Column:
    """Index of the greatest value, the lowest one on ties."""
    top = F.greatest(*values)
    chain = F.when(values[0] == top, 0)
    for i, v in enumerate(values[1:], start=1):
        chain = chain.when(v == top, i)
    return chain


def rule_probabilities(casualties: Column, speed: Column, vehicles: Column, light: Column,
                       weather: Column) -> list[Column]:
    """Class probabilities by fixed rules, for use where no trained model is at hand."""
    cas = F.coalesce(casualties.cast("double"), F.lit(1.0))
    spd = F.coalesce(speed.cast("double"), F.lit(30.0))
    veh = F.coalesce(vehicles.cast("double"), F.lit(2.0))
    sky = F.coalesce(weather, F.lit(""))
    dark = F.when(light.contains("Dark"), 1.0).otherwise(0.0)
    foul = F.when(sky.contains("Rain") | sky.contains("Snow") | sky.contains("Fog"), 1.0).otherwise(0.0)
    load = (F.lit(0.05) + F.lit(0.12) * F.least(cas, F.lit(4.0))
            + F.lit(0.005) * F.greatest(F.lit(0.0), spd - F.lit(20.0))
            + F.lit(0.05) * F.least(veh, F.lit(4.0)) + F.lit(0.1) * dark + F.lit(0.08) * foul)
    share = load / F.lit(1.5)
    fatal = F.least(F.greatest(F.lit(0.02) + F.lit(0.25) * share, F.lit(0.01)), F.lit(0.45))
    serious = F.least(F.greatest(F.lit(0.15) + F.lit(0.35) * share, F.lit(0.10)), F.lit(0.50))
    slight = F.greatest(F.lit(0.05), F.lit(1.0) - fatal - serious)
    total = slight + serious + fatal
    return [slight / total, serious / total, fatal / total]
