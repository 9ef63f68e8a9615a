"""Formulas of the turbine domain. Each returns a Column over named inputs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.config import (
    AIR_DENSITY, ALARMS, ELECTRICAL, HEALTH_LOSSES, HEALTH_MEASURED, SEVERITIES, STATES, STATUS_FLAGS,
)


def magnitude(*columns: str) -> Column:
    """Euclidean length; also the vibration RMS."""
    return F.sqrt(reduce(add, [F.col(c) * F.col(c) for c in columns]))


def vibration_magnitude() -> Column:
    return magnitude("vibration_x", "vibration_y", "vibration_z")


def thermal_stress(hot: str = "gearbox_temperature", ambient: str = "ambient_temperature") -> Column:
    return (F.col(hot) - F.col(ambient)) / 100.0


def temp_anomaly(value: str, baseline: str, spread: str) -> Column:
    """Distance from the long average in units of recent spread; the +1 keeps flat signals finite."""
    return F.abs(F.col(value) - F.col(baseline)) / (F.col(spread) + 1.0)


def load_factor(power: str = "power_output", rated_mw: float = 2.5) -> Column:
    return F.col(power) / rated_mw


def speed_ratio(generator: str = "generator_speed", rotor: str = "rotor_speed") -> Column:
    return F.when(F.col(rotor) > 0, F.col(generator) / F.col(rotor)).otherwise(0.0)


def aero_efficiency(power: str = "power_output", wind: str = "wind_speed", cut_in: float = 3.0) -> Column:
    w = F.col(wind)
    return F.when(w > cut_in, F.col(power) / (w * w * w + 0.1)).otherwise(0.0)


def health_score(losses: Sequence[tuple[str, float]] = HEALTH_LOSSES, measured: Sequence[str] = HEALTH_MEASURED) -> Column:
    """100 minus the points of the symptoms that show and of weighted measurements, floored at 0.

    Points are taken off one after the other: a sum of them rounds otherwise, and a score on the
    border of a class would fall on its other side. A null measurement floors to 0 as well; a symptom that cannot be
    judged costs nothing.
    """
    points = [F.col(what) * each if what in measured else F.when(F.expr(what), each).otherwise(0.0) for what, each in losses]
    return F.greatest(reduce(sub, points, F.lit(100.0)), F.lit(0.0))


def health_status(score: str = "health_score", healthy: float = 80, warning: float = 60) -> Column:
    return (
        F.when(F.col(score) >= healthy, "HEALTHY")
        .when(F.col(score) >= warning, "WARNING")
        .otherwise("CRITICAL")
    )


def expected_power(
    wind: str = "wind_speed",
    rated_mw: float | Column = 2.5,
    cut_in: float = 3.0,
    rated_speed: float = 12.0,
    cut_out: float = 25.0,
) -> Column:
    """Power curve: cubic between cut-in and rated speed, flat to cut-out, zero elsewhere."""
    w = F.col(wind)
    share = (w - cut_in) / (rated_speed - cut_in)
    rated = rated_mw if isinstance(rated_mw, Column) else F.lit(float(rated_mw))
    curve = F.when(w < rated_speed, rated * share * share * share).otherwise(rated)
    return F.when(w.isNull(), None).when(w.between(cut_in, cut_out), curve).otherwise(0.0)


def air_density(formula: str = AIR_DENSITY) -> Column:
    return F.expr(formula)


def derived(formulas: Mapping[str, str] = ELECTRICAL) -> dict[str, Column]:
    """What columns should hold by the others of their row."""
    return {name: F.expr(formula) for name, formula in formulas.items()}


def operating_state(rules: Sequence[tuple[str, str]] = STATES) -> Column:
    return _first_match((F.expr(condition), state) for condition, state in rules)


def status_flags(rules: Mapping[str, str] = STATUS_FLAGS) -> dict[str, Column]:
    return {name: F.expr(condition).cast("int") for name, condition in rules.items()}


def disagrees(delivered: str, expected: Column) -> Column:
    """Whether a delivered value is another than the expected one; two missing values agree."""
    return ~F.col(delivered).eqNullSafe(expected)


def _first_match(rules: Iterable[tuple[Column, str]]) -> Column:
    """The value of the first rule that holds, or null."""
    return F.coalesce(*[F.when(condition, value) for condition, value in rules])


def alarm_code(rms: Column | None = None, rules: Sequence[tuple[str, str]] = ALARMS) -> Column:
    """Highest-priority alarm, or null. `{rms} > x` compares the vibration magnitude."""
    vibration = vibration_magnitude() if rms is None else rms

    def condition(rule: str) -> Column:
        if rule.startswith("{rms} > "):
            return vibration > float(rule.removeprefix("{rms} > "))
        return F.expr(rule)

    return _first_match((condition(rule), code) for rule, code in rules)


def alarm_severity(health: str = "health_status", bounds: Sequence[tuple[float, str]] = SEVERITIES) -> Column:
    return _first_match((F.col(health) < bound, name) for bound, name in bounds)


def risk_level(probability: str, medium: float = 0.3, high: float = 0.7, include_lowest: bool = False) -> Column:
    """Right-closed bins over (0, 1]. Values outside get null; zero joins LOW only on request."""
    p = F.col(probability)
    floor = (p >= 0.0) if include_lowest else (p > 0.0)
    return (
        F.when(floor & (p <= medium), "LOW")
        .when((p > medium) & (p <= high), "MEDIUM")
        .when((p > high) & (p <= 1.0), "HIGH")
    )
