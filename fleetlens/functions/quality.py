"""Row-level data quality: flags, missing count, score, validity. Narrow projections only."""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import OutlierRule, QualityRules, RangeRule


def range_flag(rule: RangeRule) -> Column:
    value = F.col(rule.column)
    return F.coalesce(value.between(rule.low, rule.high), F.lit(True))


def threshold_outlier(rule: OutlierRule) -> Column:
    exceeded = reduce(or_, [F.col(c) > limit for c, limit in rule.limits])
    return F.coalesce(exceeded, F.lit(False))


def missing_count(columns: tuple[str, ...]) -> Column:
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns])


def _points(condition: Column, points: int) -> Column:
    return condition.cast("int") * F.lit(points)


def add_quality(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """All quality columns, one projection per dependency level."""
    gates = [r for r in rules.ranges if r.gates]
    flagged = df.withColumns(
        {r.flag: range_flag(r) for r in rules.ranges}
        | {r.flag: threshold_outlier(r) for r in rules.outliers}
        | {"missing_count": missing_count(rules.critical)}
    )
    in_range = reduce(and_, [F.col(r.flag) for r in gates])
    suspicious = reduce(or_, [~in_range] + [F.col(r.flag) for r in rules.outliers])
    deductions = reduce(
        add,
        [_points(~F.col(r.flag), r.penalty) for r in gates]
        + [_points(F.col(r.flag), r.penalty) for r in rules.outliers]
        + [F.col("missing_count") * rules.missing_penalty],
    )
    scored = flagged.withColumns(
        {
            "has_missing": F.col("missing_count") > 0,
            "is_sensor_anomaly": suspicious,
            "quality_score": F.greatest(F.lit(100) - deductions, F.lit(0)),
        }
    )
    return scored.withColumn("is_valid_record", in_range & (F.col("quality_score") >= rules.pass_mark))
