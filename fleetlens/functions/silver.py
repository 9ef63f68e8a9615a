"""The Silver projection: raw readings to cleaned, scored readings, without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from fleetlens.config import SILVER_DEFAULTS, QualityRules
from fleetlens.functions.quality import add_quality
from fleetlens.functions.shaping import add_aliases, fill_defaults, nan_to_null


def silver(
    df: DataFrame, rules: QualityRules = QualityRules(), defaults: Mapping[str, float] = SILVER_DEFAULTS
) -> DataFrame:
    """NaN to null, aliases, quality columns, and only then the fills."""
    return fill_defaults(add_quality(add_aliases(nan_to_null(df)), rules), defaults)
