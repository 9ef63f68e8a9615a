"""One row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values by which the feed says that a sensor delivered nothing.
SENTINELS = {"wind_speed": -999.0}


def best_copy(
    df: DataFrame, keys: Sequence[str], newest: str = "ingestion_timestamp", sentinels: Mapping[str, float] = SENTINELS
) -> list[Column]:
    """Sort keys that put the best copy of a reading first.

    The newest delivery (`newest`, if there is such a column; unknown times last), then the copy
    with the fewest missing values (null, NaN or sentinel), then the one with the fewest
    sentinels. A hash of the row settles the rest, so the survivor never depends on how rows
    arrived; copies that agree in all this differ in measured values only, and none is better.
    """
    rest = [f for f in df.schema if f.name not in keys]
    named = {f.name: f"`{f.name}`" for f in rest}
    marked = [f"int(coalesce({named[f.name]} = {sentinels[f.name]!r}, false))" for f in rest if f.name in sentinels]
    missing = [f"int({c} is null)" for c in named.values()]
    missing += [f"int(isnan({named[f.name]}))" for f in rest if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    # one number: missing values count before sentinels
    packed = f"({' + '.join(missing + marked) or '0'}) * {len(rest) + 1} + {' + '.join(marked) or '0'}"
    recent = [F.col(newest).desc_nulls_last()] if newest in df.columns else []
    settled = [F.expr(f"xxhash64({', '.join(named.values())})")] if rest else []
    return [*recent, F.expr(packed), *settled]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Keeps the first row of each key by `order` (else `best_copy`); null keys form a group of their own.

    Spark keeps only the best row per key in each map task (`WindowGroupLimit`) before it
    shuffles, so a key with very many copies costs no more than any other. Rows are sorted by
    a few numbers, not by their columns.
    """
    ranked_by = list(order) if order else best_copy(df, keys)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked_by))
    return df.withColumn("__position", position).where(F.col("__position") == 1).drop("__position")


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any survivor per key, for inputs whose copies agree in what is read later."""
    return df.dropDuplicates(list(keys))
