"""Time-series features per machine: rolling, lag, delta and domain columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import Keys
from fleetlens.functions import domain
from fleetlens.functions.shaping import fill_zero
from fleetlens.operators.ordering import (
    CHUNK, CHUNK_SECONDS, GROUP, HALO, NO_TIME, PART, crowded, drop_chunk, drop_halo, epoch_seconds, group_key, halo_rows, running, time_chunks,
)
from fleetlens.operators.panes import deviation_of, mean_of, sliding_moments


@dataclass(frozen=True)
class Rolling:
    """`stat` is avg or stddev; `span` names one of the two look-back lengths."""

    name: str
    stat: str
    source: str
    span: str


@dataclass(frozen=True)
class Lag:
    name: str
    source: str
    rows: int


VIBRATION = "mechanical_stress_index"

# Names, sources and look-backs of the turbine preset.
ROLLING = (
    Rolling("gearbox_temp_avg_1h", "avg", "gearbox_temperature", "short"),
    Rolling("gearbox_temp_avg_6h", "avg", "gearbox_temperature", "long"),
    Rolling("generator_temp_avg_1h", "avg", "generator_temperature", "short"),
    Rolling("generator_temp_avg_6h", "avg", "generator_temperature", "long"),
    Rolling("bearing_temp_avg_1h", "avg", "bearing_temperature", "short"),
    Rolling("vibration_avg_1h", "avg", VIBRATION, "short"),
    Rolling("vibration_avg_6h", "avg", VIBRATION, "long"),
    Rolling("power_avg_1h", "avg", "power_output", "short"),
    Rolling("power_avg_6h", "avg", "power_output", "long"),
    Rolling("wind_speed_avg_1h", "avg", "wind_speed", "short"),
    Rolling("wind_speed_avg_6h", "avg", "wind_speed", "long"),
    Rolling("gearbox_temp_std_1h", "stddev", "gearbox_temperature", "short"),
    Rolling("vibration_std_1h", "stddev", VIBRATION, "short"),
    Rolling("power_std_1h", "stddev", "power_output", "short"),
)
LAGS = (
    Lag("gearbox_temp_lag_1", "gearbox_temperature", 1),
    Lag("gearbox_temp_lag_6", "gearbox_temperature", 6),
    Lag("gearbox_temp_lag_12", "gearbox_temperature", 12),
    Lag("vibration_x_lag_1", "vibration_x", 1),
    Lag("vibration_x_lag_6", "vibration_x", 6),
    Lag("power_lag_1", "power_output", 1),
    Lag("power_lag_6", "power_output", 6),
)
DELTAS = {
    "gearbox_temp_delta": ("gearbox_temperature", "gearbox_temp_lag_1"),
    "vibration_delta": ("vibration_x", "vibration_x_lag_1"),
    "power_delta": ("power_output", "power_lag_1"),
}


def with_vibration(df: DataFrame) -> DataFrame:
    """The vibration magnitude once, under the name it also has as a feature."""
    return df if VIBRATION in df.columns else df.withColumn(VIBRATION, domain.vibration_magnitude())


def windowed(
    df: DataFrame,
    keys: Keys = Keys(),
    rolling: tuple[Rolling, ...] = ROLLING,
    lags: tuple[Lag, ...] = LAGS,
    short: int = 6,
    long: int = 36,
    chunk_seconds: int = CHUNK_SECONDS,
    whole_rows: int = 0,
) -> DataFrame:
    """Rolling and lag columns over preceding rows: one shuffle and one sort of the rows for all of them.

    Frames count rows, the current one included, so a gap in the feed stretches them in time.
    Rows are spread by machine and time; a frame that begins in earlier chunks gets copies from there. Where readings are
    so sparse that copies outnumber rows, `whole_rows` keeps machines of at most so many rows in one chunk, without
    copies (`crowded` tells the others, from a count of the rows).
    """
    back = {"short": short, "long": long}
    reach = max([back[r.span] for r in rolling] + [lag.rows for lag in lags])
    sources = [r.source for r in rolling] + [lag.source for lag in lags]
    chunked = time_chunks(df, [keys.entity], keys.time, chunk_seconds)
    dense = crowded(df, keys.entity, whole_rows) if whole_rows else None
    if whole_rows:
        chunked = chunked.withColumn(CHUNK, F.lit(NO_TIME) if dense is None else F.when(dense, F.col(CHUNK)).otherwise(NO_TIME))
    framed = chunked.withColumn(HALO, F.lit(False)) if whole_rows and dense is None else halo_rows(chunked, keys.time, reach, sources, dense)
    series = Window.partitionBy(*PART).orderBy(keys.time)
    columns = {
        r.name: getattr(F, r.stat)(r.source).over(series.rowsBetween(-back[r.span], 0)) for r in rolling
    } | {lag.name: F.lag(lag.source, lag.rows).over(series) for lag in lags}
    return drop_halo(framed.withColumns(columns))


def rolling_features(df: DataFrame, keys: Keys = Keys(), stat: str | None = None, **options) -> DataFrame:
    """Rolling columns only, optionally of one statistic."""
    chosen = tuple(r for r in ROLLING if stat in (None, r.stat))
    return windowed(with_vibration(df), keys, chosen, (), **options)


def lag_features(df: DataFrame, keys: Keys = Keys(), **options) -> DataFrame:
    return windowed(df, keys, (), LAGS, **options)


def delta_features(df: DataFrame) -> DataFrame:
    """Change since the previous row; expects the lag columns."""
    return df.withColumns({name: F.col(now) - F.col(before) for name, (now, before) in DELTAS.items()})


def time_rolling(
    df: DataFrame,
    keys: Keys = Keys(),
    rolling: tuple[Rolling, ...] = ROLLING,
    short_seconds: int = 3600,
    long_seconds: int = 6 * 3600,
    pane_seconds: int | None = None,
) -> DataFrame:
    """The rolling columns over elapsed time instead of row counts, in whole seconds.

    Frames are put together from panes, by default as long as the shorter frame. A task
    holds one pane of a machine, so where even a frame outgrows a task, shorter panes do not.
    """
    spans = [short_seconds, long_seconds]
    timed = with_vibration(df).withColumns({GROUP: group_key([keys.entity]), "__sec": F.coalesce(epoch_seconds(df, keys.time), F.lit(NO_TIME))})
    sources = list(dict.fromkeys(r.source for r in rolling))
    at = {r.name: (("short", "long").index(r.span), sources.index(r.source)) for r in rolling}
    wanted: dict[tuple[int, int], bool] = {}
    for r in rolling:
        wanted[at[r.name]] = wanted.get(at[r.name], False) or r.stat != "avg"
    moments = sliding_moments(timed.select(GROUP, "__sec", *sources), "__sec", sources, spans, pane_seconds or min(spans), wanted)
    told = moments.select(GROUP, "__sec", *[(mean_of if r.stat == "avg" else deviation_of)(*at[r.name]).alias(r.name) for r in rolling])
    return timed.join(told, [GROUP, "__sec"], "left").drop(GROUP, "__sec")


def domain_features(df: DataFrame) -> DataFrame:
    """Formulas over a single row."""
    return with_vibration(df).withColumns(
        {
            "thermal_stress_index": domain.thermal_stress(),
            "generator_load_factor": domain.load_factor(),
            "speed_ratio": domain.speed_ratio(),
            "turbine_efficiency": domain.aero_efficiency(),
        }
    )


def build_features(df: DataFrame, keys: Keys = Keys(), chunk_seconds: int = CHUNK_SECONDS, whole_rows: int = 0) -> DataFrame:
    """Training rows plus 30 engineered columns. Nulls left by lags and deltas become 0."""
    series = delta_features(windowed(domain_features(df), keys, chunk_seconds=chunk_seconds, whole_rows=whole_rows)).withColumn(
        "temp_anomaly_score", domain.temp_anomaly("gearbox_temperature", "gearbox_temp_avg_6h", "gearbox_temp_std_1h")
    )
    return fill_zero(series, [lag.name for lag in LAGS] + list(DELTAS))


def cumulative_hours(
    df: DataFrame, keys: Keys = Keys(), rotor: str = "rotor_speed_rpm", interval_minutes: float = 10.0,
    out: str = "operating_hours", chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Hours the rotor has turned so far. Turning intervals are counted, so sums stay exact."""
    turning = df.withColumn("__turns", (F.coalesce(F.col(rotor), F.lit(0.0)) > 0).cast("long"))
    counted = running(time_chunks(turning, [keys.entity], keys.time, chunk_seconds), keys.time, {"__turned": ("sum", "__turns")})
    return drop_chunk(counted.withColumn(out, F.col("__turned") * interval_minutes / 60.0)).drop("__turns", "__turned")
