"""Drift monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.catalog import query
from fleetlens.catalog.data import AS_OF, LABEL, halves, scored, training
from fleetlens.catalog.features import ENGINEERED, feature_table
from fleetlens.catalog.features import FEATURES as FEATURE_SQL
from fleetlens.catalog.sql import over, rounded, rounded_sql
from fleetlens.config import TRAINING_COLUMNS
from fleetlens.functions.tests_of_fit import EXACT_CELLS
from fleetlens.operators import drift
from fleetlens.session import cut_lineage
from fleetlens.catalog.readings import readings

#: Every numeric column of the feature table.
FEATURES = (*TRAINING_COLUMNS, *ENGINEERED)
# The later readings are shifted, so that there is drift to find.
_SHIFTS = {
    "wind_speed": "wind_speed * 1.2e0", "generator_temperature": "generator_temperature + 10e0",
    "vibration_y": "vibration_y * 1.5e0", "power_output": "power_output * 0.9e0",
}
#: The newest tenth of the feature table is compared with all before it.
_FRACTION = 0.9


def _samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    baseline, current = halves(cut_lineage(feature_table(spark, folder)), _FRACTION)
    return baseline, current.withColumns({c: F.expr(e.replace("e0", "D")) for c, e in _SHIFTS.items()})


_SIDED = (
    "numbered as (select *, row_number() over (order by reading_ts, turbine_id) - 1 as position, count(*) over () as n from {source}), "
    "sided as materialized (select *, position >= floor(n * {fraction!r}e0) as cur from numbered)"
)
_SHIFTED = "select cur, " + ", ".join(
    f"cast(case when cur then {_SHIFTS[c]} else {c} end as double) as {c}" if c in _SHIFTS else f"cast({c} as double) as {c}" for c in FEATURES
) + " from sided"
_UNPIVOTED = "unpivot ({wide}) on columns(* exclude (cur)) into name feature value v"


def _compared(longs: str) -> str:
    """Brute-force statistics of each feature among rows of (feature, v, cur)."""
    return f"""longs as materialized ({longs}),
sizes as materialized (select feature, count(*) filter (where not cur) as nb, count(*) filter (where cur) as nc, avg(v) filter (where not cur) as mb,
  avg(v) filter (where cur) as mc, stddev_samp(v) filter (where not cur) as sb, stddev_samp(v) filter (where cur) as sc
  from longs group by feature),
cnt as materialized (select feature, v, count(*) filter (where not cur) as b, count(*) filter (where cur) as c from longs group by feature, v),
ecdf as materialized (select feature, sum(b) over w as cb, sum(c) over w as cc from cnt window w as (partition by feature order by v)),
ks as materialized (select feature, max(abs(cb / cast(nb as double) - cc / cast(nc as double))) as d from ecdf join sizes using (feature) group by feature),
lam as (select feature, d, d * sqrt(cast(nb as double) * nc / (cast(nb as double) + nc)) as l from ks join sizes using (feature)),
small as materialized (select feature, least(nb, nc) as a, greatest(nb, nc) as b, cast(round(d * least(nb, nc) * greatest(nb, nc)) as bigint) as reach
  from ks join sizes using (feature) where nb > 0 and nc > 0 and nb * nc <= {EXACT_CELLS}),
walk(feature, a, b, reach, s, q) as (select feature, a, b, reach, cast(0 as bigint), list_transform(range(0, a + 1), lambda i: case when i * b >= reach then 1e0 else 0e0 end) from small
  union all select feature, a, b, reach, s + 1, list_transform(range(0, a + 1), lambda i: case when s + 1 - i < 0 or s + 1 - i > b then q[i + 1]
  when abs(i * b - (s + 1 - i) * a) >= reach then 1e0 else (q[i + 1] * (s + 1 - i) + coalesce(q[i], 0) * i) / (s + 1) end) from walk where s < a + b),
exact as materialized (select feature, case when reach <= 0 then 1e0 else q[a + 1] end as p from walk where s = a + b),
ksp as (select feature, d, coalesce(exact.p, case when l < 0.2e0 then 1e0 else least(1e0, greatest(0e0, 2 * (select sum(case when k % 2 = 1 then 1e0 else -1e0 end
  * exp(-2e0 * k * k * l * l)) from range(1, 101) t(k)))) end) as p from lam left join exact using (feature)),
ranked as materialized (select feature, list_sort(list(v)) as vs, count(*) as nb from longs where not cur group by feature),
spots as materialized (select feature, vs, nb, k, (nb - 1) * (k / 10e0) as pos from (select *, unnest(range(0, 11)) as k from ranked)),
around as materialized (select feature, k, pos - floor(pos) as t, vs[cast(floor(pos) as bigint) + 1] as lo,
  vs[least(cast(floor(pos) as bigint) + 2, nb)] as hi from spots),
edges as materialized (select feature, k, case when t >= 0.5e0 then hi - (hi - lo) * (1e0 - t) else lo + (hi - lo) * t end as e from around),
bins as materialized (select a.feature, a.k, a.e as lo, b.e as hi from edges a join edges b on a.feature = b.feature and b.k = a.k + 1),
shares as materialized (select bins.feature, k, sum(case when inside and not cur then 1 else 0 end) as eb, sum(case when inside and cur then 1 else 0 end) as ac
  from (select b.feature, b.k, l.cur, l.v >= b.lo and (l.v < b.hi or (b.k = 9 and l.v = b.hi)) as inside
  from bins b join longs l on l.feature = b.feature) bins group by bins.feature, k),
parts as (select feature, case when eb = 0 then 0.0001e0 else eb / cast(nb as double) end as pe,
  case when ac = 0 then 0.0001e0 else ac / cast(nc as double) end as pa from shares join sizes using (feature)),
psis as materialized (select feature, sum((pa - pe) * ln(pa / pe)) as psi_value from parts group by feature),
compared as (select feature, d as ks_statistic, p as ks_pvalue, psi_value, mb, mc, sb, sc, nb, nc
  from ksp join psis using (feature) join sizes using (feature) where nb > 0 and nc > 0),
drifted as (select feature, ks_statistic, ks_pvalue, psi_value, ks_pvalue < 0.05e0 or psi_value > 0.2e0 as drift_detected,
  case when psi_value > 0.2e0 then 'CRITICAL' when ks_pvalue < 0.05e0 then 'WARNING' else 'OK' end as drift_severity,
  mb as train_mean, mc as prod_mean, sb as train_std, sc as prod_std from compared)"""


_DATA = (*FEATURE_SQL, _SIDED.format(source="features", fraction=_FRACTION), _compared(_UNPIVOTED.format(wide=_SHIFTED)))
_DRIFT_DOUBLES = ("ks_statistic", "ks_pvalue", "psi_value", "train_mean", "prod_mean", "train_std", "prod_std")


@query("psi", over("training", rounded_sql("select feature, psi_value from psis", ["psi_value"]), *_DATA))
def psi(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.psi(*_samples(spark, folder), FEATURES), ["psi_value"])


@query("ks_statistic", over("training", rounded_sql("select feature, nb as n_base, nc as n_cur, d as ks_statistic from ksp join sizes using (feature)", ["ks_statistic"]), *_DATA))
def ks_statistic(spark: SparkSession, folder: str) -> DataFrame:
    tested = drift.ks_two_sample(*_samples(spark, folder), FEATURES)
    return rounded(tested.drop("ks_pvalue"), ["ks_statistic"])


@query("ks_pvalue", over("training", rounded_sql("select feature, p as ks_pvalue from ksp", ["ks_pvalue"]), *_DATA))
def ks_pvalue(spark: SparkSession, folder: str) -> DataFrame:
    tested = drift.ks_two_sample(*_samples(spark, folder), FEATURES)
    return rounded(tested.select("feature", "ks_pvalue"), ["ks_pvalue"])


# Each machine's own earlier and later readings: samples of some tens of rows, whose p-values are exact.
@query(
    "ks_per_machine",
    over(
        "readings",
        rounded_sql("select feature as turbine_id, nb as n_base, nc as n_cur, d as ks_statistic, p as ks_pvalue from ksp join sizes using (feature) where nb > 0 and nc > 0", ["ks_statistic", "ks_pvalue"]),
        _SIDED.format(source="readings", fraction=0.7),
        _compared("select turbine_id as feature, generator_temperature as v, cur from sided where generator_temperature is not null"),
    ),
)
def ks_per_machine(spark: SparkSession, folder: str) -> DataFrame:
    sides = [
        side.select(F.col("turbine_id").alias("feature"), F.col("generator_temperature").alias("value"), F.lit(current).alias("__cur"))
        for side, current in zip(halves(readings(spark, folder)), (False, True))
    ]
    tested = drift.ks_of_samples(sides[0].unionByName(sides[1]).where("value is not null"))
    return rounded(tested.withColumnRenamed("feature", "turbine_id"), ["ks_statistic", "ks_pvalue"])


def _data_drift(spark: SparkSession, folder: str) -> DataFrame:
    return drift.data_drift(*_samples(spark, folder), FEATURES, as_of=AS_OF)


@query("data_drift", over("training", rounded_sql("select * from drifted", _DRIFT_DOUBLES), *_DATA))
def data_drift(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_data_drift(spark, folder).drop("check_timestamp"), _DRIFT_DOUBLES)


_SUMMARY = """select count(*) as features_monitored, count(*) filter (where drift_detected) as features_drifted,
 count(*) filter (where drift_severity = 'CRITICAL') as features_critical from drifted"""


@query("data_drift_summary", over("training", _SUMMARY, *_DATA))
def data_drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    return drift.data_drift_summary(_data_drift(spark, folder))


@query(
    "top_drifted",
    over(
        "training",
        rounded_sql("select feature, psi_value, drift_severity from drifted where drift_detected order by psi_value desc, feature limit 10", ["psi_value"]),
        *_DATA,
    ),
)
def top_drifted(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.top_drifted(_data_drift(spark, folder)).select("feature", "psi_value", "drift_severity"), ["psi_value"])


# --- concept ----------------------------------------------------------------------------

# p-value at one degree of freedom: erfc(sqrt(x / 2)) by its Taylor series, term by term.
_CONCEPT = f"""{_SIDED.format(source='training', fraction=0.7)},
cells as (select count(*) filter (where not cur and {LABEL} = 1) as b1, count(*) filter (where not cur and {LABEL} = 0) as b0,
  count(*) filter (where cur and {LABEL} = 1) as c1, count(*) filter (where cur and {LABEL} = 0) as c0 from sided),
grid as (select unnest([b1, b0, c1, c0]) as o, unnest([(b1 + c1) * (b1 + b0), (b0 + c0) * (b1 + b0), (b1 + c1) * (c1 + c0), (b0 + c0) * (c1 + c0)])
  / cast(b1 + b0 + c1 + c0 as double) as e from cells),
chi as (select sum(power(abs(o - e) - least(0.5e0, abs(o - e)), 2) / e) as x from grid),
terms(n, t, x) as (select 0, sqrt(x / 2), x from chi union all select n + 1, -t * (x / 2) / (n + 1), x from terms where n < 150),
tail as (select 1 - 2 / sqrt(pi()) * sum(t / (2 * n + 1)) as p from terms),
concept as (select b1 / cast(b1 + b0 as double) as train_positive_rate, c1 / cast(c1 + c0 as double) as prod_positive_rate,
  (select x from chi) as chi2_statistic, (select p from tail) as chi2_pvalue from cells),
concept_check as (select *, abs(train_positive_rate - prod_positive_rate) as target_shift,
  abs(train_positive_rate - prod_positive_rate) > 0.05e0 as concept_drift_detected from concept)"""


@query("chi_square", over("training", rounded_sql("select chi2_statistic, cast(1 as bigint) as dof, chi2_pvalue from concept", ["chi2_statistic", "chi2_pvalue"]), _CONCEPT))
def chi_square(spark: SparkSession, folder: str) -> DataFrame:
    tested = drift.chi_square(drift.align_classes(*halves(training(spark, folder)), LABEL))
    return rounded(tested, ["chi2_statistic", "chi2_pvalue"])


_CONCEPT_DOUBLES = ("train_positive_rate", "prod_positive_rate", "chi2_statistic", "chi2_pvalue", "target_shift")


@query("concept_drift", over("training", rounded_sql("select * from concept_check", _CONCEPT_DOUBLES), _CONCEPT))
def concept_drift(spark: SparkSession, folder: str) -> DataFrame:
    checked = drift.concept_drift(*halves(training(spark, folder)), LABEL, as_of=AS_OF)
    return rounded(checked.drop("check_timestamp"), _CONCEPT_DOUBLES)


# --- predictions and model --------------------------------------------------------------

_PREDICTION = (_SIDED.format(source="scored", fraction=0.7), _compared(_UNPIVOTED.format(wide="select cur, failure_probability from sided")))
_PREDICTION_DOUBLES = (
    "baseline_mean_score", "current_mean_score", "baseline_std_score", "current_std_score", "mean_score_shift",
    "ks_statistic", "ks_pvalue", "psi_value",
)


@query(
    "prediction_drift",
    over(
        "scored",
        rounded_sql(
            "select mb as baseline_mean_score, mc as current_mean_score, sb as baseline_std_score, sc as current_std_score, "
            "abs(mb - mc) as mean_score_shift, ks_statistic, ks_pvalue, psi_value, ks_pvalue < 0.05e0 or psi_value > 0.1e0 or abs(mb - mc) > 0.1e0 "
            "as prediction_drift_detected, case when psi_value > 0.2e0 then 'CRITICAL' when psi_value > 0.1e0 then 'WARNING' else 'OK' end "
            "as drift_severity from compared",
            _PREDICTION_DOUBLES,
        ),
        *_PREDICTION,
    ),
)
def prediction_drift(spark: SparkSession, folder: str) -> DataFrame:
    checked = drift.prediction_drift(*halves(scored(spark, folder)), "failure_probability", as_of=AS_OF)
    return rounded(checked.drop("check_timestamp"), _PREDICTION_DOUBLES)


def _side(name: str, condition: str) -> str:
    return (
        f"{name} as (select coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as p, coalesce(tp / nullif(cast(tp + fn as double), 0), 0) as r, "
        "coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0) as f from (select count(*) filter (where label = 1 and prediction = 1) as tp, "
        f"count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 1 and prediction = 0) as fn from sided where {condition}))"
    )


_MODEL = (
    _SIDED.format(source="scored", fraction=0.7),
    _side("before", "not cur"),
    _side("later", "cur"),
    "both_sides as (select b.p as baseline_precision, b.r as baseline_recall, b.f as baseline_f1, l.p as current_precision, l.r as current_recall, "
    "l.f as current_f1, b.p - l.p as precision_degradation, b.r - l.r as recall_degradation, b.f - l.f as f1_degradation from before b, later l), "
    "model_check as (select *, precision_degradation > 0.05e0 or recall_degradation > 0.05e0 or f1_degradation > 0.05e0 as model_drift_detected, "
    "case when recall_degradation > 0.1e0 then 'CRITICAL' when recall_degradation > 0.05e0 then 'WARNING' else 'OK' end as drift_severity from both_sides)",
)
_MODEL_DOUBLES = tuple(
    f"{side}_{m}" for side in ("baseline", "current") for m in ("precision", "recall", "f1")
) + ("precision_degradation", "recall_degradation", "f1_degradation")


@query("model_drift", over("scored", rounded_sql("select * from model_check", _MODEL_DOUBLES), *_MODEL))
def model_drift(spark: SparkSession, folder: str) -> DataFrame:
    checked = drift.model_drift(*halves(scored(spark, folder)), "label", "prediction", as_of=AS_OF)
    return rounded(checked.drop("check_timestamp"), _MODEL_DOUBLES)


def _isolated(stage: str, body: str, *tables: str) -> str:
    return f"({over(stage, body, *tables)})"


_DATA_COUNTS = _isolated("training", _SUMMARY, *_DATA)
_CONCEPT_HIT = _isolated("training", "select concept_drift_detected from concept_check", _CONCEPT)
_PREDICTION_HIT = _isolated(
    "scored", "select ks_pvalue < 0.05e0 or psi_value > 0.1e0 or abs(mb - mc) > 0.1e0 as hit from compared", *_PREDICTION
)
_MODEL_HIT = _isolated("scored", "select model_drift_detected, drift_severity from model_check", *_MODEL)


@query(
    "drift_summary",
    "select features_drifted as data_drift_features_affected, features_critical as data_drift_critical, concept_drift_detected, "
    "hit as prediction_drift_detected, model_drift_detected, case when features_drifted > 5 or concept_drift_detected or "
    "drift_severity = 'CRITICAL' then 'CRITICAL' else 'OK' end as overall_drift_status, "
    "features_critical > 3 or concept_drift_detected or model_drift_detected as retraining_recommended "
    f"from {_DATA_COUNTS} d, {_CONCEPT_HIT} c, {_PREDICTION_HIT} p, {_MODEL_HIT} m",
)
def drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder)
    early, late = halves(rows)
    summary = drift.drift_summary(
        cut_lineage(_data_drift(spark, folder)),  # a few rows at the end of a long plan
        drift.concept_drift(*halves(training(spark, folder)), LABEL, as_of=AS_OF),
        cut_lineage(drift.prediction_drift(early, late, "failure_probability", as_of=AS_OF)),
        drift.model_drift(early, late, "label", "prediction", as_of=AS_OF),
        as_of=AS_OF,
    )
    return summary.drop("timestamp")
