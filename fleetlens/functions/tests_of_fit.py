"""Tail probabilities of two test statistics, as column expressions.

Spark SQL has no error or gamma function, so series are summed with `aggregate` over a
sequence; the exact p-value walks over arrays. All run on one row per test, never on data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Two samples of n and m rows get an exact p-value while n * m is at most this.
EXACT_CELLS = 250_000


def ks_pvalue(distance: Column, n: Column, m: Column, exact_cells: int = EXACT_CELLS) -> Column:
    """Two-sample Kolmogorov-Smirnov p-value: exact while n * m <= `exact_cells`, asymptotic beyond."""
    small = n.cast("long") * m.cast("long") <= exact_cells
    # functions in Python see every row, so the others are null to it
    return F.when(small, ks_pvalue_exact(F.when(small, distance), n, m)).otherwise(ks_pvalue_asymptotic(distance, n, m))


def ks_pvalue_exact(distance: Column, n: Column, m: Column) -> Column:
    """Share of the orders of n and m rows whose distribution functions come at least `distance` apart.

    An order is a lattice path from (0, 0) to (n, m), and it counts if it touches a point with
    |i / n - j / m| >= distance. The share q(i, j) of the paths to a point that have done so is 1 at such a point and
    else the mean of q(i - 1, j) and q(i, j - 1), weighted i to j. Points are visited by i + j, so one array of
    n + 1 shares goes on from diagonal to diagonal. Shares need no logarithms and small ones lose no digits. A test
    takes n + m steps on whole diagonals, so all tests together take no more steps than they have rows.
    """

    @F.pandas_udf("double")
    def share(distances: pd.Series, ns: pd.Series, ms: pd.Series) -> pd.Series:
        tests = zip(distances, ns, ms)
        return pd.Series([None if pd.isna(d) or pd.isna(a) or pd.isna(b) else share_of_paths(d, int(a), int(b)) for d, a, b in tests], dtype="float64")

    return share(distance.cast("double"), n.cast("long"), m.cast("long"))


def share_of_paths(distance: float, n: int, m: int) -> float:
    """`ks_pvalue_exact` of one test."""
    shorter, longer = min(n, m), max(n, m)
    reach = math.floor(distance * shorter * longer + 0.5)
    if reach <= 0:
        return 1.0
    i = np.arange(shorter + 1)
    shares = np.where(i * longer >= reach, 1.0, 0.0)
    for total in range(1, shorter + longer + 1):
        first, last = max(0, total - longer), min(shorter, total)
        at = i[first : last + 1]
        j = total - at
        fewer = np.concatenate(([shares[first - 1] if first else 0.0], shares[first:last]))
        mean = (shares[first : last + 1] * j + fewer * at) / total
        mean[np.abs(at * longer - j * shorter) >= reach] = 1.0
        shares[first : last + 1] = mean
    return float(shares[shorter])


def ks_pvalue_asymptotic(distance: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """The limit for many rows. Its series does not converge as the argument goes to 0, where it is 1."""
    n, m = n.cast("double"), m.cast("double")
    lam = distance * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def chi2_pvalue(statistic: Column, dof: Column, terms: int = 400) -> Column:
    """Survival function of the chi-square distribution for a whole number of degrees of freedom.

    Upper incomplete gamma ratio at a = dof/2, z = statistic/2: power series of the lower part
    for z < a + 1, continued fraction (evaluated from its tail) beyond.
    """
    a = dof.cast("double") / 2.0
    z = statistic / 2.0
    half = F.when(dof % 2 == 1, 0.5).otherwise(0.0)
    # log gamma(a) from gamma(1/2) = sqrt(pi) or gamma(1) = 1 upwards
    whole = F.floor(a - half).cast("int")
    start = F.when(dof % 2 == 1, F.lit(0.5 * math.log(math.pi))).otherwise(0.0)
    steps = F.when(dof % 2 == 1, F.sequence(F.lit(0), whole)).otherwise(F.sequence(F.lit(0), whole - 1))
    log_gamma = F.aggregate(
        steps,
        start,
        lambda acc, i: acc
        + F.when((dof % 2 == 1) & (i < whole), F.log(i + 0.5))
        .when((dof % 2 == 0) & (i > 0), F.log(i.cast("double")))
        .otherwise(0.0),
    )
    weight = F.exp(a * F.log(z) - z - log_gamma)
    # lower series: sum of z^n / (a (a+1) ... (a+n)), nested from the last term
    lower = F.aggregate(
        F.sequence(F.lit(terms), F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, n: 1.0 + acc * z / (a + n)
    )
    fraction = F.aggregate(
        F.sequence(F.lit(terms), F.lit(1), F.lit(-1)),
        z + (2.0 * terms + 1.0) - a,
        lambda acc, n: z + (2.0 * n - 1.0) - a - n * (n - a) / acc,
    )
    upper = F.when(z < a + 1.0, 1.0 - weight * lower / a).otherwise(weight / fraction)
    return (
        F.when(statistic.isNull() | dof.isNull() | (dof < 1), F.lit(None).cast("double"))
        .when(z <= 0, 1.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), upper)))
    )
