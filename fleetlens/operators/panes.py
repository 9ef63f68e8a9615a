"""Means and deviations over a sliding stretch of time, put together from panes.

A frame that reaches back `span` seconds begins inside one pane of `pane` seconds, covers whole panes, and ends
inside another. Whole panes count by their moments (number, mean, sum of squared deviations);
only the two panes at its ends are summed instant by instant. A task holds a (group, pane), never a
frame, so a frame may be any number of tasks long. Sums are taken around a mean nearby (the pane's, or the
that of the whole panes) and parts are merged by Chan's formula, so few digits cancel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.ordering import CHUNK, GROUP, PART
from fleetlens.session import cut_lineage

#: (span, source) -> whether the deviation is wanted besides the mean
Wanted = Mapping[tuple[int, int], bool]


def _moments(sources: Sequence[str]) -> list[Column]:
    stats = [("n", "count({0})"), ("a", "coalesce(avg({0}), 0D)"), ("q", "coalesce(var_pop({0}) * count({0}), 0D)")]
    return [F.expr(f"{stat.format(f'`{source}`')} as {m}{j}") for j, source in enumerate(sources) for m, stat in stats]


def _number(seconds: str, pane: int) -> str:
    """The pane of a second, in whole numbers."""
    return f"({seconds} - pmod({seconds}, {pane}L)) div {pane}L"


def _around(j: int, centre: str) -> list[str]:
    """Sums of source j around a centre: s of the distances, v of their squares."""
    off = f"(a{j} - {centre}{j})"
    return [f"n{j} * {off} as s{j}", f"q{j} + n{j} * {off} * {off} as v{j}"]


def sliding_moments(rows: DataFrame, seconds: str, sources: Sequence[str], spans: Sequence[int], pane: int, wanted: Wanted) -> DataFrame:
    """(group, seconds) rows with the moments of source j over span i, for the `wanted` (i, j): n_i_j, mean_i_j, m2_i_j.

    `rows` has the group column of `ordering` and whole `seconds`; a pane is no longer than the shortest span.
    """
    if pane > min(spans):
        raise ValueError("a pane must not be longer than a frame")
    each = range(len(sources))
    number = _number(seconds, pane)
    instants = rows.groupBy(GROUP, seconds).agg(*_moments(sources)).withColumn(CHUNK, F.expr(number))
    panes = rows.withColumn(CHUNK, F.expr(number)).groupBy(*PART).agg(*_moments(sources))

    # whole panes between the two ends, for each span: one more of them where a frame begins early in its pane
    group = f"over (partition by {GROUP})"
    near = panes.selectExpr("*", *[f"sum(n{j} * a{j}) {group} / greatest(sum(n{j}) {group}, 1) as g{j}" for j in each])
    near = near.selectExpr("*", *[_around(j, "g")[0] for j in each])
    lists, means, middle = [], [], []
    for (i, j), spread in wanted.items():
        for extra in (0, 1) if spans[i] % pane else (0,):
            back, name = spans[i] // pane - 1 + extra, f"m{i}_{j}_{extra}"
            frame = f"over (partition by {GROUP} order by {CHUNK} range between {back} preceding and 1 preceding)"
            if spread and back:
                # deviations from the very mean of these panes, which are few
                lists.append(f"collect_list(struct(n{j} as n, a{j} as a, q{j} as q)) {frame} as l{name}")
                means += [f"aggregate(l{name}, 0L, (t, p) -> t + p.n) as n{name}",
                          f"aggregate(l{name}, 0D, (t, p) -> t + p.n * p.a) / greatest(aggregate(l{name}, 0L, (t, p) -> t + p.n), 1) as c{name}"]
                middle += [f"n{name}", f"c{name}", f"0D as s{name}", f"aggregate(l{name}, 0D, (t, p) -> t + p.q + p.n * pow(p.a - c{name}, 2)) as v{name}"]
            else:
                sums = [f"{f'coalesce(sum({m}{j}) {frame}, 0)' if back else '0'} as {m}{name}" for m in "ns"]
                lists += [*sums, f"g{j} as c{name}", f"0D as v{name}"]
                middle += [f"{m}{name}" for m in "nscv"]
    near = near.selectExpr("*", *lists).selectExpr("*", *means)
    centres = near.selectExpr(*PART, *[f"a{j} as c{j}" for j in each], *middle)

    # around the pane's mean: sums up to each instant in its pane
    own = cut_lineage(instants.join(centres, list(PART)).selectExpr("*", *[e for j in each for e in _around(j, "c")]))
    pane_of = f"partition by {', '.join(PART)}"
    ends = own.selectExpr("*", *[f"sum({m}{j}) over ({pane_of} order by {seconds}) as {m}p{j}" for j in each for m in "nsv"])

    # and sums from the beginning of each frame to the end of the pane it lies in: probes between the instants
    data = own.selectExpr(*PART, f"{seconds} as __at", *[f"{m}{j}" for j in each for m in "nsvc"])
    probe = ", ".join(f"struct({i} as i, {seconds} - {span} as at)" for i, span in enumerate(spans))
    probes = own.selectExpr(GROUP, f"{seconds} as __owner", f"explode(array({probe})) as p").selectExpr(
        GROUP, f"{_number('p.at', pane)} as {CHUNK}", "__owner", "p.i as __span", "p.at as __at"
    )
    since = f"over ({pane_of} order by __at desc)"
    begun = data.unionByName(probes, allowMissingColumns=True).selectExpr(
        GROUP, "__owner", "__span", *[f"sum({m}{j}) {since} as {m}b{j}" for j in each for m in "nsv"], *[f"max(c{j}) {since} as cb{j}" for j in each]
    ).where("__owner is not null")
    begins = begun.groupBy(GROUP, F.col("__owner").alias(seconds)).agg(*[
        F.expr(f"coalesce(max(if(__span = {i}, {m}b{j}, null)), 0) as {m}b{i}_{j}") for i, j in wanted for m in "nsvc"
    ])

    # the three parts of each frame, then their number, mean and squared deviations
    parts, totals, means, out = [], [], [], [GROUP, seconds]
    for (i, j), spread in wanted.items():
        name, early = f"{i}_{j}", f"pmod({seconds}, {pane}L) < {spans[i] % pane}"
        whole = [f"if({early}, {m}m{name}_1, {m}m{name}_0)" if spans[i] % pane else f"{m}m{name}_0" for m in "nsvc"]
        ends_of = {"b": [f"{m}b{name}" for m in "nsvc"], "m": whole, "p": [f"np{j}", f"sp{j}", f"vp{j}", f"c{j}"]}
        for k, (n, s, v, c) in ends_of.items():
            parts += [
                f"{n} as n{k}_{name}", f"{c} + {s} / greatest({n}, 1) as a{k}_{name}", f"greatest({v} - {s} * {s} / greatest({n}, 1), 0D) as q{k}_{name}",
            ]
        n = " + ".join(f"n{k}_{name}" for k in ends_of)
        totals.append(f"{n} as n_{name}")
        means.append(f"({' + '.join(f'n{k}_{name} * a{k}_{name}' for k in ends_of)}) / greatest(n_{name}, 1) as mean_{name}")
        out += [f"n_{name}", f"mean_{name}"]
        if spread:
            out.append(" + ".join(f"q{k}_{name} + n{k}_{name} * pow(a{k}_{name} - mean_{name}, 2)" for k in ends_of) + f" as m2_{name}")
    return (
        ends.join(begins, [GROUP, seconds]).selectExpr(GROUP, seconds, *parts)
        .selectExpr("*", *totals).selectExpr("*", *means).selectExpr(*out)
    )


def mean_of(i: int, j: int) -> Column:
    return F.when(F.col(f"n_{i}_{j}") > 0, F.col(f"mean_{i}_{j}"))


def deviation_of(i: int, j: int) -> Column:
    """Sample standard deviation; null for a single value."""
    n = F.col(f"n_{i}_{j}")
    return F.when(n > 1, F.sqrt(F.col(f"m2_{i}_{j}") / (n - 1)))
