"""Means, spreads and joint spreads that can be merged.

A state holds the number of rows, the means, and the sums of squared and joint deviations from them. Two states merge by
the distance of their means, so nothing large is subtracted from something large, as sums of squares would.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(names: list[str]) -> list[tuple[str, str]]:
    return list(combinations_with_replacement(names, 2))


def moments(values: dict[str, Column]) -> Column:
    """Aggregate: the state of some columns of doubles, none of which may be null."""
    n = F.count(F.lit(1)).cast("double")
    parts = [n.alias("n")] + [F.avg(c).alias(name) for name, c in values.items()]
    for a, b in _pairs(list(values)):
        parts.append((F.covar_pop(values[a], values[b]) * n).alias(f"{a}_{b}"))
    return F.struct(*parts)


def _merge(a: Column, b: Column, names: list[str]) -> Column:
    n = a["n"] + b["n"]
    safe = F.greatest(n, F.lit(1.0))
    apart = {x: b[x] - a[x] for x in names}
    parts = [n.alias("n")] + [(a[x] + apart[x] * b["n"] / safe).alias(x) for x in names]
    for x, y in _pairs(names):
        parts.append((a[f"{x}_{y}"] + b[f"{x}_{y}"] + apart[x] * apart[y] * a["n"] * b["n"] / safe).alias(f"{x}_{y}"))
    return F.struct(*parts)


def merged(states: Column, names: list[str]) -> Column:
    """One state of an array of states."""
    fields = ["n", *names, *[f"{x}_{y}" for x, y in _pairs(names)]]
    nothing = F.struct(*[F.lit(0.0).alias(f) for f in fields])
    return F.aggregate(states, nothing, lambda a, b: _merge(a, b, names))


def variance(state: Column, name: str) -> Column:
    """Sample variance; null for fewer than two rows."""
    return F.when(state["n"] > 1, state[f"{name}_{name}"] / (state["n"] - 1))


def correlation(state: Column, x: str, y: str) -> Column:
    return F.try_divide(state[f"{x}_{y}"], F.sqrt(state[f"{x}_{x}"] * state[f"{y}_{y}"]))
