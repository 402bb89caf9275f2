"""Rule-driven aggregation: one function per column, chosen by the column's name.

Single-pass functions become expressions of one groupBy().agg(); functions that need a
second level (token sets, mixed vectors) are their own grouping, joined on the keys.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.functions import geo, special, vectors
from wayflux.operators.dissolve import dissolve


@dataclass(frozen=True)
class Rule:
    """pattern → function; `weight` is the second column, `params` is 'k=v;k=v'."""

    pattern: str
    fn: str
    weight: str = ""
    params: str = ""


# fixed values: the default rules, first full match wins
DEFAULT_RULES = [
    Rule("^attr_.*sum$", "attr_addition"),
    Rule("^attr_.*sub$", "attr_substraction"),
    Rule("^attr_.*append", "attr_append", "", "sep=|"),
    Rule("^attr_.*append_float", "attr_append_float", "", "sep=|"),
    Rule("^attr_.*union$", "attr_union", "", "sep=|"),
    Rule("^attr_.*union_int$", "attr_union_int", "", "sep=|"),
    Rule("^attr_.*intersect$", "attr_intersection", "", "sep=|"),
    Rule("^attr_.*avg$", "attr_average"),
    Rule("^num_.*", "attr_addition"),
    Rule("attr_population", "attr_addition"),
    Rule("movement", "attr_addition"),
    Rule("population", "attr_addition"),
    Rule("geometry", "merge_geometry"),
    Rule("poly_name", "attr_with_max", "num_cases"),
    Rule("poly_lat", "attr_with_max", "num_cases"),
    Rule("poly_lon", "attr_with_max", "num_cases"),
]

# fixed values: additions of the Colombian adapter
COLOMBIA_RULES = {
    "^attr.*wvg-pop$": Rule("^attr.*wvg-pop$", "attr_weighted_average", "attr_population"),
    "^attr.*time_delay$": Rule("^attr.*time_delay$", "estimate_gamma_delay"),
    "attr_area": Rule("attr_area", "attr_addition"),
    "^attr.*dist_mix$": Rule("^attr.*dist_mix$", "attr_dist_mix", "", "sep=|"),
    "poly_name": Rule("poly_name", "attr_with_max", "attr_population"),
    "poly_lat": Rule("poly_lat", "attr_with_max", "attr_population"),
    "poly_lon": Rule("poly_lon", "attr_with_max", "attr_population"),
}


def override(rules: list[Rule], changes: dict[str, Rule]) -> list[Rule]:
    """Same-pattern rules replaced in place, new ones appended."""
    old = {r.pattern for r in rules}
    return [changes.get(r.pattern, r) for r in rules] + [r for p, r in changes.items() if p not in old]


def rule_for(col: str, rules: list[Rule]) -> Rule:
    for r in rules:
        if re.fullmatch(r.pattern, col):
            return r
    raise ValueError(f"no rule matches column {col!r}; declare one in the scheme")


def parameters(rule: Rule, allowed: dict[str, str]) -> dict[str, str]:
    out = dict(allowed)
    for part in filter(None, rule.params.split(";")):
        key, _, value = part.partition("=")
        if key not in allowed:
            raise ValueError(f"parameter {key!r} is not allowed for {rule.fn}")
        out[key] = value
    return out


_TOKENS = {"sep": "|", "null_handling": "drop_na", "fill_null": ""}
Result = Column | Callable[[DataFrame, list[str]], DataFrame]


def _text(col: str, p: dict[str, str]) -> Column:
    if p["null_handling"] == "drop_na":
        return F.col(col).cast("string")
    return F.coalesce(F.col(col).cast("string"), F.lit(p["fill_null"]))


def _append(col: str, rule: Rule) -> Column:
    p = parameters(rule, _TOKENS)
    return F.array_join(F.array_sort(F.collect_list(_text(col, p))), p["sep"])


def _append_float(col: str, rule: Rule) -> Column:
    p = parameters(rule, _TOKENS)
    return F.array_join(F.array_sort(F.collect_list(F.col(col).cast("double"))).cast("array<string>"), p["sep"])


def _tokens(df: DataFrame, keys: list[str], col: str, p: dict[str, str], kind: str) -> DataFrame:
    parts = F.array_distinct(F.split(_text(col, p), re.escape(p["sep"])).cast(f"array<{kind}>"))
    return df.select(*keys, F.explode(parts).alias("_t"))


def _union(col: str, rule: Rule, kind: str = "string"):
    p = parameters(rule, _TOKENS)

    def run(df: DataFrame, keys: list[str]) -> DataFrame:
        distinct = _tokens(df, keys, col, p, kind).distinct()
        joined = F.array_join(F.array_sort(F.collect_list("_t")).cast("array<string>"), p["sep"])
        return distinct.groupBy(*keys).agg(joined.alias(col))

    return run


def _intersection(col: str, rule: Rule):
    p = parameters(rule, _TOKENS)

    def run(df: DataFrame, keys: list[str]) -> DataFrame:
        rows = df.groupBy(*keys).agg(F.count(_text(col, p)).alias("_rows"))
        seen = _tokens(df, keys, col, p, "string").groupBy(*keys, "_t").agg(F.count("*").alias("_c"))
        shared = F.collect_list(F.when(F.col("_c") == F.col("_rows"), F.col("_t")))
        return rows.join(seen, keys, "left").groupBy(*keys).agg(F.array_join(F.array_sort(shared), p["sep"]).alias(col))

    return run


def _weighted(col: str, rule: Rule) -> Column:
    """Null values or weights leave the numerator only, as a skipping sum does."""
    return F.sum(F.col(rule.weight) * F.col(col)) / F.nullif(F.sum(rule.weight), F.lit(0.0))


def _extreme(col: str, rule: Rule, largest: bool) -> Column:
    pair = F.when(F.col(rule.weight).isNotNull(), F.struct(F.col(rule.weight).alias("w"), F.col(col).alias("v")))
    best = F.max(pair) if largest else F.min(pair)
    return F.coalesce(best["v"], F.max(col))


def _mix(col: str, rule: Rule, weighted: bool):
    p = parameters(rule, {"sep": "|"})

    def run(df: DataFrame, keys: list[str]) -> DataFrame:
        is_text = dict(df.dtypes)[col] == "string"
        vec = vectors.parse_vector(F.col(col), p["sep"]) if is_text else F.col(col)
        w = F.col(rule.weight).cast("double") if weighted else F.lit(1.0)
        long = df.filter(F.col(col).isNotNull()).select(*keys, w.alias("_w"), F.posexplode(vec).alias("_i", "_x"))
        each = long.groupBy(*keys, "_i").agg((F.sum(F.col("_w") * F.col("_x")) / F.nullif(F.sum("_w"), F.lit(0.0))).alias("_m"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"])
        out = vectors.format_vector(ordered, p["sep"]) if is_text else ordered
        return each.groupBy(*keys).agg(out.alias(col))

    return run


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _gamma_curve(mean: pd.Series, mean_log: pd.Series) -> pd.Series:
    shape = special.gamma_shape(mean.to_numpy(float), mean_log.to_numpy(float))
    grid = np.arange(0, 62, dtype=float)  # days -1 .. 60 shifted by one
    return pd.Series(
        [special.gamma_pdf(grid, a, m / a) if np.isfinite(a) else None for a, m in zip(shape, mean)], dtype=object
    )


def _gamma_delay(col: str, rule: Rule):
    """Gamma density on days -1..60, fitted with its start fixed at -1.

    The fit needs only the mean and the mean logarithm, so the group itself is never
    collected: both come from a partial aggregation.
    """

    def run(df: DataFrame, keys: list[str]) -> DataFrame:
        x = F.col(col).cast("double") + 1
        stats = df.groupBy(*keys).agg(
            F.avg(x).alias("_m"), F.avg(F.ln(F.when(x > 0, x))).alias("_l"), F.min(x).alias("_lo")
        )
        return stats.select(*keys, F.when(F.col("_lo") > 0, _gamma_curve("_m", "_l")).alias(col))

    return run


def _merge_geometry(col: str, rule: Rule) -> Result:
    """The union of the group's shapes; `size` is the cell side of its spatial joins, in degrees."""
    size = float(parameters(rule, {"size": "0.25"})["size"])
    return lambda df, keys: dissolve(df, keys, col, size)


REGISTRY: dict[str, Callable[[str, Rule], Result]] = {
    "attr_addition": lambda c, r: F.coalesce(F.sum(c), F.lit(0.0)),
    "attr_average": lambda c, r: F.avg(c),
    "attr_append": _append,
    "attr_append_float": _append_float,
    "attr_union": _union,
    "attr_union_int": lambda c, r: _union(c, r, "bigint"),
    "attr_intersection": _intersection,
    "attr_weighted_average": _weighted,
    "attr_with_max": lambda c, r: _extreme(c, r, True),
    "attr_with_min": lambda c, r: _extreme(c, r, False),
    "estimate_gamma_delay": _gamma_delay,
    "attr_dist_mix": lambda c, r: _mix(c, r, False),
    "attr_dist_mix_weighted": lambda c, r: _mix(c, r, True),
    "merge_geometry": _merge_geometry,
}


def register(name: str, build: Callable[[str, Rule], Result]) -> None:
    """Add a user aggregation: (column, rule) → aggregate Column, or a (df, keys) → DataFrame."""
    REGISTRY[name] = build


def agglomerate(df: DataFrame, rules: list[Rule], keys: list[str], cols: list[str]) -> DataFrame:
    """Aggregate `cols` per key with the function each column's name selects.

    Rows with a null key are left out.
    """
    df = df.na.drop(subset=keys)
    simple, staged = [], []
    for c in cols:
        rule = rule_for(c, rules)
        if rule.fn not in REGISTRY:
            raise ValueError(f"no implementation for {rule.fn}")
        built = REGISTRY[rule.fn](c, rule)
        if isinstance(built, Column):
            simple.append(built.alias(c))
        else:
            staged.append(built)
    out = df.groupBy(*keys).agg(*simple) if simple else df.select(*keys).distinct()
    for run in staged:
        out = out.join(run(df, keys), keys, "left")
    return out.select(*keys, *cols)


def outline(areas: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """Border segments of each group of areas: segments shared by two members cancel out."""
    segs = areas.select(key, F.explode(geo.edges_of(F.col(rings))).alias("s"))
    a = F.struct(F.col("s.x1").alias("x"), F.col("s.y1").alias("y"))
    b = F.struct(F.col("s.x2").alias("x"), F.col("s.y2").alias("y"))
    ends = segs.select(key, F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))
    once = ends.groupBy(key, "p", "q").agg((F.count("*") % 2 == 1).alias("odd")).filter("odd")
    return once.select(key, F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))
