"""Projections, filters and reshaping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.operators.ranking import exact_percentiles


def to_contract(df: DataFrame, names: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Select and rename to canonical columns; `keep` columns pass unchanged."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()], *(keep or []))


def status_counters(df: DataFrame, status: str, place: str | None, values: dict[str, str]) -> DataFrame:
    """Turn a status (and place of care) into 0/1 counters.

    `values` names the texts for recovered, diseased, infected, hospital and icu.
    """
    def one(cond: Column) -> Column:
        return F.when(cond, 1.0).otherwise(0.0)

    st = F.col(status)
    out = (
        df.withColumn("num_cases", F.lit(1.0))
        .withColumn("num_recovered", one(st == values["recovered"]))
        .withColumn("num_diseased", one(st == values["diseased"]))
        .withColumn("num_infected", one(st == values["infected"]))
    )
    if place is None:
        return out
    sick = st == values["infected"]
    in_hospital = F.coalesce(F.col(place).isin(values["hospital"], values["icu"]), F.lit(False))
    return (
        out.withColumn("num_infected_in_hospital", one(sick & in_hospital))
        .withColumn("num_infected_in_house", one(sick & ~in_hospital))
        .withColumn("num_infected_in_icu", one(sick & (F.col(place) == values["icu"])))
    )


def up_to(df: DataFrame, col: str, last: date | str) -> DataFrame:
    """Rows up to and including the given day."""
    limit = F.lit(str(last)).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return df.filter(F.col(col).cast("timestamp_ntz") < limit)


def only_ids(df: DataFrame, col: str, ids: DataFrame | list[str] | None) -> DataFrame:
    """Rows of the selected areas; None keeps the whole location."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(col)).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(ids)))


def touching_ids(flows: DataFrame, start: str, end: str, ids: DataFrame) -> DataFrame:
    """Flows with at least one end among the selected areas."""
    key = ids.columns[0]
    marks = ids.select(F.col(key)).distinct().withColumn("_in", F.lit(True))
    out = (
        flows.join(marks.select(F.col(key).alias(start), F.col("_in").alias("_a")), start, "left")
        .join(marks.select(F.col(key).alias(end), F.col("_in").alias("_b")), end, "left")
        .filter(F.col("_a") | F.col("_b"))
    )
    return out.select(*flows.columns)


def internal(flows: DataFrame, start: str = "start_poly_id", end: str = "end_poly_id") -> DataFrame:
    return flows.filter(F.col(start) == F.col(end))


def external(flows: DataFrame, start: str = "start_poly_id", end: str = "end_poly_id") -> DataFrame:
    return flows.filter(F.col(start) != F.col(end))


def valid_delays(df: DataFrame, onset: str, diagnosis: str, longest: int = 60) -> DataFrame:
    """Onset-to-diagnosis delays from 0 to `longest` days."""
    d = F.datediff(diagnosis, onset)
    return df.withColumn("attr_time_delay", d.cast("double")).filter(d.between(0, longest))


def valid_death_delays(df: DataFrame, onset: str, death: str) -> DataFrame:
    d = F.datediff(death, onset)
    return df.withColumn("attr_death_time_delay", d.cast("double")).filter(d > 0)


def keep_largest(df: DataFrame, keys: list[str], size: str, tie: str) -> DataFrame:
    """One row per key: the one with the largest `size`, the smallest `tie` among equals.

    Two partial aggregations instead of a window, so that a hot key needs no single task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(size).alias("_top"))
    top = df.join(best, keys).filter(F.col(size) == F.col("_top"))
    return (
        top.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(tie)).alias("_r"))
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def melt_dates(df: DataFrame, ids: list[str], dates: list[str], value: str = "num_cases") -> DataFrame:
    """Wide date columns to (date_time, value) rows."""
    return df.unpivot(ids, dates, "date_time", value)


def undo_cumulative_wide(df: DataFrame, dates: list[str]) -> DataFrame:
    """Differences between neighbouring date columns, the first one kept."""
    new = {dates[0]: F.col(f"`{dates[0]}`")}
    new |= {b: F.col(f"`{b}`") - F.col(f"`{a}`") for a, b in zip(dates, dates[1:])}
    return df.withColumns(new)


def widen(df: DataFrame, keys: list[str], name: str, values: list[str], agg: Column) -> DataFrame:
    """Long to wide; naming the values saves the extra job that would look for them."""
    return df.groupBy(*keys).pivot(name, values).agg(agg)


def beside_reference(wide: DataFrame, key: str, reference: DataFrame) -> DataFrame:
    """Indicators of each area as rows, beside a (name, value) reference list."""
    names = [c for c in wide.columns if c != key]
    long = wide.unpivot([key], names, "name", "area_value")
    ref = reference.select("name", F.col("value").alias("reference_value"))
    return long.join(ref, "name", "full")


def split_name(df: DataFrame, col: str, first: str, second: str, sep: str = "-") -> DataFrame:
    parts = F.split(F.col(col), sep)
    return df.withColumn(first, F.get(parts, F.lit(0))).withColumn(second, F.get(parts, F.lit(1)))


def cut_outliers(df: DataFrame, col: str, low: float = 0.0, high: float = 0.95) -> DataFrame:
    """Rows whose magnitude lies between two quantiles of the magnitude, largest first."""
    size = F.abs(F.col(col))
    q = exact_percentiles(df.select(size.alias("_m")), [], "_m", [low, high], "_q")
    return df.join(q, (size >= F.col("_q")[0]) & (size <= F.col("_q")[1])).drop("_q")  # one-row side


def jitter(df: DataFrame, cols: list[str], spread: float, seed: int) -> DataFrame:
    return df.withColumns({c: F.col(c) + F.randn(seed + i) * spread for i, c in enumerate(cols)})


def good_contacts(
    df: DataFrame, max_accuracy: float = 30.0, max_distance: float = 5.0, max_time: float = 2.0
) -> DataFrame:
    return df.filter(
        (F.col("min_id1_device_accuracy") <= max_accuracy)
        & (F.col("min_id2_device_accuracy") <= max_accuracy)
        & (F.col("min_distance") <= max_distance)
        & (F.col("min_time_difference") <= max_time)
    )


def attribute_between(df: DataFrame, name: str, start, end) -> DataFrame:
    """Values of one attribute between two days, nulls dropped."""
    return df.filter((F.col("attribute_name") == name) & F.col("date").between(start, end)).na.drop(
        subset=["attribute_value"]
    )


def country_slice(register: DataFrame, col: str, country: str) -> DataFrame:
    return register.filter(F.upper(F.col(col)) == F.upper(F.lit(country)))


def stack(frames: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    out = frames[0] if columns is None else frames[0].select(*columns)
    for f in frames[1:]:
        out = out.unionByName(f if columns is None else f.select(*columns))
    return out


def path_rows(edges: DataFrame, start: str, end: str, keep: list[str]) -> DataFrame:
    """Both ends of each edge as rows of a path table."""
    a = edges.select(F.col(start).alias("node_id"), F.lit(0).alias("seq"), F.col(start).alias("start"), F.col(end).alias("end"), *keep)
    b = edges.select(F.col(end).alias("node_id"), F.lit(1).alias("seq"), F.col(start).alias("start"), F.col(end).alias("end"), *keep)
    return a.unionByName(b)
