"""Groupings over canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from wayflux.functions import dates
from wayflux.functions.vectors import ratio
from wayflux.operators.ranking import distributed_rank, exact_percentiles
from wayflux.operators.reshape import external
from wayflux.schema import counters


def sum_counters(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys).groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in counters(df)])


def daily_in_out(flows: DataFrame) -> DataFrame:
    """Inner and outgoing external flow per (area, date) in one grouping."""
    own = F.col("start_poly_id") == F.col("end_poly_id")
    return flows.groupBy(F.col("start_poly_id").alias("poly_id"), "date_time").agg(
        F.sum(F.when(own, F.col("movement")).otherwise(0.0)).alias("inner_movement"),
        F.sum(F.when(~own, F.col("movement")).otherwise(0.0)).alias("external_movement"),
    )


def _levels(kind: str) -> list[Column]:
    m, s = F.col(f"mean_{kind}"), F.col(f"std_{kind}")
    return [
        (m + s).alias(f"one_std_over_{kind}"),
        (m + 1.5 * s).alias(f"one_half_std_over_{kind}"),
        (m + 2 * s).alias(f"two_std_over_{kind}"),
    ]


def movement_stats(daily: DataFrame, key: str = "poly_id") -> DataFrame:
    """Mean, sample deviation and mean + 1 / 1.5 / 2 deviations of inner and external flow."""
    out = daily.groupBy(key).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in ("inner_movement", "external_movement")],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in ("inner_movement", "external_movement")],
    )
    return out.select("*", *_levels("inner_movement"), *_levels("external_movement"))


def node_flow_per_day(edges: DataFrame, start: str, end: str) -> DataFrame:
    """External flow touching each node, both directions added."""
    ends = F.explode(F.array(F.col(start), F.col(end))).alias("node_id")
    return (
        external(edges, start, end)
        .groupBy("date_time", start, end)
        .agg(F.sum("movement").alias("movement"))
        .select("date_time", ends, "movement")
        .groupBy("node_id", "date_time")
        .agg(F.sum("movement").alias("external_movement"))
    )


def node_flow_stats(edges: DataFrame, nodes: DataFrame, start: str = "start_id", end: str = "end_id") -> DataFrame:
    stats = node_flow_per_day(edges, start, end).groupBy("node_id").agg(
        F.avg("external_movement").alias("mean_external_movement"),
        F.stddev_samp("external_movement").alias("std_external_movement"),
    )
    out = nodes.select("node_id").distinct().join(stats, "node_id", "left").na.fill(0.0)
    return out.select("*", *_levels("external_movement"))


def extreme_rows(df: DataFrame, value: str, order: list[str], show: list[str]) -> DataFrame:
    """Row with the largest and row with the smallest value, the earliest of equals."""
    cols = [F.col(c) for c in show]
    tie = F.struct(*order)
    hi = F.min(F.struct((-F.col(value)).alias("_v"), tie.alias("_t"), *cols))
    lo = F.min(F.struct(F.col(value).alias("_v"), tie.alias("_t"), *cols))
    both = df.filter(F.col(value).isNotNull()).agg(hi.alias("hi"), lo.alias("lo"))
    pick = F.explode(F.array(F.struct(F.lit("max").alias("kind"), F.col("hi").alias("r")), F.struct(F.lit("min").alias("kind"), F.col("lo").alias("r"))))
    return both.select(pick.alias("e")).select("e.kind", *[F.col(f"e.r.{c}").alias(c) for c in show])


def extreme_days(df: DataFrame, value: str) -> DataFrame:
    daily = df.groupBy("date_time").agg(F.sum(value).alias(value))
    return extreme_rows(daily, value, ["date_time"], ["date_time", value])


def as_of_date(df: DataFrame, as_of=None, col: str = "date_time") -> DataFrame:
    """One-row reference date: the given day or the last date of the table."""
    return df.agg((F.lit(as_of).cast("date") if as_of else F.max(col)).alias("_as_of"))


def first_case_areas(cases: DataFrame, window: int = 5, as_of=None) -> DataFrame:
    """Areas whose first case lies within the last `window` days."""
    first = cases.filter("num_cases > 0").groupBy("poly_id").agg(F.min("date_time").alias("first_date"))
    return first.join(as_of_date(cases, as_of), F.col("first_date") >= F.date_sub("_as_of", window)).select("poly_id", "first_date")


def silent_areas(cases: DataFrame, window: int = 15, as_of=None) -> DataFrame:
    """Areas with cases before, but none in the last `window` days."""
    last = cases.filter("num_cases > 0").groupBy("poly_id").agg(F.max("date_time").alias("last_date"))
    return last.join(as_of_date(cases, as_of), F.col("last_date") < F.date_sub("_as_of", window)).select("poly_id", "last_date")


def areas_with_cases(cases: DataFrame) -> DataFrame:
    return cases.groupBy("poly_id").agg(F.sum("num_cases").alias("num_cases")).filter("num_cases > 0")


def area_ranges(cases: DataFrame, flows: DataFrame) -> DataFrame:
    """Largest and smallest daily counts and flows per area."""
    c = cases.groupBy("poly_id").agg(F.max("num_cases").alias("max_cases"), F.min("num_cases").alias("min_cases"))
    m = daily_in_out(flows).groupBy("poly_id").agg(
        F.max("inner_movement").alias("max_inner_movement"),
        F.min("inner_movement").alias("min_inner_movement"),
        F.max("external_movement").alias("max_external_movement"),
        F.min("external_movement").alias("min_external_movement"),
    )
    return c.join(m, "poly_id", "full")


def smallest_mean(nodes: DataFrame, value: str = "inner_movement", k: int = 10) -> DataFrame:
    """Mean of the k smallest daily values of each node, with plain mean and deviation.

    A node has one row per day, so the window is bounded by the calendar.
    """
    w = W.partitionBy("node_id").orderBy(F.col(value).asc_nulls_last(), "date_time")
    low = F.avg(F.when(F.col("_rn") <= k, F.col(value)))
    return (
        nodes.withColumn("_rn", F.row_number().over(w))
        .groupBy("node_id")
        .agg(low.alias("min_avg_movement"), F.avg(value).alias("mean_movement"), F.stddev_samp(value).alias("std_movement"))
    )


def weekly_rates(cases: DataFrame, population: DataFrame, per: float = 10_000.0) -> DataFrame:
    """Weekly counts (weeks close on Sunday) per area and per `per` people."""
    nums = counters(cases)
    weekly = cases.groupBy("poly_id", dates.week_end(F.col("date_time")).alias("week")).agg(*[F.sum(c).alias(c) for c in nums])
    pop = population.select("poly_id", "attr_population")
    return weekly.join(pop, "poly_id").select(
        "poly_id", "week", *nums, *[(ratio(F.col(c), F.col("attr_population")) * per).alias(f"{c}_rate") for c in nums]
    )


def contacts_by_place(contacts: DataFrame, digits: int = 4) -> DataFrame:
    return contacts.groupBy(F.round("lat", digits).alias("lat"), F.round("lon", digits).alias("lon")).agg(F.count("*").alias("total_contacts"))


def mean_daily_count(df: DataFrame, key: str, date: str) -> DataFrame:
    return df.groupBy(key, date).agg(F.count("*").alias("n")).groupBy(key).agg(F.avg("n").alias("mean_daily"))


def weighted_mean_by(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    return df.groupBy(*keys).agg(ratio(F.sum(F.col(weight) * F.col(value)), F.sum(weight)).alias(value))


def union_indicators(df: DataFrame, shares: list[str], counts: list[str], weight: str, keys: list[str] | None = None) -> DataFrame:
    """Indicators of a union of areas: population-weighted shares, summed counts."""
    aggs = [ratio(F.sum(F.col(weight) * F.col(c)), F.sum(weight)).alias(c) for c in shares]
    aggs += [F.sum(c).alias(c) for c in [weight, *counts]]
    return df.groupBy(*(keys or [])).agg(*aggs)


def month_week_means(flows: DataFrame) -> DataFrame:
    """Mean flow per pair, month and week of the month."""
    return flows.groupBy(
        "start_poly_id", "end_poly_id", F.month("date_time").cast("bigint").alias("month"), dates.week_of_month(F.col("date_time")).alias("week")
    ).agg(F.avg("movement").alias("movement"))


def recent_pair_means(flows: DataFrame, days: int = 7) -> DataFrame:
    last = as_of_date(flows)
    recent = flows.join(last, F.col("date_time") > F.date_sub("_as_of", days))
    return recent.groupBy("start_poly_id", "end_poly_id").agg(F.avg("movement").alias("movement"))


def community_summary(members: DataFrame, weight: str) -> DataFrame:
    """Name, id and centre of each community taken from its weightiest member, with the member list."""
    top = F.max(F.struct(F.col(weight).alias("w"), F.col("poly_id").alias("id"), "poly_name", "poly_lon", "poly_lat"))
    return (
        members.groupBy("community_id")
        .agg(
            top.alias("t"),
            F.array_join(F.array_sort(F.collect_set("poly_id")), ", ").alias("member_ids"),
            F.sum(weight).alias(weight),
        )
        .select(
            "community_id", F.col("t.id").alias("center_id"), F.col("t.poly_name").alias("community_name"),
            F.col("t.poly_lon").alias("lon"), F.col("t.poly_lat").alias("lat"), "member_ids", weight,
        )
    )


def change_factor(columns: list[str]) -> Column:
    """Weight of an area in its community's range: density, else people ÷ area, else either, else 1."""
    if "attr_population_density" in columns:
        return F.col("attr_population_density")
    if "attr_population" in columns and "attr_area" in columns:
        return F.col("attr_population") / F.col("attr_area")
    for c in ("attr_population", "attr_area"):
        if c in columns:
            return F.col(c)
    return F.lit(1.0)


def factor_average(ranges: DataFrame, areas: DataFrame, mapping: DataFrame) -> DataFrame:
    f = areas.select("poly_id", change_factor(areas.columns).alias("_f"))
    return (
        ranges.join(f, "poly_id")
        .join(mapping.select("poly_id", "community_id"), "poly_id")
        .groupBy("date_time", F.col("community_id").alias("poly_id"))
        .agg(ratio(F.sum(F.col("movement_change") * F.col("_f")), F.sum("_f")).alias("movement_change"))
    )


def quantile_class(df: DataFrame, col: str, unit: float = 1000.0, cuts=(0.3, 0.6, 0.9)) -> DataFrame:
    """Class 0..3 of each row by quantiles of the column counted in rounded units."""
    units = F.col(col) / unit
    q = exact_percentiles(df.select(F.bround(units, 0).alias("_u")), [], "_u", list(cuts), "_q")
    low, mid, high = (F.col("_q")[i] for i in range(3))
    rank = F.when(units > high, 3).when(units >= mid, 2).when(units >= low, 1).otherwise(0)
    return df.crossJoin(q).withColumn("quantile_class", rank.cast("bigint")).drop("_q")  # one-row side


def scaled_incidence(df: DataFrame, cases: str, people: str) -> DataFrame:
    """Positive incidence per 100 heads, times the power of ten that lifts the largest to at least 1."""
    inc = df.withColumn("incidence", 100 * ratio(F.col(cases), F.col(people))).filter("incidence > 0")
    power = F.greatest(F.ceil(-F.log10(F.max("incidence"))), F.lit(0)).cast("int")
    scale = inc.agg((100 * F.pow(F.lit(10.0), power)).alias("per_capita"))
    return inc.crossJoin(scale).withColumn("incidence", F.col("incidence") * F.col("per_capita") / 100)  # one-row side


def describe_column(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    q = exact_percentiles(df, keys, col, [0.25, 0.5, 0.75])
    base = df.groupBy(*keys).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"),
    )
    both = base.join(q, keys) if keys else base.crossJoin(q)  # one row each
    return (
        both.select(*keys, "n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")
    )


def sample_summary(df: DataFrame, keys: list[str], col: str, bounds=(0.025, 0.25, 0.75, 0.975)) -> DataFrame:
    """Mean, median, deviation and interval bounds of the samples of each key."""
    q = F.percentile(col, F.array(F.lit(0.5), *[F.lit(float(b)) for b in bounds]))
    out = df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), q.alias("q"))
    return out.select(*keys, "mean", "std", F.col("q")[0].alias("median"), *[F.col("q")[i + 1].alias(f"q{str(b)[2:]}") for i, b in enumerate(bounds)])


def with_overall(df: DataFrame, key: str, date: str, value: str, label: str = "aggregated") -> DataFrame:
    """Daily sums per area and, in the same pass, over all areas."""
    sets = [[F.col(key), F.col(date)], [F.col(date)]]
    return (
        df.groupingSets(sets, F.col(key), F.col(date))
        .agg(F.sum(value).alias(value), F.grouping(key).alias("_all"))
        .select(F.when(F.col("_all") == 1, F.lit(label)).otherwise(F.col(key)).alias(key), date, value)
    )


def od_shares(flows: DataFrame) -> DataFrame:
    """Total flow of each pair with its share of the origin's outflow and the target's inflow."""
    pairs = flows.groupBy("start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement"))
    out = pairs.groupBy("start_poly_id").agg(F.sum("movement").alias("_o"))
    inn = pairs.groupBy("end_poly_id").agg(F.sum("movement").alias("_i"))
    return pairs.join(out, "start_poly_id").join(inn, "end_poly_id").select(
        "start_poly_id", "end_poly_id", "movement",
        ratio(F.col("movement"), F.col("_o")).alias("outgoing_share"), ratio(F.col("movement"), F.col("_i")).alias("incoming_share"),
    )


def weekday_weekend(flows: DataFrame) -> DataFrame:
    """Mean daily in, out and stay flow per area on weekdays and weekends, scaled to 0..1 over both."""
    own = F.col("start_poly_id") == F.col("end_poly_id")
    part = F.when(dates.is_weekend(F.col("date_time")), F.lit("weekend")).otherwise(F.lit("weekday"))
    rows = F.explode(
        F.when(own, F.array(F.struct(F.col("start_poly_id").alias("poly_id"), F.lit("stay").alias("kind")))).otherwise(
            F.array(
                F.struct(F.col("start_poly_id").alias("poly_id"), F.lit("out").alias("kind")),
                F.struct(F.col("end_poly_id").alias("poly_id"), F.lit("in").alias("kind")),
            )
        )
    )
    daily = (
        flows.select("date_time", part.alias("part"), rows.alias("r"), "movement")
        .groupBy("r.poly_id", "r.kind", "part", "date_time")
        .agg(F.sum("movement").alias("m"))
    )
    mean = daily.groupBy("poly_id", "kind", "part").agg(F.avg("m").alias("movement"))
    rng = mean.groupBy("kind").agg(F.min("movement").alias("_lo"), F.max("movement").alias("_hi"))
    return mean.join(rng, "kind").select(
        "poly_id", "kind", "part", "movement", ratio(F.col("movement") - F.col("_lo"), F.col("_hi") - F.col("_lo")).alias("scaled")
    )


def box_stats(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Quartiles and the whiskers: the outermost values within 1.5 quartile ranges."""
    q = exact_percentiles(df, keys, col, [0.25, 0.5, 0.75])
    spread = 1.5 * (F.col("q")[2] - F.col("q")[0])
    inside = F.col(col).between(F.col("q")[0] - spread, F.col("q")[2] + spread)
    return (
        df.join(q, keys)
        .groupBy(*keys, "q")
        .agg(F.min(F.when(inside, F.col(col))).alias("whisker_low"), F.max(F.when(inside, F.col(col))).alias("whisker_high"))
        .select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "whisker_low", "whisker_high")
    )


def transits_from_homes(transits: DataFrame, homes: DataFrame, home_type: str = "HOUSE") -> DataFrame:
    """Total transits per (place, person, date) for people with a home of the given type."""
    h = homes.filter(F.col("type") == home_type).select("identifier").distinct()
    return (
        transits.join(h, "identifier", "left_semi")
        .groupBy("location_id", "identifier", "date")
        .agg(F.sum("total_transits").alias("total_transits"))
    )


def bucket_means(df: DataFrame, mapping: DataFrame, key: str, group: str, keys: list[str], col: str, other: str = "Other") -> DataFrame:
    """Mean per group, keys without a group counted as 'Other'."""
    return (
        df.join(mapping, key, "left")
        .groupBy(F.coalesce(group, F.lit(other)).alias(group), *keys)
        .agg(F.avg(col).alias(col))
    )


def highest_density(df: DataFrame, keys: list[str], col: str, tie: str, mass: float = 0.5) -> DataFrame:
    """Shortest interval that holds `mass` of the samples of each key.

    The samples of one key are ranked across tasks instead of being collected; the interval
    that starts at a row ends floor(mass * n) rows later.
    """
    down = df.select(*keys, col, tie, (-F.col(col)).alias("_d"))
    ranked = distributed_rank(down, keys, "_d", tie).select(
        *keys, col, F.col("rank").alias("_i"), F.floor(F.col("n") * mass).alias("_k")
    )
    ends = ranked.select(*keys, (F.col("_i") - F.col("_k")).alias("_i"), F.col(col).alias("_hi"))
    spans = ranked.join(ends, [*keys, "_i"]).withColumn("_span", F.round(F.col("_hi") - F.col(col), 9))
    best = F.min(F.struct("_span", F.col(col).alias("low"), F.col("_hi").alias("high")))
    return spans.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.low", "b.high")
