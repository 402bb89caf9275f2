"""Sorts, limits, top-k and a rank that needs no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from wayflux.session import cut_lineage


def first_k(df: DataFrame, k: int | None) -> DataFrame:
    return df if k is None or k <= 0 else df.limit(k)


def top_or_other(df: DataFrame, key: str, value: str, keys: list[str], n: int = 10, other: str = "Otros") -> DataFrame:
    """The n largest keys by total keep their name, the rest is summed as one."""
    totals = df.groupBy(key).agg(F.sum(value).alias("_t"))
    top = totals.orderBy(F.col("_t").desc(), key).limit(n).select(key, F.lit(True).alias("_top"))
    return (
        df.join(top, key, "left")
        .groupBy(F.when(F.col("_top"), F.col(key)).otherwise(F.lit(other)).alias(key), *keys)
        .agg(F.sum(value).alias(value))
    )


def most_frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the n ids that occur most often."""
    ids = df.groupBy(key).agg(F.count("*").alias("_c")).orderBy(F.col("_c").desc(), key).limit(n).select(key)
    return df.join(ids, key, "left_semi")


def top_rows(df: DataFrame, value: str, ties: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(F.col(value).desc(), *ties).limit(n)


ROWS_PER_TASK = 200_000
SMALL = 100_000  # rows of a side that may be sent to every task


def ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows dealt to contiguous ranges of `order` and sorted: `_part` counts the ranges, `_at` the rows of each.

    Neither has gaps, and both are kept as written, so they stay the same when a task is run again.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return cut_lineage(placed).select(*df.columns, F.shiftrightunsigned("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))


def offsets(placed: DataFrame, keys: list[str], measure: Column, *also: Column) -> DataFrame:
    """Per group and range: `before`, the measure of the group's earlier ranges, and `total`, that of all of them.

    One row per group and range, of which there are no more than groups and ranges together.
    """
    sums = placed.groupBy(*keys, "_part").agg(measure.alias("_m"), *also)
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    summed = sums.withColumns({"before": F.coalesce(F.sum("_m").over(earlier), F.lit(0)), "total": F.sum("_m").over(W.partitionBy(*keys))})
    return cut_lineage(summed.drop("_m"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _parted(df: DataFrame, keys: list[str], sizes: DataFrame, rows_per_task: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of groups that fit one task, and of those that do not; `sizes` has a row (keys, `_d`) per group."""
    large = cut_lineage(sizes.filter(F.col("_d") > rows_per_task).select(*keys))
    if large.isEmpty():
        return df, None
    if keys == ["_g"]:
        return None, df
    large = _small(large)  # rows / rows_per_task at most: the rows of a few groups are not shuffled by group
    return df.join(large, keys, "left_anti"), df.join(large, keys, "left_semi")


def _both(a: DataFrame | None, b: DataFrame | None) -> DataFrame:
    return a if b is None else b if a is None else a.unionByName(b)


def distributed_rank(
    df: DataFrame, keys: list[str], score: str, tie: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Exact 1-based rank (`rank`) by falling score, then rising unique `tie`, and group size `n`.

    A group may hold most of the table. Groups beyond `rows_per_task` are dealt to ranges of
    (keys, score, tie): rank = rows of the group in earlier ranges + position in its own. Rows without a key are left out.
    """
    ks = keys or ["_g"]
    neg = F.when(F.col(score) == 0, F.lit(0.0)).otherwise(-F.col(score))
    base = (df.na.drop(subset=keys) if keys else df.withColumn("_g", F.lit(0))).withColumn("_s", neg)
    few, many = _parted(base, ks, base.groupBy(*ks).agg(F.count("*").alias("_d")), rows_per_task)
    if few is not None:
        w = W.partitionBy(*ks)
        few = few.withColumns({"n": F.count("*").over(w), "rank": F.row_number().over(w.orderBy("_s", tie)).cast("long")})
    if many is not None:
        placed = ranges(many, [*ks, "_s", tie])
        stats = offsets(placed, ks, F.count("*"), F.min("_at").alias("_first"))
        many = placed.join(_small(stats), [*ks, "_part"]).withColumns({"n": F.col("total"), "rank": F.col("before") + F.col("_at") - F.col("_first") + 1})
        many = many.drop("_part", "_at", "_first", "before", "total")
    return _both(few, many).select(*df.columns, "n", "rank")


def running_total(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """Sum of `value` over the rows up to each in `order` (`running`), before it (`earlier`) and of all (`total`)."""
    placed = ranges(df.withColumns({"_g": F.lit(0), "_w": F.coalesce(F.col(value), F.lit(0))}), order)
    stats = offsets(placed, ["_g"], F.sum("_w"))
    own = W.partitionBy("_part").orderBy("_at")
    summed = placed.withColumns({"_up": F.sum("_w").over(own), "_down": F.coalesce(F.sum("_w").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
    summed = summed.join(_small(stats), ["_g", "_part"])
    return summed.select(*df.columns, (F.col("before") + F.col("_up")).alias("running"), (F.col("before") + F.col("_down")).alias("earlier"), "total")


def top_share(df: DataFrame, keys: list[str], score: str, tie: str, share: float = 0.1) -> DataFrame:
    """The ceil(share * n) best rows of each group."""
    return distributed_rank(df, keys, score, tie).filter(F.col("rank") <= F.ceil(F.col("n") * share)).drop("rank", "n")


def numbered(df: DataFrame, order: list[Column], out: str = "number") -> DataFrame:
    """Rows numbered in order; for short lists such as milestones."""
    return df.withColumn(out, F.row_number().over(W.orderBy(*order)).cast("bigint"))


def exact_percentiles(
    df: DataFrame, keys: list[str], col: str, probs: list[float], out: str = "q", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Exact interpolated percentiles of groups of any size, as one array column.

    Equal values are counted first. Groups with more than `rows_per_task` distinct values are dealt to ranges of
    (keys, value), and only the ranges that hold a wanted position are looked into. Rows without a key or value are left out.
    """
    ks = keys or ["_g"]
    base = df.filter(F.col(col).isNotNull())
    base = base.na.drop(subset=keys) if keys else base.withColumn("_g", F.lit(0))
    counts = cut_lineage(base.groupBy(*ks, F.col(col).alias("_v")).agg(F.count("*").alias("_c")))
    few, many = _parted(counts, ks, counts.groupBy(*ks).agg(F.count("*").alias("_d")), rows_per_task)

    def spots(n: Column) -> list[Column]:
        return [F.lit(float(p)) * (n - 1) for p in probs]

    if few is not None:
        w = W.partitionBy(*ks)
        few = few.select(*ks, "_v", "_c", F.sum("_c").over(w.orderBy("_v")).alias("_e"), F.sum("_c").over(w).alias("_n"))
    if many is not None:
        placed = ranges(many, [*ks, "_v"])
        stats = offsets(placed, ks, F.sum("_c"), F.sum("_c").alias("_own"))
        wanted = F.lit(False)
        for s in spots(F.col("total")):
            for at in (F.floor(s), F.ceil(s)):
                wanted = wanted | ((at >= F.col("before")) & (at < F.col("before") + F.col("_own")))
        inner = placed.join(_small(stats.filter(wanted).drop("_own")), [*ks, "_part"])
        end = F.col("before") + F.sum("_c").over(W.partitionBy(*ks, "_part").orderBy("_v"))
        many = inner.select(*ks, "_v", "_c", end.alias("_e"), F.col("total").alias("_n"))
    ends = _both(few, many)

    def at(pos: Column) -> Column:
        return F.max(F.when((pos >= F.col("_e") - F.col("_c")) & (pos < F.col("_e")), F.col("_v")))

    places = spots(F.col("_n"))
    lows = [at(F.floor(s)).alias(f"_l{i}") for i, s in enumerate(places)]
    highs = [at(F.ceil(s)).alias(f"_h{i}") for i, s in enumerate(places)]
    found = ends.groupBy(*ks, "_n").agg(*lows, *highs)
    mixed = [
        F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (s - F.floor(s)) for i, s in enumerate(places)
    ]
    return found.select(*keys, F.array(*mixed).alias(out))
