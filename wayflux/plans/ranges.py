"""Movement-range tables carried from outer areas to our own areas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.functions.vectors import ratio
from wayflux.operators import spatial


def range_weights(areas: DataFrame, outer: DataFrame, size: float, by_density: bool = True) -> DataFrame:
    """Weight of each outer area in each area: shared surface, times density where known.

    areas(poly_id, rings[, attr_population]), outer(external_polygon_id, rings).
    """
    w = spatial.overlap_weights(areas, outer, "poly_id", "external_polygon_id", size)
    if by_density and "attr_population" in areas.columns:
        dens = spatial.transfer_density(w, areas, "poly_id", "external_polygon_id")
        w = w.join(dens, "external_polygon_id").withColumn("factor", F.col("area_overlap") * F.col("population_density"))
    else:
        w = w.withColumn("factor", F.col("area_overlap"))
    return w.select("poly_id", "external_polygon_id", "factor")


def extrapolate_ranges(ranges: DataFrame, weights: DataFrame, areas: DataFrame) -> DataFrame:
    """Weighted mean range per area and day.

    An outer area without data that day does not count; none with data: null; an area that
    meets no outer area at all: 0.
    """
    days = ranges.agg(F.sort_array(F.collect_set("ds")).alias("_days"))  # one row, bounded by the calendar
    known = (
        weights.join(ranges, "external_polygon_id")
        .groupBy("poly_id", F.col("ds").alias("date_time"))
        .agg(ratio(F.sum(F.col("factor") * F.col("all_day_bing_tiles_visited_relative_change")), F.sum("factor")).alias("movement_change"))
    )
    met = weights.select("poly_id").distinct().withColumn("_met", F.lit(True))
    grid = areas.select("poly_id").crossJoin(days).select("poly_id", F.explode("_days").alias("date_time"))
    return (
        grid.join(known, ["poly_id", "date_time"], "left")
        .join(met, "poly_id", "left")
        .select("date_time", "poly_id", F.when(F.col("_met"), F.col("movement_change")).otherwise(0.0).alias("movement_change"))
    )
