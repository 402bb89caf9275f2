"""Contracts of the canonical tables, as schema strings for readers."""

MOVEMENT_TILES = (
    "geometry STRING, date_time STRING, start_polygon_id STRING, start_polygon_name STRING, "
    "end_polygon_id STRING, end_polygon_name STRING, length_km DOUBLE, tile_size INT, country STRING, "
    "level STRING, n_crisis DOUBLE, n_baseline DOUBLE, n_difference DOUBLE, percent_change DOUBLE, "
    "is_statistically_significant INT, z_score DOUBLE, start_lat DOUBLE, start_lon DOUBLE, "
    "end_lat DOUBLE, end_lon DOUBLE, start_quadkey STRING, end_quadkey STRING"
)

POPULATION = (
    "lat DOUBLE, lon DOUBLE, country STRING, date_time TIMESTAMP_NTZ, n_baseline DOUBLE, n_crisis DOUBLE, "
    "n_difference DOUBLE, density_baseline DOUBLE, density_crisis DOUBLE, percent_change DOUBLE, "
    "clipped_z_score DOUBLE, ds DATE"
)

MOVEMENT_RANGE = (
    "ds DATE, external_polygon_id STRING, all_day_bing_tiles_visited_relative_change DOUBLE"
)

CASES = ("date_time DATE, location STRING, poly_id STRING, num_cases DOUBLE")
MOVEMENT = ("date_time DATE, start_poly_id STRING, end_poly_id STRING, movement DOUBLE")


def counters(df) -> list[str]:
    """Additive counter columns (`num_*`)."""
    return [c for c in df.columns if c.startswith("num_")]


def attributes(df) -> list[str]:
    """Open area attributes (`attr_*`)."""
    return [c for c in df.columns if c.startswith("attr_")]
