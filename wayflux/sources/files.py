"""Readers, writers and audits of the file-based tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux import schema
from wayflux.functions import dates, geo
from wayflux.operators import ranking
from wayflux.session import cut_lineage


def scan_csv(spark: SparkSession, path: str | list[str], ddl: str, encoding: str = "UTF-8", drop_null: bool = False) -> DataFrame:
    """Typed scan of a file or a directory; ids stay text, empty files add no rows."""
    df = spark.read.schema(ddl).option("header", True).option("encoding", encoding).csv(path)
    return df.na.drop() if drop_null else df


def scan_clean_csv(spark: SparkSession, path: str, ddl: str, old: str, new: str) -> DataFrame:
    """CSV whose text needs a replacement before it can be parsed (a separator inside a name)."""
    lines = spark.read.text(path).withColumn("value", F.replace("value", F.lit(old), F.lit(new)))
    return parse_lines(lines, ddl)


def parse_lines(lines: DataFrame, ddl: str, header_start: str | None = None) -> DataFrame:
    """Text lines to typed columns; lines equal to the header are left out."""
    first = header_start or ddl.split()[0]
    rows = lines.filter(~F.col("value").startswith(first) & (F.trim("value") != ""))
    return rows.select(F.from_csv("value", ddl, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def with_endpoints(tiles: DataFrame) -> DataFrame:
    """Longitude and latitude of both ends from the LINESTRING text."""
    g = F.col("geometry")
    return tiles.withColumns({
        f"{side}_movement_{axis}": geo.line_point(g, pos, axis) for pos, side in ((1, "start"), (2, "end")) for axis in ("lon", "lat")
    })


def decoded_lines(spark: SparkSession, path: str | list[str], fallback: str = "ISO-8859-1") -> DataFrame:
    """(file, value): the lines of text files, each file read as UTF-8 if all of it is, else in the fallback encoding.

    The text source hands on a line's bytes as they are, so files are decoded in pieces, however long they are.
    What is known of each file is one row, which goes to the lines; the lines stay where they are.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("raw"))
    plain = raw.groupBy("file").agg(F.bool_and(F.is_valid_utf8(F.col("raw").cast("string"))).alias("plain"))
    value = F.when(F.col("plain"), F.decode("raw", "UTF-8")).otherwise(F.decode("raw", fallback))
    return raw.join(ranking._small(cut_lineage(plain)), "file").select("file", value.alias("value"))


def decoded_csv(spark: SparkSession, path: str | list[str], ddl: str, fallback: str = "ISO-8859-1") -> DataFrame:
    """Typed scan of CSV files with a header line each, whose encodings may differ from file to file."""
    return parse_lines(decoded_lines(spark, path, fallback).select("value"), ddl)


def checked_tiles(spark: SparkSession, path: str | list[str], max_date: str | None = None, drop_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of the good tile files, with end points, before `max_date`; and the files rejected: file, reason, bad_rows.

    A file is rejected as a whole if its header has not exactly the contract's columns (in any order), or if any row
    has another number of fields, a value that is not of its column's type, or no readable time.
    """
    cols = [c.strip().split(" ")[0] for c in schema.MOVEMENT_TILES.split(",")]
    types = dict(c.strip().split(" ") for c in schema.MOVEMENT_TILES.split(","))
    text = decoded_lines(spark, path).filter(F.trim("value") != "")
    is_header = F.col("value").contains("start_polygon_id") & F.col("value").contains("geometry")
    heads = cut_lineage(text.groupBy("file").agg(F.max(F.when(is_header, F.col("value"))).alias("head"), F.count("*").alias("lines")))
    fits = F.coalesce(F.array_sort(F.split("head", ",")) == F.array(*[F.lit(c) for c in sorted(cols)]), F.lit(False))
    good = ranking._small(heads.filter(fits).select("file", "head"))

    ddl = ", ".join(f"c{i} STRING" for i in range(len(cols))) + ", _torn STRING"  # _torn: a row with fields too many or too few
    cells = F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"})
    fields = F.array(*[F.col(f"r.c{i}") for i in range(len(cols))])
    named = F.map_from_arrays(F.split("head", ","), fields)
    split = text.filter(~is_header).join(good, "file").select("file", cells.alias("r"), "head").withColumn("m", named)

    def cast(c):
        return F.try_to_timestamp(F.col("m")[c], F.lit("yyyy-MM-dd HHmm")).cast("timestamp_ntz") if c == "date_time" else F.expr(f"try_cast(m['{c}'] AS {types[c]})")

    bad = F.col("r._torn").isNotNull() | cast("date_time").isNull()
    for c in cols:
        bad = bad | (cast(c).isNull() & (F.coalesce(F.trim(F.col("m")[c]), F.lit("")) != ""))
    rows = split.select("file", bad.alias("bad"), *(cast(c).alias(c) for c in cols))
    wrong = cut_lineage(rows.groupBy("file").agg(F.sum(F.col("bad").cast("long")).alias("bad_rows")).filter("bad_rows > 0"))
    rejected = heads.filter(~fits).select("file", F.lit("columns").alias("reason"), (F.col("lines") - F.col("head").isNotNull().cast("int")).alias("bad_rows"))
    rejected = rejected.unionByName(wrong.select("file", F.lit("rows").alias("reason"), "bad_rows"))
    kept = rows.join(ranking._small(wrong.select("file")), "file", "left_anti").drop("file", "bad")
    kept = kept.na.drop() if drop_null else kept
    if max_date is not None:
        kept = kept.filter(F.col("date_time") < F.lit(max_date).cast("timestamp_ntz"))
    return with_endpoints(kept), rejected


def ingest_tiles(spark: SparkSession, path: str | list[str], max_date: str | None = None, drop_null: bool = False) -> DataFrame:
    """Rows of the tile files that pass `checked_tiles`."""
    return checked_tiles(spark, path, max_date, drop_null)[0]


def empty_population(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.POPULATION)


def movement_range_table(df: DataFrame) -> DataFrame:
    return df.select("ds", "external_polygon_id", "all_day_bing_tiles_visited_relative_change").na.drop()


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Parquet table, split by columns such as location or date."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last date of each table."""
    out = None
    for name, (df, col) in tables.items():
        row = df.agg(F.min(col).cast("date").alias("first_date"), F.max(col).cast("date").alias("last_date"))
        row = row.select(F.lit(name).alias("table_name"), "first_date", "last_date")
        out = row if out is None else out.unionByName(row)
    return out


def parse_manifest(lines: DataFrame) -> DataFrame:
    """'Key name: value' lines to (key, value)."""
    parts = F.split(F.trim("value"), ":", 2)
    return lines.select(F.replace(parts[0], F.lit(" "), F.lit("_")).alias("key"), F.trim(parts[1]).alias("value"))


def missing_slots(present: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Eight-hour slots of the span that no row falls on."""
    span = present.agg(
        (F.lit(start) if start else F.min(F.col(col).cast("date"))).cast("date").alias("a"),
        (F.lit(end) if end else F.max(F.col(col).cast("date"))).cast("date").alias("b"),
    )
    last = F.col("b").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS")
    want = span.select(F.explode(F.sequence(F.col("a").cast("timestamp_ntz"), last, F.expr("INTERVAL 8 HOURS"))).alias("slot"))
    return want.join(present.select(F.col(col).alias("slot")).distinct(), "slot", "left_anti")


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns that were added, removed or changed type."""
    a, b = dict(old.dtypes), dict(new.dtypes)
    rows = [(c, a.get(c), b.get(c), "added" if c not in a else "removed" if c not in b else "changed") for c in sorted({*a, *b}) if a.get(c) != b.get(c)]
    return new.sparkSession.createDataFrame(rows, "column_name string, old_type string, new_type string, change string")


def map_rows(df: DataFrame, col: str, key: str, value_type: str) -> DataFrame:
    """A map-shaped JSON text ({id: {…}}) to one row per id."""
    m = F.from_json(F.col(col), f"map<string,{value_type}>")
    return df.select(F.explode(m).alias(key, "_v")).select(key, "_v.*")


def resume_after(history: DataFrame, fresh: DataFrame, col: str = "date") -> DataFrame:
    """History plus the rows of later days only."""
    last = history.agg(F.max(col).alias("_last"))
    new = fresh.join(last, F.col("_last").isNull() | (F.col(col) > F.col("_last"))).drop("_last")  # one-row side
    return history.unionByName(new)


def merge_locations(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.dropDuplicates()


def merge_ranges(tables: list[DataFrame | None]) -> DataFrame | None:
    """Range tables are merged only when every location has one."""
    return None if any(t is None for t in tables) else merge_locations(tables)


def last_covered_date(df: DataFrame, location_col: str, location: str, col: str = "date") -> DataFrame:
    return df.filter(F.col(location_col) == location).agg(F.max(col).alias("last_date"))


# fixed values: which method stands in for which
STAND_INS = {"geometry": ["geometry", "radial"], "radial": ["radial", "geometry"], "community": ["community"]}


def choose_variant(df: DataFrame, wanted: str, keys: list[str] | None = None, col: str = "agglomeration") -> DataFrame:
    """Rows of the wanted method per location, else of its stand-in, else none."""
    keys = keys or ["location"]
    order = STAND_INS.get(wanted, [wanted])
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(col))
    known = df.withColumn("_r", rank).filter("_r > 0")
    best = known.groupBy(*keys).agg(F.min("_r").alias("_r"))
    return known.join(best, [*keys, "_r"], "left_semi").drop("_r")


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame], args: dict | None = None) -> DataFrame:
    """A query over named tables; Catalyst pushes its filters to their scans."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or {})


def encrypt_columns(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Columns as base64 AES text; other columns stay readable."""
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), F.lit(key))) for c in cols})


def decrypt_columns(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    return df.withColumns({c: F.aes_decrypt(F.unbase64(F.col(c)), F.lit(key)).cast("string") for c in cols})


def is_protected(description: DataFrame, tag: str = "encrypted") -> DataFrame:
    """One row telling whether a (name, value) description carries the tag."""
    return description.agg(F.coalesce(F.max((F.col("name") == tag) & (F.upper("value") == "TRUE")), F.lit(False)).alias("protected"))


def parse_dates(df: DataFrame, col: str, fmt: str) -> DataFrame:
    """Dates by format; rows that cannot be read drop out."""
    return df.withColumn(col, dates.parse_lenient(F.col(col), fmt)).na.drop(subset=[col])

