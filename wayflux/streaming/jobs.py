"""Structured Streaming forms of the incremental steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.functions.dates import wall_clock_instant
from wayflux.sources.files import with_endpoints


DAY_FILES = 2


def stream_tiles(spark: SparkSession, path: str, ddl: str, fmt: str = "csv", files_per_trigger: int = 100) -> DataFrame:
    """New tile files as they arrive; files already read are remembered by the source."""
    reader = spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def located_tiles(stream: DataFrame) -> DataFrame:
    return with_endpoints(stream)


def daily_flow_totals(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Flow per rounded day and pair of areas. In append mode a day is emitted once the watermark passed it, in update
    mode with every batch that changes it.

    The window starts at noon of the day before, which is what rounding to the day means.
    """
    day = F.window("event_time", "1 day", "1 day", "12 hours")
    start_day = F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86400).cast("int"))
    return (
        stream.withColumn("event_time", wall_clock_instant(F.col("date_time")))
        .withWatermark("event_time", late)
        .groupBy(day.alias("w"), "start_poly_id", "end_poly_id")
        .agg(F.sum("movement").alias("movement"))
        .select(F.date_add(start_day, 1).alias("date_time"), "start_poly_id", "end_poly_id", "movement")
    )


def batch_daily_flow_totals(df: DataFrame) -> DataFrame:
    """The same totals over a finished table."""
    day = F.date_add((F.col("date_time").cast("timestamp_ntz") - F.expr("INTERVAL 12 HOURS")).cast("date"), 1)
    return df.groupBy(day.alias("date_time"), "start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement"))


def without_repeats(stream: DataFrame, keys: list[str], time: str = "date_time", late: str = "2 days") -> DataFrame:
    """Copies of a tile within the watermark are dropped."""
    timed = stream.withColumn("event_time", wall_clock_instant(F.col(time)))
    return timed.withWatermark("event_time", late).dropDuplicatesWithinWatermark(keys).drop("event_time")


def upsert_days(path: str, date: str = "date", batch: str = "batch"):
    """foreachBatch sink: each batch has its own partition of every day it holds.

    A day that comes in several batches keeps all of them, and a batch that is run again replaces only what
    it wrote before. `read_days` puts the days together. A batch's rows of a day go to DAY_FILES files at most.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        own = F.pmod(F.xxhash64(*(c for c in rows.columns if c != date)), F.lit(DAY_FILES))
        (
            rows.repartition(date, own).withColumn(batch, F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date, batch).parquet(path)
        )

    return write


def read_days(spark: SparkSession, path: str, keys: list[str], sums: list[str]) -> DataFrame:
    """What `upsert_days` stored, `sums` added up over the batches per key."""
    return spark.read.parquet(path).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def read_latest(spark: SparkSession, path: str, keys: list[str], values: list[str], batch: str = "batch") -> DataFrame:
    """What `upsert_days` stored of a stream in update mode: the values of the last batch per key."""
    last = F.max_by(F.struct(*values), batch).alias("_v")
    return spark.read.parquet(path).groupBy(*keys).agg(last).select(*keys, *(F.col(f"_v.{v}").alias(v) for v in values))


def first_case_alerts(stream: DataFrame) -> DataFrame:
    """An area with the first day it reports a case, and again when an earlier day arrives (update mode).

    The smallest date of an area is the one that holds. The state is a date and the time of the batch that brought it,
    merged before the shuffle; only what this batch brought is emitted.
    """
    cases = F.col("num_cases").cast("double")
    hits = stream.filter((cases > 0) & ~F.isnan(cases) & F.col("date_time").isNotNull())
    hits = hits.withColumn("at", F.current_timestamp())
    first = F.min(F.struct(F.col("date_time").cast("string").alias("first_date"), "at")).alias("_f")
    return hits.groupBy("poly_id").agg(first).filter(F.col("_f.at") == F.current_timestamp()).select("poly_id", "_f.first_date")


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Process everything that is there into a file sink, then stop."""
    q = stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    q.awaitTermination()
