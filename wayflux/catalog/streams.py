"""Streaming jobs run over the tables until nothing is left, read back from their sinks."""

import uuid

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.catalog.scans import _folder
from wayflux.streaming import jobs


def _fresh(t, name):
    return f"{_folder(t, name)}-{uuid.uuid4().hex[:8]}"


def _flow_source(t):
    """Flows with slot times, written as a folder of files for the file source."""
    path = _fresh(t, "flow_files")
    k = F.col("event_id") % 25
    src = t.raw("events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time"), k.cast("string").alias("start_poly_id"),
        F.pmod(F.col("user_id"), F.lit(25)).cast("string").alias("end_poly_id"), F.col("value").alias("movement"), "event_id",
    )
    src.write.parquet(path)
    return path, src


FILES = 4  # of a turn, and of a batch


def _in_turns(df, day, path, falling=False, turns=4):
    """Write the rows of one stretch of days after the other, FILES files each, so that a stream takes them in that order."""
    ends = df.agg(F.min(day.cast("date")).alias("a"), F.max(day.cast("date")).alias("b")).first()
    if ends["a"] is None:
        df.write.parquet(path)
        return
    span = (ends["b"] - ends["a"]).days + 1
    turn = F.floor(F.datediff(day.cast("date"), F.lit(ends["a"])) * turns / span)
    for k in reversed(range(turns)) if falling else range(turns):
        df.filter(turn == k).repartition(FILES).write.mode("append").parquet(path)


@query("streamed_tiles", "SELECT strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, count(*) AS n, sum(start_movement_lon) AS lon FROM tiles GROUP BY 1", r="lon", covers="L1")
def _(t):
    path, sink = _fresh(t, "tile_files"), _fresh(t, "tile_sink")
    t.tiles.write.option("header", True).csv(path)
    jobs.run_available(jobs.located_tiles(jobs.stream_tiles(t.spark, path, "geometry STRING, date_time TIMESTAMP_NTZ, n_crisis DOUBLE")), sink + "/out", sink + "/state")
    out = t.spark.read.parquet(sink + "/out")
    return out.groupBy("date_time").agg(F.count("*").alias("n"), F.sum("start_movement_lon").alias("lon"))


@query("streamed_daily_flows", """
    SELECT CAST(date_trunc('hour', ts) + INTERVAL 12 HOUR AS DATE) AS date_time, CAST(event_id % 25 AS VARCHAR) AS start_poly_id, CAST(user_id % 25 AS VARCHAR) AS end_poly_id, sum(value) AS movement FROM events GROUP BY 1, 2, 3""", d="date_time", r="movement", covers="L2 L3")
def _(t):
    """Update mode: every day is stored with the batches that change it, the last days too."""
    files, src = _flow_source(t)
    path, sink = _fresh(t, "flow_turns"), _fresh(t, "flow_sink")
    _in_turns(t.spark.read.parquet(files), F.col("date_time"), path)
    totals = jobs.daily_flow_totals(jobs.stream_tiles(t.spark, path, src.schema, "parquet", FILES))
    q = (
        totals.writeStream.foreachBatch(jobs.upsert_days(sink + "/out", "date_time")).outputMode("update")
        .option("checkpointLocation", sink + "/state").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return jobs.read_latest(t.spark, sink + "/out", ["date_time", "start_poly_id", "end_poly_id"], ["movement"])


@query("streamed_passed_days", """
    WITH d AS (SELECT CAST(date_trunc('hour', ts) + INTERVAL 12 HOUR AS DATE) AS date_time, CAST(event_id % 25 AS VARCHAR) AS start_poly_id, CAST(user_id % 25 AS VARCHAR) AS end_poly_id, sum(value) AS movement FROM events GROUP BY 1, 2, 3)
    SELECT * FROM d WHERE date_time + INTERVAL 12 HOUR <= (SELECT max(date_trunc('hour', ts)) - INTERVAL 2 DAY FROM events)""", d="date_time", r="movement", covers="L2")
def _(t):
    """Append mode: the days the watermark has passed."""
    path, src = _flow_source(t)
    sink = _fresh(t, "flow_sink")
    jobs.run_available(jobs.daily_flow_totals(jobs.stream_tiles(t.spark, path, src.schema, "parquet")), sink + "/out", sink + "/state")
    return t.spark.read.parquet(sink + "/out")


@query("batch_daily_flows", """
    SELECT CAST(date_trunc('hour', ts) + INTERVAL 12 HOUR AS DATE) AS date_time, CAST(event_id % 25 AS VARCHAR) AS start_poly_id, CAST(user_id % 25 AS VARCHAR) AS end_poly_id, sum(value) AS movement FROM events GROUP BY 1, 2, 3""", d="date_time", r="movement", covers="L2 H4")
def _(t):
    return jobs.batch_daily_flow_totals(_flow_source(t)[1])


@query("streamed_without_repeats", "SELECT event_id, value AS movement FROM events", r="movement", covers="L4")
def _(t):
    """Every tile arrives twice; a stretch of days per batch, in order, so that the watermark moves on."""
    files, src = _flow_source(t)
    path, sink = _fresh(t, "twice_files"), _fresh(t, "once_sink")
    once = t.spark.read.parquet(files)
    _in_turns(once.union(once), F.col("date_time"), path)
    stream = jobs.without_repeats(jobs.stream_tiles(t.spark, path, src.schema, "parquet", FILES), ["event_id"])
    jobs.run_available(stream, sink + "/out", sink + "/state")
    return t.spark.read.parquet(sink + "/out").select("event_id", "movement")


@query("streamed_day_partitions", "SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY 1, 2", d="date", covers="L3 A18")
def _(t):
    path, sink = _fresh(t, "day_files"), _fresh(t, "day_sink")
    # every day is split over all files, and every file is a batch
    part = F.pmod(F.col("event_id"), F.lit(3))
    daily = t.raw("events").groupBy(F.col("ts").cast("date").alias("date"), "event_type", part.alias("part")).agg(F.count("*").alias("n"))
    for k in range(3):
        daily.filter(F.col("part") == k).drop("part").repartition(FILES).write.mode("append").parquet(path)
    q = (
        jobs.stream_tiles(t.spark, path, daily.drop("part").schema, "parquet", FILES).writeStream.foreachBatch(jobs.upsert_days(sink + "/out"))
        .option("checkpointLocation", sink + "/state").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return jobs.read_days(t.spark, sink + "/out", ["date", "event_type"], ["n"])


@query("streamed_first_cases", "SELECT CAST(user_id AS VARCHAR) AS poly_id, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_date FROM events WHERE value > 20 GROUP BY 1", covers="L5 D15")
def _(t):
    path, sink = _fresh(t, "case_files"), _fresh(t, "case_sink")
    src = t.raw("events").groupBy(F.col("user_id").cast("string").alias("poly_id"), F.date_format("ts", "yyyy-MM-dd").alias("date_time")).agg(
        F.sum(F.when(F.col("value") > 20, 1.0).otherwise(0.0)).alias("num_cases")
    )
    whole = _fresh(t, "case_days")
    src.write.parquet(whole)  # added up once, not in every turn
    _in_turns(t.spark.read.parquet(whole), F.col("date_time"), path, falling=True)  # earlier days come later
    prev = t.spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = jobs.first_case_alerts(jobs.stream_tiles(t.spark, path, src.schema, "parquet", FILES))
        write = lambda batch, epoch: batch.write.mode("append").parquet(sink + "/out")
        q = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", sink + "/state").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", prev)
    return t.spark.read.parquet(sink + "/out").groupBy("poly_id").agg(F.min("first_date").alias("first_date"))
