"""What keeps a query in proportion to its input: read once, no rows of one file or group in one task."""

import os

from pyspark.sql import functions as F

from wayflux import schema
from wayflux.operators import ranking, spatial
from wayflux.plans import agglomerate, alerts, places
from wayflux.sources import files, testdata
from wayflux.streaming import jobs


def _tiles(spark, path):
    rows = [("LINESTRING (0.1 0.1, 0.6 0.1)", "2024-01-01 08:00:00", 2.0), ("LINESTRING (0.6 0.1, 0.1 0.1)", "2024-01-01 16:00:00", 3.0)]
    df = spark.createDataFrame(rows, "geometry string, t string, n_crisis double").select("geometry", F.col("t").cast("timestamp_ntz").alias("date_time"), "n_crisis")
    df.write.parquet(path)
    return files.with_endpoints(spark.read.parquet(path))


def _areas(spark):
    df = spark.createDataFrame([("a", "A", 0.1, 0.1), ("b", "B", 0.6, 0.1)], "poly_id string, poly_name string, poly_lon double, poly_lat double")
    return df.withColumn("geometry", testdata.square_wkt(F.col("poly_lon"), F.col("poly_lat"), 0.25))


def test_tile_texts_are_read_once(spark, tmp_path):
    tiles, areas = _tiles(spark, str(tmp_path / "tiles")), _areas(spark)
    out = agglomerate.flows_by_geometry(tiles, areas)
    assert not any("tiles" in f for f in out.inputFiles())
    assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == [("2024-01-01", "a", "b", 2.0), ("2024-01-02", "b", "a", 3.0)]
    cases = spark.createDataFrame([("x", 0.1, 0.1, 3.0, "2024-01-01"), ("y", 0.6, 0.1, 2.0, "2024-01-01")], "location string, lon double, lat double, num_cases double, date_time string")
    moved = agglomerate.by_radius(cases, areas, tiles, None, 10.0)["movement"]
    assert not any("tiles" in f for f in moved.inputFiles())
    assert sorted((r["start_poly_id"], r["end_poly_id"], r["n_crisis"]) for r in moved.collect()) == [("a", "b", 2.0), ("b", "a", 3.0)]


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_lines_of_a_file_are_not_shuffled_by_file(spark, tmp_path):
    names = [c.strip().split(" ")[0] for c in schema.MOVEMENT_TILES.split(",")]
    row = {"geometry": '"LINESTRING (0 0, 1 1)"', "date_time": "2024-01-01 0800", "n_crisis": "2"}
    for k, odd in enumerate(("2", "x")):
        lines = [",".join(names), *(",".join({**row, "n_crisis": odd}.get(n, "1") for n in names) for _ in range(3))]
        (tmp_path / f"{k}.csv").write_text("\n".join(lines) + "\n")
    ok, rejected = files.checked_tiles(spark, str(tmp_path))
    assert "SortMergeJoin" not in _plan(ok) and _plan(ok).count("BroadcastHashJoin") == 3
    assert ok.count() == 3 and [(r["reason"], r["bad_rows"]) for r in rejected.collect()] == [("rows", 3)]


def test_rows_of_large_groups_are_not_shuffled_by_group(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") * 37 % 1009).cast("double").alias("s"), "id")
    sizes = df.groupBy("g").agg(F.count("*").alias("_d"))
    few, many = ranking._parted(df, ["g"], sizes, 100)
    assert "SortMergeJoin" not in _plan(few) + _plan(many)
    got = ranking.distributed_rank(df, ["g"], "s", "id", 100).collect()
    for g in "012":
        own = sorted((r for r in got if r["g"] == g), key=lambda r: (-r["s"], r["id"]))
        assert [r["rank"] for r in own] == list(range(1, 1001)) and own[0]["n"] == 1000


def test_estimates_are_made_once(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-09", 3.0)], "poly_id string, d string, ml double").withColumn("date_time", F.col("d").cast("date")).write.parquet(str(tmp_path / "rt"))
    out = alerts.rt_alerts(spark.read.parquet(str(tmp_path / "rt")), 7)
    assert out.inputFiles() == [] and out.first()["ml"] == 3.0


def test_first_cases_are_kept_by_the_engine(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "poly_id string, date_time string, num_cases double"
    turns = [[("a", "2024-01-05", 1.0), ("b", "2024-01-04", 0.0)], [("a", "2024-01-07", 2.0), ("b", "2024-01-06", float("nan"))], [("a", "2024-01-02", 1.0), ("b", "2024-01-03", 1.0), ("b", "2024-01-01", None)]]
    for rows in turns:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.first_case_alerts(jobs.stream_tiles(spark, path, ddl, "parquet", 1))
    assert "TransformWithState" not in stream._jdf.queryExecution().analyzed().toString()
    write = lambda batch, epoch: batch.write.mode("append").parquet(out)
    stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    # an alert, no alert for a later day, and a correction
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a", "2024-01-02"), ("a", "2024-01-05"), ("b", "2024-01-03")]


def test_a_batch_writes_few_files_a_day(spark, tmp_path):
    rows = spark.range(400).select(F.lit("2024-01-01").alias("date"), F.col("id").alias("k")).repartition(16)
    jobs.upsert_days(str(tmp_path / "days"))(rows, 0)
    written = [f for _, _, names in os.walk(tmp_path / "days") for f in names if f.endswith(".parquet")]
    assert len(written) <= jobs.DAY_FILES and spark.read.parquet(str(tmp_path / "days")).count() == 400


def test_places_merge_in_turns_as_in_one_pass(spark, monkeypatch):
    import random

    rng = random.Random(4)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), 0.01 * rng.random(), 0.01 * rng.random(), float(k)) for k in range(400)]
    monkeypatch.setattr(places, "FIRST_TURN", 20)
    met = []
    heads = places.greedy_heads
    monkeypatch.setattr(places, "greedy_heads", lambda nodes, pairs: met.append(pairs.count()) or heads(nodes, pairs))
    df = spark.createDataFrame(rows, "id long, lon double, lat double, total double")
    got = {r["id"]: (r["total"], r["n_places"]) for r in places.merge_places(df, 100.0).collect()}
    near = {tuple(r) for r in spatial.close_pairs(df, "id", 0.2).collect()}
    want, total = {}, {r[0]: r[3] for r in rows}
    for i in sorted(total):
        if not any((i, h) in near for h in want):
            own = [i, *(b for a, b in near if a == i)]
            want[i] = (sum(total[b] for b in own), len(own))
    assert got == want and len(met) > 1 and sum(met) < len(near) / 4
