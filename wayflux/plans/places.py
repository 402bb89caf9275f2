"""High-contact places: scores from hourly contact graphs, top lists, merged surroundings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.functions.vectors import softplus_weight
from wayflux.operators import aggregates, joins, ranking, reshape, spatial
from wayflux.operators.cover import greedy_heads
from wayflux.plans.graphs import personalised_rank
from wayflux.session import cut_lineage, salted_join

HOURS = (6, 21)


def node_weights(contacts: DataFrame, distances: DataFrame, scale: float = 1200.0) -> DataFrame:
    """People of each hourly graph with a weight from their distance to infected on the nearest known day."""
    people = contacts.select("date", "hour", F.explode(F.array("id1", "id2")).alias("identifier")).distinct()
    day = joins.nearest_date(contacts, distances)
    dist = distances.groupBy(F.col("date").alias("nearest_date"), "identifier").agg(F.min("attribute_value").alias("d"))
    return (
        people.join(day, "date", "left")
        .join(dist, ["nearest_date", "identifier"], "left")
        .select("date", "hour", "identifier", softplus_weight(F.col("d"), scale).alias("weight"))
    )


def scored_contacts(contacts: DataFrame, distances: DataFrame, scale: float = 1200.0) -> DataFrame:
    """Contacts with the product of their two ends' personalised ranks; all hours in one job."""
    c = contacts.filter(F.col("hour").between(*HOURS))
    nodes = node_weights(c, distances, scale)
    edges = c.groupBy("date", "hour", "id1", "id2").agg(F.count("*").cast("double").alias("weight"))
    rank = cut_lineage(personalised_rank(nodes, edges, ["date", "hour"]))
    a = rank.select("date", "hour", F.col("identifier").alias("id1"), F.col("centrality").alias("_a"))
    b = rank.select("date", "hour", F.col("identifier").alias("id2"), F.col("centrality").alias("_b"))
    one = salted_join(c, a, ["date", "hour", "id1"], spread=["event_id"])
    return salted_join(one, b, ["date", "hour", "id2"], spread=["event_id"]).withColumn("centrality", F.col("_a") * F.col("_b")).drop("_a", "_b")


def hourly_places(scored: DataFrame, share: float = 0.1, digits: int = 12) -> DataFrame:
    """Places of the best-scored share of contacts of each hour, with their counts."""
    rounded = scored.withColumn("centrality", F.round("centrality", digits))
    best = ranking.top_share(rounded, ["date", "hour"], "centrality", "event_id", share)
    return best.groupBy("date", "hour", "lat", "lon").agg(F.count("*").cast("double").alias("total"))


def in_last_days(df: DataFrame, days: int = 14, last=None) -> DataFrame:
    end = aggregates.as_of_date(df, last, "date")
    return df.join(end, F.col("date").between(F.date_sub("_as_of", days), F.col("_as_of"))).drop("_as_of")


def top_by_score(places: DataFrame, digits: int = 3, n: int = 10) -> DataFrame:
    total = places.groupBy(F.round("lat", digits).alias("lat"), F.round("lon", digits).alias("lon")).agg(F.sum("total").alias("total"))
    return ranking.top_rows(total, "total", ["lat", "lon"], n)


def top_by_contacts(contacts: DataFrame, digits: int = 4, n: int = 10) -> DataFrame:
    total = aggregates.contacts_by_place(contacts, digits)
    return ranking.top_rows(total, "total_contacts", ["lat", "lon"], n)


def top_places(contacts: DataFrame, places: DataFrame, box: tuple[float, float, float, float] | None = None, days: int = 14, last=None, n: int = 10) -> DataFrame:
    """The two top lists of the last days, cropped to a box (min_lat, max_lat, min_lon, max_lon)."""
    a = top_by_contacts(in_last_days(contacts, days, last), n=n).select("lat", "lon", F.col("total_contacts").cast("double").alias("total"), F.lit("Contacts Top").alias("type"))
    b = top_by_score(in_last_days(places, days, last), n=n).select("lat", "lon", "total", F.lit("Pagerank Top").alias("type"))
    out = a.unionByName(b)
    if box is None:
        return out
    return out.filter(F.col("lat").between(box[0], box[1]) & F.col("lon").between(box[2], box[3]))


def rolling_top_places(places: DataFrame, days: int = 15, n: int = 10) -> DataFrame:
    """Top places of every window of days + 1 days, windows laid end to end from the first date."""
    from pyspark.sql import Window as W

    first = places.agg(F.min("date").alias("_d0"))
    k = F.floor(F.datediff("date", "_d0") / (days + 1)).cast("int")
    total = (
        places.join(first).withColumn("window_start", F.date_add("_d0", k * (days + 1)))  # one-row side
        .groupBy("window_start", F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon")).agg(F.sum("total").alias("total"))
    )
    keyed = total.withColumn("_tie", F.round("lat", 3) * 1000 * 1_000_000 + F.round("lon", 3) * 1000)
    return ranking.distributed_rank(keyed, ["window_start"], "total", "_tie").filter(F.col("rank") <= n).drop("_tie", "n")


FIRST_TURN = 10_000  # places of the first turn of a merge


def _heads_in_turns(p: DataFrame, reach_km: float) -> DataFrame:
    """The heads of `greedy_heads` (id, lon, lat), found stretch by stretch of the list.

    Each turn takes the next stretch of what earlier heads do not cover, twice as many places as the turn before, and
    pairs those with each other only. Every place is taken or covered in the end, as in one pass.
    """
    todo, heads, size = p.select("id", "lon", "lat"), None, FIRST_TURN
    n = todo.count()
    while heads is None or n:
        turn, rest = todo, None
        if n > size:
            last = todo.agg(F.percentile_approx("id", size / n, 10_000)).first()[0]  # any place will do
            turn, rest = todo.filter(F.col("id") <= last), todo.filter(F.col("id") > last)
        pairs = cut_lineage(spatial.close_pairs(turn, "id", reach_km).select("a", "b"))
        found = greedy_heads(turn.select("id", F.col("id").alias("ord")), pairs)
        new = cut_lineage(turn.join(found, "id", "left_semi"))
        heads = new if heads is None else heads.unionByName(new)
        if rest is None:
            return heads
        covered = spatial.close_pairs(rest, "id", reach_km, new).select(F.col("a").alias("id")).distinct()
        todo = cut_lineage(rest.join(covered, "id", "left_anti"))
        n, size = todo.count(), 2 * size
    return heads


def merge_places(places: DataFrame, radius_m: float = 200.0) -> DataFrame:
    """Places whose circles overlap, merged around the earlier one of the list, totals summed.

    places(id, lon, lat, total); the list order is `id`, a number. A place absorbed by an earlier head
    starts no group of its own; it counts in every head it overlaps, as the sequential pass does.
    Only pairs of a stretch of the list, and of heads and places, are met: heads lie apart, so those grow with the places.
    """
    reach = 2 * radius_m / 1000.0
    p = cut_lineage(places.select("id", "lon", "lat", "total"))
    heads = cut_lineage(_heads_in_turns(p, reach))
    pairs = spatial.close_pairs(p, "id", reach, heads).select(F.col("b").alias("a"), F.col("a").alias("b"))
    members = pairs.unionByName(heads.select(F.col("id").alias("a"), F.col("id").alias("b")))
    return (
        members.join(p.select(F.col("id").alias("b"), "lon", "lat", "total"), "b")
        .groupBy(F.col("a").alias("id"))
        .agg(F.sum("total").alias("total"), F.count("*").alias("n_places"))
        .join(p.select("id", "lon", "lat"), "id")
    )


def enrich_places(places: DataFrame, layers: dict[str, DataFrame], uses: DataFrame, use_classes: list[str], radius_m: float = 200.0, size: float = 0.25) -> DataFrame:
    """Names of the areas of each layer that meet a place's circle, and land-use names by class.

    layers: column → areas(name, rings); uses(name, class, rings). Ranks by total, largest first.
    """
    out = places
    for col, layer in layers.items():
        hit = spatial.circles_meeting_areas(places, layer, "id", "name", radius_m, size)
        out = out.join(hit.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("_n")), ", ").alias(col)), "id", "left")
    tagged = uses.withColumn("name", F.concat_ws("\u0001", "class", "name"))
    hit = spatial.circles_meeting_areas(places, tagged, "id", "name", radius_m, size)
    part = F.split("_n", "\u0001")
    wide = (
        hit.select("id", part[0].alias("class"), part[1].alias("use"))
        .groupBy("id").pivot("class", use_classes).agg(F.array_join(F.array_sort(F.collect_set("use")), ", "))
    )
    out = out.join(wide, "id", "left")
    return ranking.distributed_rank(out, [], "total", "id").drop("n")


def presence(df: DataFrame, cols: list[str]) -> DataFrame:
    """0/1 columns telling whether a list is present."""
    return df.withColumns({c: F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0).cast("bigint") for c in cols})


def old_and_new(history: DataFrame, days: int = 14) -> DataFrame:
    """Places of the last days against those seen before: 'recent', 'historic' or 'both'."""
    end = history.agg(F.date_sub(F.max("date"), days).alias("_cut"))
    flags = history.join(end).groupBy("lat", "lon").agg(  # one-row side
        F.max(F.col("date") > F.col("_cut")).alias("new"), F.max(F.col("date") <= F.col("_cut")).alias("old"), F.sum("total").alias("total")
    )
    kind = F.when(F.col("new") & F.col("old"), "both").when(F.col("new"), "recent").otherwise("historic")
    return flags.select("lat", "lon", "total", kind.alias("kind"))
