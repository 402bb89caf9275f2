"""Location adapters: raw case tables of each source to canonical cases (and areas)."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.functions import dates, text
from wayflux.operators import joins, reshape, rules, windows
from wayflux.schema import counters


class LocationAdapter(Protocol):
    """What a location provides; `scheme` may be overridden per location."""

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame: ...

    def scheme(self) -> list[rules.Rule]: ...


class Generic:
    def scheme(self) -> list[rules.Rule]:
        return rules.DEFAULT_RULES

    def missing(self, cases: DataFrame, places: DataFrame, show: list[str]) -> DataFrame:
        """Places of cases that the register does not know."""
        return joins.missing_places(cases, places, ["geo_id"], show)


class Bogota(Generic):
    """Protected case list with status, place of care and decimal-comma coordinates."""

    # fixed values: status and care texts
    STATUS = {"recovered": "Recuperado", "diseased": "Fallecido", "infected": "Infectado", "hospital": "Hospital", "icu": "Hospital UCI"}

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        st = F.replace(F.coalesce("status", F.lit("Infectado")), F.lit(" "), F.lit(""))
        df = raw.withColumn("status", F.when(st == "", "Infectado").otherwise(st))
        df = df.filter(F.col("status").isin("Recuperado", "Fallecido", "Infectado")).na.drop()
        df = reshape.status_counters(df, "status", "care", self.STATUS)
        df = df.withColumn("lon", text.decimal_comma(F.col("lon"))).withColumn("lat", text.decimal_comma(F.col("lat")))
        nums = counters(df)
        return df.groupBy("date_time", "geo_id", "location", "lon", "lat").agg(*[F.sum(c).alias(c) for c in nums])

    def blocks(self, raw: DataFrame) -> DataFrame:
        """City blocks: the largest shape of each code, named after it."""
        big = reshape.keep_largest(raw, ["code"], "shape_area", "shape_id")
        return big.select(
            F.col("code").alias("poly_id"), F.concat(F.lit("Manzana "), "code").alias("poly_name"), F.col("shape_area").alias("attr_area"), "geometry"
        )


class Brazil(Generic):
    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        df = raw.filter((F.length("geo_id") > 3) & (F.col("num_cases") > 0))
        places = tables["places"].withColumn("location", F.substring_index("location", "/", 1))
        return df.join(places.select("geo_id", "location", "lon", "lat"), "geo_id")


class Chile(Generic):
    """Cumulative counts: positive only, repaired, made daily, positive only."""

    def daily(self, raw: DataFrame) -> DataFrame:
        df = raw.filter(F.col("num_cases") > 0).na.drop(subset=["geo_id"])
        df = windows.repair_cumulative(df, ["geo_id"], "date_time", "num_cases", "midpoint_or_next")
        return df.withColumn("num_cases", windows.undo_cumulative(["geo_id"], "date_time", "num_cases")).filter("num_cases > 0")

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        return joins.locate_cases(self.daily(raw), tables["places"])


class Colombia(Generic):
    """Case list with dates of onset, diagnosis and death, and the place of care."""

    # fixed values: area centres set by hand
    CENTRES = {"11001": (-74.0939301, 4.6576632), "54001": (-72.495447, 7.890634), "20001": (-73.2548254, 10.4686143)}

    def scheme(self) -> list[rules.Rule]:
        return rules.override(rules.DEFAULT_RULES, rules.COLOMBIA_RULES)

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        def one(cond):
            return F.sum(F.when(cond, 1.0).otherwise(0.0))

        care = F.col("attention")
        hospital, house = care.isin("Hospital", "Hospital UCI"), care == "Casa"
        daily = raw.groupBy(F.col("diagnosis").alias("date_time"), "geo_id").agg(
            F.count("*").cast("double").alias("num_cases"), one(care == "Fallecido").alias("num_diseased"),
            one(care == "Recuperado").alias("num_recovered"), one(hospital | house).alias("num_infected"),
            one(hospital).alias("num_infected_in_hospital"), one(house).alias("num_infected_in_house"),
        )
        areas = tables["areas"].select(
            F.col("poly_id").alias("geo_id"), F.col("poly_name").alias("location"), F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat")
        )
        return joins.keep_empty_places(daily, areas, "geo_id")

    def delay_vectors(self, raw: DataFrame) -> DataFrame:
        """Gamma delay density per area, from onset to diagnosis and from onset to death."""
        df = reshape.valid_delays(raw, "onset", "diagnosis")
        df = reshape.valid_death_delays(df, "onset", "death")
        return rules.agglomerate(df, self.scheme(), ["geo_id"], ["attr_time_delay", "attr_death_time_delay"])

    def centres(self, areas: DataFrame) -> DataFrame:
        lon, lat = F.col("poly_lon"), F.col("poly_lat")
        for k, (x, y) in self.CENTRES.items():
            lon, lat = F.when(F.col("poly_id") == k, x).otherwise(lon), F.when(F.col("poly_id") == k, y).otherwise(lat)
        return areas.withColumn("poly_lon", lon).withColumn("poly_lat", lat)


class Germany(Generic):
    """One column per place, cumulative; rounded to the day, repaired, made daily."""

    WORDS = ["LK ", "SK "]

    def daily(self, raw: DataFrame) -> DataFrame:
        ids = [c for c in raw.columns if c != "date_time"]
        long = raw.unpivot(["date_time"], ids, "geo_id", "num_cases").withColumn("date_time", dates.round_to_day(F.col("date_time")))
        fixed = windows.repair_cumulative(long, ["geo_id"], "date_time", "num_cases", "midpoint")
        return fixed.withColumn("num_cases", windows.undo_cumulative(["geo_id"], "date_time", "num_cases")).filter("num_cases > 0")

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        return joins.locate_cases(self.daily(raw), tables["places"])

    def names(self, register: DataFrame) -> DataFrame:
        return register.withColumn("geo_name", text.strip_words(F.col("name"), self.WORDS)).drop("name")


class Mexico(Generic):
    """One row per place, one column per day of counts."""

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        days = [c for c in raw.columns if c != "geo_id"]
        long = reshape.melt_dates(raw, ["geo_id"], days).withColumn("geo_id", F.col("geo_id").cast("bigint"))
        daily = long.groupBy("date_time", "geo_id").agg(F.sum("num_cases").alias("num_cases"))
        places = tables["places"].withColumn("geo_id", F.col("geo_id").cast("bigint"))
        out = daily.join(places, "geo_id", "left").na.drop(subset=["location", "lon", "lat"])
        return out.groupBy("date_time", "geo_id", "location", "lon", "lat").agg(F.sum("num_cases").alias("num_cases"))


class NewSouthWales(Generic):
    WORDS = ["(A)", "(C)", "(NSW", "(", ")"]

    def daily(self, raw: DataFrame) -> DataFrame:
        df = raw.na.drop(subset=["geo_name"]).withColumn("geo_name", text.strip_words(F.col("geo_name"), self.WORDS))
        return df.select("date_time", text.short_id(F.col("geo_name")).alias("geo_id"), "geo_name", F.lit(1.0).alias("num_cases"))

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        return joins.locate_cases(self.daily(raw), tables["places"])


class Peru(Generic):
    # fixed value: province of cases still being traced
    UNKNOWN = "EN INVESTIGACIÓN"

    def daily(self, raw: DataFrame) -> DataFrame:
        df = raw.withColumn("date_time", dates.parse_lenient(F.col("date_time"), "yyyyMMdd")).na.drop(subset=["date_time"])
        df = df.filter(F.col("province") != self.UNKNOWN)
        out = df.groupBy("date_time", "departement", "province").agg(F.count("*").cast("double").alias("num_cases"))
        return out.withColumn("geo_id", text.pair_id(F.col("departement"), F.col("province"))).withColumn(
            "departement", text.title_case(F.col("departement"))
        ).withColumn("province", text.title_case(F.col("province")))

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        return joins.locate_cases(self.daily(raw).select("date_time", "geo_id", "num_cases"), tables["places"])


class Italy(Generic):
    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        df = raw.filter(F.col("lon") != 0).na.drop(subset=["lon", "lat"])
        if "file_name" in df.columns:  # only files whose name ends in a number
            df = df.filter(F.regexp_like("file_name", F.lit(r"-[0-9]+\.csv$"))).drop("file_name")
        df = windows.repair_cumulative(df, ["geo_id"], "date_time", "num_cases", "look_ahead")
        return df.withColumn("num_cases", windows.undo_cumulative(["geo_id"], "date_time", "num_cases", clip=True))

    def areas(self, cases: DataFrame) -> DataFrame:
        return reshape.to_contract(cases, {"geo_id": "poly_id", "location": "poly_name", "lon": "poly_lon", "lat": "poly_lat"}).distinct()


class UsState(Generic):
    """State slice of a wide cumulative table."""

    def cases(self, raw: DataFrame, state: str = "", **tables: DataFrame) -> DataFrame:
        fixed = ["geo_id", "lat", "lon", "location"]
        days = [c for c in raw.columns if c not in (*fixed, "state")]
        df = reshape.country_slice(raw, "state", state).filter(F.col("lat") != 0)
        long = reshape.melt_dates(reshape.undo_cumulative_wide(df, days), fixed, days)
        return long.filter("num_cases > 0")


class GlobalSeries(Generic):
    """Country slice of a wide cumulative table; rows before the first case are left out."""

    def cases(self, raw: DataFrame, country: str = "", **tables: DataFrame) -> DataFrame:
        days = [c for c in raw.columns if c not in ("province", "country", "lat", "lon")]
        df = raw.filter(F.col("country") == country)
        named = df.withColumn("geo_id", text.province_id(F.col("province"), F.col("country"))).withColumn("location", F.coalesce("province", "country"))
        ids = ["geo_id", "location", "lat", "lon"]
        long = reshape.melt_dates(reshape.undo_cumulative_wide(named, days).select(*ids, *days), ids, days)
        first = long.filter("num_cases > 0").groupBy("geo_id").agg(F.min("date_time").alias("_f"))
        return long.join(first, "geo_id").filter(F.col("date_time") >= F.col("_f")).drop("_f")


class MovementOnly(Generic):
    """No cases: the movement table alone."""

    def cases(self, raw: DataFrame, **tables: DataFrame) -> DataFrame:
        return raw.limit(0)


ADAPTERS: dict[str, type] = {
    "bogota": Bogota, "brazil": Brazil, "chile": Chile, "colombia": Colombia, "germany": Germany, "mexico": Mexico,
    "new_south_wales": NewSouthWales, "peru": Peru, "italy": Italy, "usa_state": UsState, "global_series": GlobalSeries,
    "movement_only": MovementOnly,
}


def adapter(name: str):
    """Adapter by location name; an unknown name raises."""
    if name not in ADAPTERS:
        raise ValueError(f"no adapter for location {name!r}")
    return ADAPTERS[name]()
