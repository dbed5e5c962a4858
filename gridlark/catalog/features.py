"""Queries: calendar, route, code and lookup columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlark.catalog.cleaning import KEYS, KEYS_SQL, bad_dates, BAD_DATES
from gridlark.catalog.registry import on_trips, r, register, rnd
from gridlark.functions import calendar as K
from gridlark.functions.codes import class_rank, hour_bin, interactions, stop_flag
from gridlark.functions.text import currency
from gridlark.operators.lookup import route_features, with_airport_name
from gridlark.plans.features import derive_features
from gridlark.plans.trips import trips
from gridlark.sources.tables import read_table


def season_sql(ts: str) -> str:
    return (
        f"CASE WHEN month({ts}) IN (12, 1, 2) THEN 'Winter' WHEN month({ts}) IN (3, 4, 5) THEN 'Spring' "
        f"WHEN month({ts}) IN (6, 7, 8) THEN 'Summer' WHEN month({ts}) IN (9, 10, 11) THEN 'Fall' END"
    )


def seasonality_sql(ts: str) -> str:
    return (
        f"CASE WHEN {ts} IS NULL THEN NULL WHEN month({ts}) IN (12, 1) THEN 'Winter Holidays' "
        f"WHEN month({ts}) IN (3, 4) THEN 'Eid' WHEN month({ts}) = 6 THEN 'Hajj' ELSE 'Regular' END"
    )


def temporal_sql(ts: str, prefix: str = "") -> str:
    return f"""CAST(month({ts}) AS INT) AS {prefix}month, CAST(day({ts}) AS INT) AS {prefix}day,
      CAST(isodow({ts}) - 1 AS INT) AS {prefix}weekday, CAST(dayofyear({ts}) AS INT) AS {prefix}day_of_year,
      CAST(hour({ts}) AS INT) AS {prefix}hour, {season_sql(ts)} AS {prefix}season,
      coalesce(CAST(isodow({ts}) >= 6 AS INT), 0) AS {prefix}is_weekend"""


@register("temporal_features", on_trips(f"SELECT {KEYS_SQL}, {temporal_sql('departure_ts')} FROM trips"))
def temporal_features(spark, d):
    return K.temporal_features(trips(spark, d).select(*KEYS, "departure_ts"), "departure_ts").drop("departure_ts")


@register(
    "temporal_features_from_text",
    on_trips(
        f"SELECT {KEYS_SQL}, {temporal_sql('ts', 'dep_')} FROM (SELECT *, try_cast(departure_text AS TIMESTAMP) AS ts FROM dated)",
        BAD_DATES,
    ),
)
def temporal_features_from_text(spark, d):
    """Text dates, some of them invalid or missing."""
    rows = K.temporal_features(bad_dates(spark, d), "departure_text", "dep_")
    return rows.drop("departure_text", "total_fare")


DISTANCE_SQL = """CASE WHEN src_lat IS NULL OR dst_lat IS NULL THEN 0.0 ELSE 6371 * 2 * atan2(
  sqrt(pow(sin(radians(dst_lat - src_lat) / 2), 2) + cos(radians(src_lat)) * cos(radians(dst_lat)) * pow(sin(radians(dst_lon - src_lon) / 2), 2)),
  sqrt(1 - (pow(sin(radians(dst_lat - src_lat) / 2), 2) + cos(radians(src_lat)) * cos(radians(dst_lat)) * pow(sin(radians(dst_lon - src_lon) / 2), 2)))) END"""
_HOME = "('DAC', 'CGP', 'ZYL', 'CXB', 'JSR', 'BZL', 'RJH', 'SPD')"
ROUTE_TYPE_SQL = f"CASE WHEN source IN {_HOME} AND destination IN {_HOME} THEN 'Domestic' ELSE 'International' END"


@register(
    "route_features",
    on_trips(
        f"SELECT {KEYS_SQL}, source, destination, {r(DISTANCE_SQL)} AS route_distance, {ROUTE_TYPE_SQL} AS route_type FROM trips"
    ),
)
def routes(spark, d):
    rows = route_features(trips(spark, d, located=True).select(*KEYS, "source", "destination"))
    return rows.withColumn("route_distance", rnd("route_distance"))


@register(
    "fare_by_route_type",
    on_trips(
        f"""SELECT route_type, count(*) AS n, {r('avg(total_fare)')} AS mean_fare, {r('sum(km)', 2)} AS km
        FROM (SELECT total_fare, {DISTANCE_SQL} AS km, {ROUTE_TYPE_SQL} AS route_type FROM trips) GROUP BY 1"""
    ),
)
def fare_by_route_type(spark, d):
    rows = route_features(trips(spark, d, located=True).select("source", "destination", "total_fare"))
    return rows.groupBy("route_type").agg(
        F.count("*").alias("n"), rnd(F.avg("total_fare")).alias("mean_fare"), rnd(F.sum("route_distance"), 2).alias("km")
    )


@register(
    "airport_names",
    on_trips(
        f"""SELECT {KEYS_SQL}, CASE WHEN l_partkey % 7 = 0 THEN 'XXX' ELSE source END AS code,
        coalesce((SELECT name FROM airports a WHERE a.code = CASE WHEN l_partkey % 7 = 0 THEN 'XXX' ELSE source END),
        CASE WHEN l_partkey % 7 = 0 THEN 'XXX' ELSE source END) AS airport_name FROM trips"""
    ),
)
def airport_names(spark, d):
    """Some codes are unknown and stand for themselves."""
    code = F.when(F.col("l_partkey") % 7 == 0, "XXX").otherwise(F.col("source"))
    return with_airport_name(trips(spark, d, located=True).select(*KEYS, code.alias("code")), "code", "airport_name")


@register(
    "class_rank",
    on_trips(
        f"""SELECT {KEYS_SQL}, CASE class WHEN 'Economy' THEN 0 WHEN 'Business' THEN 1 WHEN 'First Class' THEN 2 ELSE 0 END AS class
        FROM trips"""
    ),
)
def class_ranks(spark, d):
    return trips(spark, d).select(*KEYS, class_rank(F.col("class")).alias("class"))


@register(
    "stop_flag",
    on_trips(
        f"SELECT {KEYS_SQL}, CASE WHEN l_partkey % 5 <> 0 AND stopovers = 'Direct' THEN 0 ELSE 1 END AS stopovers FROM trips"
    ),
)
def stop_flags(spark, d):
    """Padded and upper-case texts, and some nulls."""
    text = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit(" "), F.upper("stopovers"), F.lit(" ")))
    return trips(spark, d).select(*KEYS, stop_flag(text).alias("stopovers"))


@register(
    "hour_bin",
    on_trips(
        f"""SELECT {KEYS_SQL}, CASE WHEN h BETWEEN 0 AND 5 THEN 0 WHEN h BETWEEN 6 AND 11 THEN 1 WHEN h BETWEEN 12 AND 17 THEN 2
        WHEN h BETWEEN 18 AND 23 THEN 3 END AS bin FROM (SELECT *, hour(departure_ts) + CASE WHEN l_partkey % 9 = 0 THEN 20 ELSE 0 END AS h FROM trips)"""
    ),
)
def hour_bins(spark, d):
    """Some hours are out of range and have no bin."""
    hour = F.hour("departure_ts") + F.when(F.col("l_partkey") % 9 == 0, 20).otherwise(0)
    return trips(spark, d).select(*KEYS, hour_bin(hour).alias("bin"))


@register(
    "interactions",
    on_trips(
        f"SELECT {KEYS_SQL}, days_before, duration_hrs, days_before::DOUBLE * duration_hrs AS days_before_x_duration_hrs FROM trips"
    ),
)
def interaction_columns(spark, d):
    rows = trips(spark, d).select(*KEYS, "days_before", "duration_hrs")
    return interactions(rows, [("days_before", "duration_hrs"), ("days_before", "absent")])


@register(
    "duration_hours",
    on_trips(f"SELECT {KEYS_SQL}, date_diff('microsecond', departure_ts, arrival_ts) / 3600000000.0 AS hours FROM trips"),
)
def durations(spark, d):
    return trips(spark, d).select(*KEYS, K.duration_hours(F.col("departure_ts"), F.col("arrival_ts")).alias("hours"))


@register(
    "event_gap_hours",
    f"SELECT event_id, {r('''date_diff('microsecond', TIMESTAMP '2024-01-15 12:00:00', ts) / 3600000000.0''', 6)} AS hours FROM events",
)
def event_gap_hours(spark, d):
    """Fractions of a second count, and the result may be negative."""
    start = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    rows = read_table(spark, d, "events")
    return rows.select("event_id", rnd(K.duration_hours(start, F.col("ts")), 6).alias("hours"))


@register(
    "days_until",
    f"""SELECT event_id, CAST(greatest(0, floor(date_diff('microsecond', TIMESTAMP '2024-01-15 12:00:00', ts) / 86400000000.0)) AS BIGINT) AS days
    FROM events""",
)
def days_left(spark, d):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return read_table(spark, d, "events").select("event_id", K.days_until(F.col("ts"), now).alias("days"))


@register(
    "seasonality",
    on_trips(f"SELECT {KEYS_SQL}, {seasonality_sql('departure_ts')} AS seasonality FROM trips"),
)
def seasonality_label(spark, d):
    return trips(spark, d).select(*KEYS, K.seasonality(F.col("departure_ts")).alias("seasonality"))


@register(
    "currency_text",
    "SELECT o_orderkey, '৳' || format('{:,.2f}', round(o_totalprice, 2)) AS price FROM orders",
)
def currency_text(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", currency(F.round("o_totalprice", 2)).alias("price"))


DERIVED_SQL = f"""derived AS (SELECT {KEYS_SQL}, total_fare, airline, booking_source, segment, duration_hrs, days_before, source, destination,
  CASE class WHEN 'Economy' THEN 0 WHEN 'Business' THEN 1 WHEN 'First Class' THEN 2 ELSE 0 END AS class,
  CASE WHEN stopovers = 'Direct' THEN 0 ELSE 1 END AS stopovers, {temporal_sql('departure_ts', 'dep_')},
  {temporal_sql('arrival_ts', 'arr_')}, {DISTANCE_SQL} AS route_distance, {ROUTE_TYPE_SQL} AS route_type,
  CAST(hour(departure_ts) // 6 AS INT) AS dep_time_bin FROM trips)"""


@register("derive_features", on_trips(f"SELECT * REPLACE ({r('route_distance')} AS route_distance) FROM derived", DERIVED_SQL))
def derived(spark, d):
    """The whole feature chain before encoding."""
    rows = derive_features(trips(spark, d, located=True).drop("src_lat", "src_lon", "dst_lat", "dst_lon"))
    return rows.withColumn("route_distance", rnd("route_distance"))
