"""``trips``: one row per order line, in the shape of the production fare table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.sources.tables import airports, read_table


def _null_every(modulus: int, value: Column) -> Column:
    return F.when(F.col("l_orderkey") % modulus != 0, value)


def _with_airports(spark: SparkSession, joined: DataFrame) -> DataFrame:
    places = airports(spark)
    src = places.select(
        F.col("id").alias("c_nationkey"), F.col("code").alias("source"),
        F.col("lat").alias("src_lat"), F.col("lon").alias("src_lon"),
    )
    dst = places.select(
        F.col("id").alias("s_nationkey"), F.col("code").alias("destination"),
        F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"),
    )
    return joined.join(F.broadcast(src), "c_nationkey", "left").join(F.broadcast(dst), "s_nationkey", "left")


def trips(spark: SparkSession, folder: str, located: bool = False) -> DataFrame:
    """Star join of the order tables; ``located`` adds the two airports of a trip.

    Only the 20-row airport dimension is broadcast by hint; the other sides grow with
    the data, so their join strategy is left to the size statistics and AQE. Where all are
    shuffled, the lines move once for the parts and once for the orders, which have met their
    customers before. The fares' few-valued factors move, which compress better than fares.
    """
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderpriority"
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_name"
    )
    parts = read_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    joined = lines.join(parts, "l_partkey").join(orders.join(customers, "c_custkey"), "l_orderkey").join(suppliers, "l_suppkey")
    places = []
    if located:
        joined = _with_airports(spark, joined)
        places = ["source", "src_lat", "src_lon", "destination", "dst_lat", "dst_lon"]

    hour = (F.col("l_orderkey") % 24).cast("int")
    travel = (F.col("l_orderkey") % 24 + F.col("l_quantity")).cast("int")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    kind = F.col("p_type")
    travel_class = (
        F.when(kind.isin("ECONOMY", "SMALL", "MEDIUM"), "Economy")
        .when(kind == "STANDARD", "Business")
        .when(kind == "LARGE", "First Class")
        .otherwise("Premium")
    )
    stops = (
        F.when(F.col("l_returnflag") == "A", "Direct").when(F.col("l_returnflag") == "N", "1 Stop").otherwise("2 Stops")
    )
    lead = F.date_diff(F.col("l_shipdate"), F.col("o_orderdate"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        _null_every(17, F.col("s_name")).alias("airline"),
        *places,
        (F.col("l_shipdate") + F.make_dt_interval(hours=hour)).alias("departure_ts"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=travel)).alias("arrival_ts"),
        F.greatest(F.lit(0), lead).alias("days_before"),
        stops.alias("stopovers"),
        travel_class.alias("class"),
        F.col("o_orderpriority").alias("booking_source"),
        _null_every(13, F.col("c_mktsegment")).alias("segment"),
        _null_every(11, F.col("l_quantity")).alias("duration_hrs"),
        net.alias("base_fare"),
        (net * F.col("l_tax")).alias("tax"),
        (net * (1 + F.col("l_tax"))).alias("total_fare"),
    )
