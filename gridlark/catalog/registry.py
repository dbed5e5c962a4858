"""Registration of queries with optional SQL, and the SQL text of ``trips``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.sources.tables import airport_rows_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under a name; ``sql`` gives the same rows in DuckDB."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def rnd(column: Column | str, digits: int = 4) -> Column:
    """Rounded double, so that the order of float additions does not show."""
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def round_all(df: DataFrame, digits: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """All double columns rounded."""
    doubles = [c for c, t in df.dtypes if t == "double" and c not in skip]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def r(expression: str, digits: int = 4) -> str:
    """SQL of a rounded double without a negative zero."""
    return f"(round({expression}, {digits}) + 0.0)"


AIRPORTS_SQL = f"airports AS (SELECT * FROM ({airport_rows_sql()}) AS t(id, code, lat, lon, name))"

TRIPS_SQL = """trips AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE s_name END AS airline,
    src.code AS source, src.lat AS src_lat, src.lon AS src_lon,
    dst.code AS destination, dst.lat AS dst_lat, dst.lon AS dst_lon,
    l_shipdate + INTERVAL '1' HOUR * CAST(l_orderkey % 24 AS INT) AS departure_ts,
    l_shipdate + INTERVAL '1' HOUR * CAST(l_orderkey % 24 + l_quantity AS INT) AS arrival_ts,
    CAST(greatest(0, datediff('day', o_orderdate, l_shipdate)) AS INT) AS days_before,
    CASE l_returnflag WHEN 'A' THEN 'Direct' WHEN 'N' THEN '1 Stop' ELSE '2 Stops' END AS stopovers,
    CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') THEN 'Economy' WHEN p_type = 'STANDARD' THEN 'Business'
         WHEN p_type = 'LARGE' THEN 'First Class' ELSE 'Premium' END AS class,
    o_orderpriority AS booking_source,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS segment,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS duration_hrs,
    l_extendedprice * (1 - l_discount) AS base_fare,
    l_extendedprice * (1 - l_discount) * l_tax AS tax,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_fare
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  LEFT JOIN airports src ON c_nationkey = src.id LEFT JOIN airports dst ON s_nationkey = dst.id)"""


def on_trips(select: str, *ctes: str) -> str:
    """SQL over ``trips`` and ``airports`` with further named subqueries."""
    return "WITH " + ",\n".join([AIRPORTS_SQL, TRIPS_SQL, *ctes]) + "\n" + select
