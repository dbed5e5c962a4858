"""Parquet tables of a data folder, and the fixed airport dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlark.functions.domain import AIRPORTS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def airport_rows_sql() -> str:
    """The airport dimension as an SQL ``VALUES`` list of (id, code, lat, lon, name)."""
    rows = []
    for i, (code, lat, lon, name) in enumerate(AIRPORTS):
        quoted = "'" + name.replace("'", "''") + "'"
        rows.append(f"({i}, '{code}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE), {quoted})")
    return "VALUES " + ", ".join(rows)


def airports(spark: SparkSession) -> DataFrame:
    """The 20 airports: ``id, code, lat, lon, name``."""
    # Spark reads '' inside a literal as two joined literals, so it gets a backslash.
    rows = airport_rows_sql().replace("''", "\\'")
    return spark.sql(f"SELECT * FROM {rows} AS t(id, code, lat, lon, name)")
