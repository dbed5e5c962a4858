"""The production fare table: its CSV schema and the short names used here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.functions.domain import PRODUCTION_COLUMNS
from gridlark.operators.cleaning import parse_dates
from gridlark.sources.csv import read_csv

DATES = ("departure_ts", "arrival_ts")
NUMBERS = {"duration_hrs": T.DoubleType(), "base_fare": T.DoubleType(), "tax": T.DoubleType(), "total_fare": T.DoubleType(), "days_before": T.LongType()}


def fare_schema() -> T.StructType:
    """All columns in file order; dates are text, since they are parsed with a check."""
    return T.StructType(
        [T.StructField(title, NUMBERS.get(name, T.StringType())) for name, title in PRODUCTION_COLUMNS.items()]
    )


def read_fares(spark: SparkSession, path: str) -> DataFrame:
    """Fares from CSV under their short names, dates parsed (null where they cannot be)."""
    raw = read_csv(spark, path, fare_schema())
    return parse_dates(raw.toDF(*PRODUCTION_COLUMNS), DATES)


def production_names(df: DataFrame) -> DataFrame:
    """All production columns under their titles; absent ones are null."""
    kinds = {f.name: f.dataType for f in fare_schema().fields}
    return df.select(
        [
            (F.col(name) if name in df.columns else F.lit(None).cast(kinds[title])).alias(title)
            for name, title in PRODUCTION_COLUMNS.items()
        ]
    )
