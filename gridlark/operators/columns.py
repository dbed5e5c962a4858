"""Schema helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def ref(name: str) -> Column:
    """Column by its exact name, also when it holds spaces, dots or ``&``."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def is_missing(df: DataFrame, name: str) -> Column:
    """True for NULL, and for NaN in a float column."""
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return (ref(name).isNull() | F.isnan(ref(name))) if floating else ref(name).isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL, so that aggregates and filters skip it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({name: F.nanvl(ref(name), F.lit(None).cast("double")) for name in floats})


def long_form(df: DataFrame, names: Sequence[str], data_type: str) -> DataFrame:
    """``(column, value)`` rows of the named columns, in the scan's own stage."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column"), ref(n).cast(data_type).alias("value")) for n in names]
    )
    return df.select(F.inline(pairs))
