"""Calendar expressions: parts of a timestamp, seasons, lead time, duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.functions.domain import SEASON_MONTHS, SEASONALITY_MONTHS

TEMPORAL_PARTS = ("month", "day", "weekday", "day_of_year", "hour", "season", "is_weekend")


def label_of_month(month: Column, table: dict[str, tuple[int, ...]]) -> Column:
    """Label whose month list holds ``month``; null when none does."""
    return F.coalesce(*[F.when(month.isin(*months), F.lit(label)) for label, months in table.items()])


def season(month: Column) -> Column:
    return label_of_month(month, SEASON_MONTHS)


def seasonality(ts: Column) -> Column:
    """Holiday period of a date; a null date gives null, other months ``Regular``."""
    label = label_of_month(F.month(ts), SEASONALITY_MONTHS)
    return F.when(ts.isNotNull(), F.coalesce(label, F.lit("Regular")))


def weekend_flag(weekday: Column) -> Column:
    """1 on Saturday and Sunday (Monday is 0); a missing date counts as 0."""
    return F.coalesce((weekday >= 5).cast("int"), F.lit(0))


def to_ntz(column: Column, data_type: T.DataType, fmt: str | None = None) -> Column:
    """Timestamp of a string column, null where it cannot be parsed; others pass."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(data_type, T.DateType):
        return column.cast("timestamp_ntz")
    if fmt is not None:
        return F.try_to_timestamp(column, F.lit(fmt)).cast("timestamp_ntz")
    return column.try_cast("timestamp_ntz")


def temporal_columns(ts: Column, prefix: str = "") -> dict[str, Column]:
    """The seven calendar features of a timestamp, named ``prefix`` + part."""
    weekday = F.weekday(ts)
    parts = {
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "weekday": weekday,
        "day_of_year": F.dayofyear(ts),
        "hour": F.hour(ts),
        "season": season(F.month(ts)),
        "is_weekend": weekend_flag(weekday),
    }
    return {f"{prefix}{name}": parts[name] for name in TEMPORAL_PARTS}


def temporal_features(df: DataFrame, date_column: str, prefix: str = "") -> DataFrame:
    """Append the calendar features; a frame without the column is returned as is."""
    if date_column not in df.columns:
        return df
    ts = to_ntz(F.col(f"`{date_column}`"), df.schema[date_column].dataType)
    return df.withColumns(temporal_columns(ts, prefix))


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end`` (negative when reversed)."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double")


def duration_hours(departure: Column, arrival: Column) -> Column:
    return micros_between(departure, arrival) / F.lit(3600e6)


def days_until(departure: Column, now: Column) -> Column:
    """Whole days from ``now`` to ``departure``, rounded down, never negative."""
    days = F.floor(micros_between(now, departure) / F.lit(86400e6))
    return F.when(days.isNotNull(), F.greatest(F.lit(0).cast("bigint"), days))
