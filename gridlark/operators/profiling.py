"""Profiling: dataset info, describe, distributions, frequencies, grouped statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.functions.calendar import season, to_ntz
from gridlark.operators.columns import (
    boolean_columns, date_columns, is_missing, long_form, nan_to_null, numeric_columns, ref, require, string_columns,
)
from gridlark.operators.ranking import column_quantiles, group_quantiles, quantiles

QUARTERS = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def rounded(column: Column, digits: int | None) -> Column:
    """Half-even rounding; ``None`` keeps the value."""
    return column if digits is None else F.bround(column, digits)


def dtype_name(data_type: T.DataType) -> str:
    return data_type.simpleString()


def unpivot_aggregates(df: DataFrame, columns: Sequence[str], fields: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate over all columns, turned into one row per column.

    ``fields`` maps an output field to its aggregate per column.
    """
    aggs = [fields[f][c].alias(f"{f}_{i}") for i, c in enumerate(columns) for f in fields]
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def dataset_info(df: DataFrame) -> DataFrame:
    """Per column: ``dtype, n_rows, n_columns, nulls, null_pct``, from one scan."""
    names = df.columns
    nulls = {c: F.count_if(is_missing(df, c)) for c in names}
    total = F.count(F.lit(1))
    return unpivot_aggregates(
        df,
        names,
        {
            "dtype": {c: F.first(F.lit(dtype_name(df.schema[c].dataType))) for c in names},
            "n_rows": {c: total for c in names},
            "n_columns": {c: F.max(F.lit(len(names))) for c in names},
            "nulls": nulls,
            "null_pct": {c: F.try_divide(nulls[c] * 100.0, total) for c in names},
        },
    )


def missing_report(df: DataFrame) -> DataFrame:
    """``(column, missing, missing_pct)`` of the columns with gaps, largest share first."""
    info = dataset_info(df).where("nulls > 0")
    return info.select("column", F.col("nulls").alias("missing"), F.col("null_pct").alias("missing_pct")).orderBy(
        F.desc("missing_pct"), "column"
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max."""
    columns = columns or numeric_columns(df)
    values = long_form(df, columns, "double")
    stats = quantiles(values, QUARTERS, ["column"], moments=True)
    return stats.select("column", "count", "mean", "std", "min", "q25", "median", "q75", "max")


def _frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = long_form(nan_to_null(df.select(*map(ref, columns))), columns, "string").where(F.col("value").isNotNull())
    return values.groupBy("column", "value").agg(F.count("*").alias("n"))


def _for_each(df: DataFrame, columns: Sequence[str], found: DataFrame) -> DataFrame:
    """A row for every column, also where ``found`` has none; both sides have one row per column at most."""
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
    return names.join(F.broadcast(found), "column", "left")


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text or boolean column: count, distinct values, most frequent value and its count.

    A column without values has a row of zeros, and no most frequent value. A boolean's
    values are ``true`` and ``false``.
    """
    columns = columns or [c for c in df.columns if c in {*string_columns(df), *boolean_columns(df)}]
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("top")))
    found = _frequencies(df, columns).groupBy("column").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), best.alias("best"))
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("count", "unique")]
    return _for_each(df, columns, found).select("column", *counts, F.col("best.top").alias("top"), (-F.col("best.rank")).alias("freq"))


DATE_FIELDS = ("mean_at", "min_at", "q25_at", "median_at", "q75_at", "max_at")


def describe_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per date or timestamp column: count, and mean, min, quartiles and max as timestamps.

    Exact to the microsecond, quartiles between two moments included; the mean is given to
    the second. Dates count as their midnight.
    """
    columns = columns or date_columns(df)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = {c: F.timestamp_diff("MICROSECOND", epoch, to_ntz(ref(c), df.schema[c].dataType).cast("timestamp_ntz")) for c in columns}
    values = long_form(df.select(*[m.cast("double").alias(c) for c, m in micros.items()]), columns, "double")
    stats = quantiles(values, QUARTERS, ["column"], moments=True)
    seconds = stats.withColumn("mean", F.round(F.col("mean") / 1e6) * 1e6)
    moments = [
        F.timestamp_add("MICROSECOND", F.round(name).cast("bigint"), epoch).alias(f"{name}_at")
        for name in ("mean", "min", "q25", "median", "q75", "max")
    ]
    return seconds.select("column", "count", *moments)


def basic_statistics(df: DataFrame) -> DataFrame:
    """Describe of numeric, date, text and boolean columns, one row per column, missing fields null.

    Dates have their statistics in fields of their own (``min_at``, ...), as a field has one type.
    """
    parts = [describe_numeric(df)] if numeric_columns(df) else []
    parts += [describe_dates(df)] if date_columns(df) else []
    parts += [describe_text(df)] if string_columns(df) or boolean_columns(df) else []
    if not parts:
        raise ValueError("no column to describe")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """``(column, unique)``: distinct non-missing values per column; NaN is missing, none are 0.

    Exact counts go through (column, value) groups: one shuffle for all columns and no
    row per column and aggregate. ``approximate`` uses one sketch per column instead.
    """
    columns = columns or df.columns
    if approximate:
        return unpivot_aggregates(df, columns, {"unique": {c: F.approx_count_distinct(ref(c)) for c in columns}})
    present = _frequencies(df, columns).groupBy("column").agg(F.count("*").alias("unique"))
    return _for_each(df, columns, present).select("column", F.coalesce("unique", F.lit(0)).alias("unique"))


def descriptive_statistics(df: DataFrame) -> DataFrame:
    """``basic_statistics`` with missing count and share, distinct values and dtype."""
    info = dataset_info(df)
    joined = (
        info.select("column", "dtype", F.col("nulls").alias("missing"), F.bround("null_pct", 2).alias("missing_pct"))
        .join(F.broadcast(basic_statistics(df).drop("unique")), "column", "left")
        .join(F.broadcast(distinct_counts(df)), "column", "left")
    )
    # Each side has one row per column of the frame.
    return joined.withColumn("unique", F.coalesce("unique", F.lit(0))).withColumn("count", F.coalesce("count", F.lit(0)))


def corrected_skewness(value: Column) -> Column:
    """Bias-corrected sample skewness; 0 for a constant, null below three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.coalesce(F.skewness(value), F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; 0 for a constant, null below four values."""
    n = F.count(value).cast("double")
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n > 3, F.coalesce(corrected, F.lit(0.0)))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median, std, min, max, q25, q75, iqr, skewness, kurtosis."""
    require(df, column)
    value = F.nanvl(ref(column).cast("double"), F.lit(None).cast("double"))
    moments = df.agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        corrected_skewness(value).alias("skewness"),
        corrected_kurtosis(value).alias("kurtosis"),
    )
    quarters = column_quantiles(df, column, QUARTERS).select(F.struct(*QUARTERS)).scalar()
    return (
        moments.withColumn("quarters", quarters)
        .select("*", "quarters.*")
        .select(
            "mean", "median", "std", "min", "max", "q25", "q75", (F.col("q75") - F.col("q25")).alias("iqr"),
            "skewness", "kurtosis",
        )
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """``(category, count)``; null is not a category."""
    require(df, column)
    present = df.where(ref(column).isNotNull())
    return present.groupBy(ref(column).alias("category")).agg(F.count("*").alias("count"))


def top_categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent categories, ties by name (a top-k, not a global sort)."""
    return category_counts(df, column).orderBy(F.desc("count"), "category").limit(n)


def category_frequency(df: DataFrame, column: str, n: int = 10, digits: int | None = 2) -> DataFrame:
    """Top categories with their share of all rows, null rows included in the total."""
    total = df.agg(F.count("*").alias("total")).scalar()
    share = F.try_divide(F.col("count") * 100.0, total)
    return top_categories(df, column, n).withColumn("percentage", rounded(share, digits))


def grouped_statistics(
    df: DataFrame,
    target: str,
    group: str,
    digits: int | None = 2,
    few_groups: bool = False,
    extremes: bool = True,
) -> DataFrame:
    """Count, mean, median, std (and min, max) of ``target`` per value of ``group``.

    The median is exact without holding a group in one task. Null groups are left out; a
    group without any value has count 0. ``few_groups``: the group has a small, known number
    of values, which saves a scan and a shuffle of the value counts.
    """
    require(df, target, group)
    stats = group_quantiles(df, target, group, {"median": 0.5}, few_groups, moments=True)
    order = ["mean", "median", "std"] + (["min", "max"] if extremes else [])
    return stats.select(ref(group), "count", *[rounded(F.col(name), digits).alias(name) for name in order])


def target_by_category(
    df: DataFrame, target: str, category: str, digits: int | None = 2, few_groups: bool = False
) -> DataFrame:
    """Statistics of the target per category, highest mean first."""
    return grouped_statistics(df, target, category, digits, few_groups).orderBy(F.desc("mean"), ref(category))


CALENDAR_GROUPS = {
    "month": F.month,
    "weekday": F.weekday,
    "season": lambda ts: season(F.month(ts)),
}


def temporal_trend(
    df: DataFrame, target: str, date_column: str, by: str = "month", digits: int | None = 2
) -> DataFrame:
    """Count, mean, median, std of the target per month, weekday (Monday 0) or season."""
    require(df, target, date_column)
    if by not in CALENDAR_GROUPS:
        raise ValueError(f"unknown grouping {by!r}; one of {sorted(CALENDAR_GROUPS)}")
    ts = to_ntz(ref(date_column), df.schema[date_column].dataType)
    rows = df.select(CALENDAR_GROUPS[by](ts).alias("group"), ref(target).alias("target"))
    stats = grouped_statistics(rows, "target", "group", digits, few_groups=True, extremes=False)
    return stats.orderBy("group")


def lead_time_profile(df: DataFrame, target: str, days: str, digits: int | None = 2) -> DataFrame:
    """Mean target per booking lead (0-7, 8-14, over 14 days) and its ratio to the overall mean."""
    lead = ref(days)
    bucket = (
        F.when(lead.isNull(), F.lit(None)).when(lead <= 7, "0-7").when(lead <= 14, "8-14").otherwise("15+")
    )
    return premium_by(df.withColumn("_lead", bucket), target, "_lead", digits).withColumnRenamed("_lead", "lead")


def premium_by(df: DataFrame, target: str, group: str, digits: int | None = 2) -> DataFrame:
    """Mean target per group and its ratio to the mean over all rows."""
    overall = df.agg(F.avg(ref(target)).alias("overall")).scalar()
    means = df.where(ref(group).isNotNull()).groupBy(ref(group).alias(group)).agg(
        F.count(ref(target)).alias("count"), F.avg(ref(target)).alias("mean")
    )
    ratio = F.try_divide(F.col("mean"), overall)
    return means.select(group, "count", rounded(F.col("mean"), digits).alias("mean"), rounded(ratio, 4).alias("ratio"))
