"""Cleaning: duplicates, missing values, dates, ranges, outliers, text, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.functions.calendar import to_ntz
from gridlark.functions.text import clean_names, title_case
from gridlark.operators.columns import is_missing, long_form, numeric_columns, ref, require, string_columns
from gridlark.operators.ranking import column_quantiles, quantiles
from gridlark.sources.shared import materialize

DEFAULT_FILL = {"numerical": "median", "categorical": "mode"}


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows; nulls are equal. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: ``rows``, ``removed`` and ``removed_pct`` of a de-duplication."""
    copies = df.groupBy(*[ref(c) for c in df.columns]).agg(F.count("*").alias("_copies"))
    total, kept = F.coalesce(F.sum("_copies"), F.lit(0)), F.count("*")
    return copies.agg(
        total.alias("rows"),
        (total - kept).alias("removed"),
        (F.try_divide(total - kept, total) * 100).alias("removed_pct"),
    )


def numeric_fill_values(df: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    """``(column, fill)`` rows: median or mean of each column (no row if all null)."""
    values = long_form(df, columns, "double")
    if strategy == "median":
        return quantiles(values, {"fill": 0.5}, ["column"])
    present = values.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return present.groupBy("column").agg(F.avg("value").alias("fill"))


def text_fill_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, fill)`` rows with the most frequent text; the smallest one wins ties.

    Values are counted per (column, value) first, so no task sees a whole column.
    """
    counts = long_form(df, columns, "string").where(F.col("value").isNotNull()).groupBy("column", "value").count()
    best = F.min(F.struct((-F.col("count")).alias("rank"), F.col("value").alias("fill")))
    return counts.groupBy("column").agg(best.alias("best")).select("column", F.col("best.fill").alias("fill"))


def _as_lookup(fills: DataFrame) -> Column:
    """A ``(column, fill)`` table (one row per column) as one map, in a scalar subquery."""
    return fills.agg(F.map_from_entries(F.collect_list(F.struct("column", "fill"))).alias("fills")).scalar()


def columns_with_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Names of the columns that have a missing value (one pass, one row read back)."""
    if not columns:
        return []
    found = df.agg(*[F.bool_or(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if found[i]]


def fill_missing(
    df: DataFrame, strategy: dict[str, str] | None = None, columns: Sequence[str] | None = None, values: DataFrame | None = None
) -> DataFrame:
    """Replace missing numbers and texts, then drop rows that became duplicates.

    Numbers: ``median`` (default), ``mean`` or, for any other word, 0. Texts: ``mode``
    (default) or, for any other word, ``Unknown``. A numeric column without any value
    stays null (except for the 0 rule); a text column without any becomes ``Unknown``.
    A filled numeric column is a double, as its fill may be fractional.

    Only ``columns`` are filled; left out, the columns with missing values are found by
    one pass over the data, which spares the others the work of a median or mode. ``values`` are
    these columns of all rows, if they are stored: medians and modes then don't make ``df`` again.
    """
    strategy = strategy or DEFAULT_FILL
    values = df if values is None else values
    numbers, texts = numeric_columns(df), string_columns(df)
    if columns is None:
        columns = columns_with_missing(df, numbers + texts)
    numbers = [c for c in numbers if c in columns]
    texts = [c for c in texts if c in columns]
    filled: dict[str, Column] = {}
    if numbers:
        from_data = strategy["numerical"] in ("median", "mean")
        fills = _as_lookup(numeric_fill_values(values, numbers, strategy["numerical"])) if from_data else None
        for name in numbers:
            fill = F.try_element_at(fills, F.lit(name)) if from_data else F.lit(0.0)
            filled[name] = F.coalesce(F.nanvl(ref(name).cast("double"), F.lit(None)), fill)
    if texts:
        from_data = strategy["categorical"] == "mode"
        modes = _as_lookup(text_fill_values(values, texts)) if from_data else None
        for name in texts:
            known = [F.try_element_at(modes, F.lit(name))] if from_data else []
            filled[name] = F.coalesce(ref(name), *known, F.lit("Unknown"))
    return drop_duplicates(df.withColumns(filled))


def parse_dates(df: DataFrame, columns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Turn the listed columns into timestamps, null where unparsable; absent ones are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_ntz(ref(c), df.schema[c].dataType, fmt) for c in present})


def date_failures(df: DataFrame, columns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """``(column, failed)``: how many non-null values of each column cannot be parsed."""
    present = [c for c in columns if c in df.columns]
    counts = [
        F.count_if(ref(c).isNotNull() & to_ntz(ref(c), df.schema[c].dataType, fmt).isNull()).alias(c) for c in present
    ]
    one_row = df.agg(*counts)
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), ref(c).alias("failed")) for c in present]))
    )


def drop_below(df: DataFrame, column: str, minimum: float = 0) -> DataFrame:
    """Drop rows below ``minimum``; rows without a value stay."""
    if column not in df.columns:
        return df
    return df.where(~F.coalesce(ref(column) < minimum, F.lit(False)))


def outlier_bounds(df: DataFrame, column: str, spread: float = 3.0) -> DataFrame:
    """One row ``q1, q3, upper`` with ``upper = q3 + spread * (q3 - q1)``; no upper if q3 = q1."""
    quarters = column_quantiles(df, column, {"q1": 0.25, "q3": 0.75})
    width = F.col("q3") - F.col("q1")
    return quarters.withColumn("upper", F.when(width > 0, F.col("q3") + spread * width))


def drop_high_outliers(df: DataFrame, column: str, spread: float = 3.0) -> DataFrame:
    """Drop rows above the upper bound (there is no lower one); rows without a value stay."""
    upper = outlier_bounds(df, column, spread).select("upper").scalar()
    return df.where(~F.coalesce(ref(column) > upper, F.lit(False)))


def fix_invalid_values(df: DataFrame, target: str, minimum: float = 0) -> DataFrame:
    """Range filter, then the outlier filter with bounds of what is left."""
    if target not in df.columns:
        return df
    return drop_high_outliers(drop_below(df, target, minimum), target)


def cap_at_quantile(df: DataFrame, column: str, q: float = 0.999) -> DataFrame:
    """Keep rows at or below a quantile; rows without a value go."""
    cap = column_quantiles(df, column, {"cap": q}).scalar()
    return df.where(ref(column) <= cap)


def standardize_text(df: DataFrame, column: str) -> DataFrame:
    """Trim and title-case a text column; other columns pass unchanged."""
    if column not in string_columns(df):
        return df
    return df.withColumn(column, title_case(ref(column)))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def features_and_label(df: DataFrame, target: str) -> DataFrame:
    """All feature columns followed by the target as ``label``."""
    require(df, target)
    features = [ref(c) for c in df.columns if c != target]
    return df.select(*features, ref(target).cast("double").alias("label"))


def clean(df: DataFrame, strategy: dict[str, str] | None = None) -> DataFrame:
    """De-duplicate, fill missing values, de-duplicate again.

    The filling step reads the distinct rows several times, so they are written once to
    the shared checkpoint folder instead of being shuffled anew for each pass.
    """
    return fill_missing(materialize(drop_duplicates(df)), strategy)


def cleaning_report(df: DataFrame, strategy: dict[str, str] | None = None) -> DataFrame:
    """``(step, rows)`` after loading, de-duplication and filling."""
    unique = materialize(drop_duplicates(df))
    filled = fill_missing(unique, strategy)
    steps = [("loaded", df), ("unique", unique), ("filled", filled)]
    counts = [frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("step"), "rows") for name, frame in steps]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def row_gate(df: DataFrame, minimum: int) -> DataFrame:
    """One row ``(n_rows, ok)``: are there at least ``minimum`` rows?"""
    return df.agg(F.count("*").alias("n_rows"), (F.count("*") >= minimum).alias("ok"))


def require_rows(df: DataFrame, minimum: int) -> int:
    """The row count; raises ``ValueError`` when it is below ``minimum``."""
    found = row_gate(df, minimum).first()
    if not found["ok"]:
        raise ValueError(f"too few rows: {found['n_rows']} (minimum {minimum})")
    return found["n_rows"]
