"""Rule-based findings over the profiling results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.operators.association import strong_pairs
from gridlark.operators.profiling import category_counts, corrected_skewness
from gridlark.operators.columns import ref

MANY_CATEGORIES = 50


def _finding(rows: DataFrame, rule: str, column: str, value: Column, when: Column, message: Column) -> DataFrame:
    return rows.where(when).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column"), value.cast("double").alias("value"), message.alias("message")
    )


def _quoted(column: str) -> str:
    """A column name inside a format pattern."""
    return "'" + column.replace("%", "%%") + "'"


def target_insights(df: DataFrame, target: str) -> DataFrame:
    """Skewed target (``abs > 1``) and high variation (``std / mean > 0.5``)."""
    value = ref(target).cast("double")
    shape = df.agg(
        corrected_skewness(value).alias("skew"), F.try_divide(F.stddev_samp(value), F.avg(value)).alias("cv")
    )
    skew, cv = F.col("skew"), F.col("cv")
    skewed = _finding(
        shape, "skewed_target", target, skew, F.abs(skew) > 1,
        F.format_string("the target leans to one side, skewness %.2f", skew),
    )
    varied = _finding(
        shape, "high_variance", target, cv, cv > 0.5, F.format_string("the target varies widely, %.2f standard deviations per mean", cv)
    )
    return skewed.unionByName(varied)


def category_insights(df: DataFrame, column: str) -> DataFrame:
    """More than 50 categories; one category with more than half of all rows."""
    total = df.agg(F.count("*").alias("n")).scalar()
    best = F.min(F.struct((-F.col("count")).alias("rank"), F.col("category").alias("category")))
    shape = (
        category_counts(df, column)
        .agg(F.count("*").alias("kinds"), best.alias("best"))
        .select("kinds", F.col("best.category").alias("top"), F.try_divide(-F.col("best.rank"), total).alias("share"))
    )
    kinds, share = F.col("kinds"), F.col("share")
    many = _finding(
        shape, "high_cardinality", column, kinds, kinds > MANY_CATEGORIES,
        F.format_string(f"{_quoted(column)} takes %d different values", kinds),
    )
    dominant = _finding(
        shape, "dominant_category", column, share, share > 0.5,
        F.format_string(f"{_quoted(column)} is mostly %s, in %.1f%% of the rows", F.col("top"), share * 100),
    )
    return many.unionByName(dominant)


def group_insights(df: DataFrame, target: str, column: str) -> DataFrame:
    """Range of the group means above half of the overall mean."""
    value = ref(target).cast("double")
    overall = df.agg(F.avg(value).alias("m")).scalar()
    means = df.where(ref(column).isNotNull()).groupBy(ref(column)).agg(F.bround(F.avg(value), 2).alias("mean"))
    shape = means.agg((F.max("mean") - F.min("mean")).alias("spread")).withColumn("overall", overall)
    spread = F.col("spread")
    return _finding(
        shape, "strong_group_effect", column, spread, F.try_divide(spread, F.col("overall")) > 0.5,
        F.format_string(f"the means by {_quoted(column)} lie %.2f apart", spread),
    )


def correlation_insights(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many column pairs correlate above 0.8, when any does."""
    shape = strong_pairs(df, columns=columns).agg(F.count("*").alias("pairs"))
    pairs = F.col("pairs")
    return _finding(
        shape, "multicollinearity", "*", pairs, pairs > 0,
        F.format_string("%d column pairs move together", pairs),
    )


def insights(df: DataFrame, target: str, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """All findings as ``(rule, column, value, message)``."""
    found = [target_insights(df, target)]
    for column in categories:
        found += [category_insights(df, column), group_insights(df, target, column)]
    if len(numbers) > 1:
        found.append(correlation_insights(df, numbers))
    return reduce(DataFrame.unionByName, found)
