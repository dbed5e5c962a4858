"""Regression metrics as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.operators.columns import ref

METRICS = ("r2_score", "rmse", "mae", "mape")


def metric_columns(label: Column, prediction: Column) -> dict[str, Column]:
    """R², RMSE, MAE, MAPE in percent, and the zero labels that MAPE leaves out.

    The spread of the label is its population variance times n, so one pass is enough.
    A constant label gives R² 1 for a perfect prediction and 0 otherwise.
    """
    error = label - prediction
    squared, spread = F.sum(error * error), F.var_pop(label) * F.count(label)
    r2 = F.when(spread == 0, F.when(squared == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(squared, spread))
    share = F.try_divide(F.abs(error), F.abs(label))
    return {
        "r2_score": r2,
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(share) * 100,
        "mape_skipped": F.count_if(label == 0),
    }


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row (or one per ``by`` group) with all metrics, from a single aggregate."""
    columns = metric_columns(ref(label).cast("double"), ref(prediction).cast("double"))
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in columns.items()])


def metrics_of_predictions(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """``(model, metric, value)`` of several prediction columns, from one pass over the rows.

    ``predictions`` maps a model name to its column.
    """
    truth = ref(label).cast("double")
    aggs, cells = [], []
    for i, (model, column) in enumerate(predictions.items()):
        all_of_it = metric_columns(truth, ref(column).cast("double"))
        for name in METRICS:
            aggs.append(all_of_it[name].alias(f"{name}_{i}"))
            cells.append(
                F.struct(F.lit(model).alias("model"), F.lit(name).alias("metric"), F.col(f"{name}_{i}").alias("value"))
            )
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def long_metrics(wide: DataFrame, model: Column | str = "model", names: Sequence[str] = METRICS) -> DataFrame:
    """``(model, metric, value)`` rows of a wide metrics table."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), ref(m).cast("double").alias("value")) for m in names])
    return wide.select(F.col(model).alias("model") if isinstance(model, str) else model.alias("model"), F.inline(cells))


def fold_summary(by_fold: DataFrame, names: Sequence[str] = ("r2_score", "rmse", "mae")) -> DataFrame:
    """``(metric, mean, std)`` over folds, with the population standard deviation."""
    return (
        long_metrics(by_fold, F.lit("cv"), names)
        .groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )
