"""Data behind the charts: histograms, density, boxes, bars, predicted vs actual."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.operators.columns import ref, require
from gridlark.operators.profiling import top_categories
from gridlark.operators.ranking import column_quantiles, group_quantiles, quantiles


def _present(df: DataFrame, column: str) -> DataFrame:
    require(df, column)
    value = F.nanvl(ref(column).cast("double"), F.lit(None).cast("double")).alias("value")
    return df.select(value).where(F.col("value").isNotNull())


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``(bin, low, high, count)`` of equal-width bins over the non-missing values.

    The last bin includes the maximum. A constant column gets bins of a range one wide
    around its value. Rows are counted per bin on the map side; empty bins are kept.
    """
    values = _present(df, column)
    limits = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    flat = F.col("low") == F.col("high")
    limits = limits.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    step = (F.col("high") - F.col("low")) / bins
    edges = limits.select(F.struct("low", step.alias("step"))).scalar()
    low, step = F.col("edges.low"), F.col("edges.step")
    placed = values.withColumn("edges", edges)
    # The division may be off by one bin at an edge; comparing with the edges settles it.
    guess = F.least(F.floor(F.try_divide(F.col("value") - low, step)), F.lit(bins - 1)).cast("int")
    placed = placed.withColumn("guess", guess)
    guess = F.col("guess")
    bin_of = (
        F.when(F.col("value") < low + step * guess, guess - 1)
        .when((guess < bins - 1) & (F.col("value") >= low + step * (guess + 1)), guess + 1)
        .otherwise(guess)
    )
    counted = placed.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("count"))
    all_bins = limits.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "high"
    )
    width = (F.col("high") - F.col("low")) / bins
    # At most one row per bin on either side.
    return all_bins.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.col("low") + width * F.col("bin")).alias("low"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def center_lines(df: DataFrame, column: str) -> DataFrame:
    """One row with the mean and the exact median of a column."""
    middle = column_quantiles(df, column, {"median": 0.5}).scalar()
    return _present(df, column).agg(F.avg("value").alias("mean")).withColumn("median", middle)


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Append ``residual = label - prediction``."""
    require(df, label, prediction)
    return df.withColumn("residual", ref(label) - ref(prediction))


def residual_histogram(df: DataFrame, label: str = "label", prediction: str = "prediction", bins: int = 50) -> DataFrame:
    return histogram(residuals(df, label, prediction), "residual", bins)


def identity_line(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(low, high)``: joint range of labels and predictions."""
    require(df, label, prediction)
    return df.agg(
        F.least(F.min(ref(label)), F.min(ref(prediction))).alias("low"),
        F.greatest(F.max(ref(label)), F.max(ref(prediction))).alias("high"),
    )


def sample_points(df: DataFrame, share: float, hashed: Column) -> DataFrame:
    """Repeatable sample of points for a scatter chart, by a whole-number hash of a row."""
    return df.where(F.pmod(hashed, F.lit(1_000_000)) < round(share * 1_000_000))


def top_counts(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """Bars of the ``n`` most frequent categories."""
    return top_categories(df, column, n)


def box_statistics(df: DataFrame, category: str, value: str, n: int = 10) -> DataFrame:
    """Box per top-``n`` category: count, quartiles, whiskers, outlier count.

    Whiskers are the outermost values within 1.5 interquartile ranges of the box. The
    number of boxes is at most ``n``, which bounds the broadcast of the fences.
    """
    require(df, category, value)
    number = F.nanvl(ref(value).cast("double"), F.lit(None).cast("double"))
    # Counted once; ranking, quartiles, whiskers and outliers all follow from the counts.
    # Nothing below filters on ``value`` or needs another aggregate: every use is the same exchange.
    counts = (
        df.where(ref(category).isNotNull())
        .select(ref(category).alias(category), number.alias("value"))
        .groupBy(category, "value")
        .agg(F.count("*").alias("rows"))
        .withColumn("weight", F.col("rows") * F.col("value").isNotNull().cast("bigint"))
    )
    top = counts.groupBy(category).agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), category).limit(n)
    # An inner join: a semi join would be moved below the counts.
    kept = counts.join(F.broadcast(top.select(category)), category)
    quarters = quantiles(
        kept.select(category, "value", "weight"), {"q1": 0.25, "median": 0.5, "q3": 0.75}, [category], weighted=True
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quarters.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    joined = counts.join(F.broadcast(fences), category)
    boxes = joined.groupBy(category, "q1", "median", "q3").agg(
        F.sum("weight").alias("count"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("weight"))), F.lit(0)).alias("outliers"),
    )
    # A category without values has no box.
    return boxes.where(F.col("count") > 0)


def box_order(df: DataFrame, category: str, value: str, n: int | None = None) -> DataFrame:
    """Categories by rising median; a chart may take the first ``n``. A null category has no box."""
    require(df, category, value)
    ordered = group_quantiles(df, value, category, {"median": 0.5}).orderBy("median", ref(category))
    return ordered if n is None else ordered.limit(n)


# Cells per bandwidth of the density curve.
FINENESS = 64


def density(df: DataFrame, column: str, points: int = 200, fineness: int = FINENESS) -> DataFrame:
    """``(x, density)``: Gaussian kernel density on an even grid over the data's range.

    Rows are counted once on the map side in cells of ``1 / fineness`` bandwidth, only
    cells that hold rows exist, and each cell stands for its rows by count, mean and
    variance: far values neither widen the cells nor add empty ones, and the curve differs
    from that of single rows by the third power of a cell's share of the bandwidth. The
    bandwidth is Scott's rule, ``std * n ** (-1/5)``.
    """
    values = _present(df, column)
    facts = values.agg(
        F.count("*").alias("n"),
        (F.stddev_samp("value") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("h"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ).select(F.struct("n", "h", "low", "high")).scalar()
    placed = values.withColumn("f", facts)
    cell = F.floor(F.try_divide(F.col("value") - F.col("f.low"), F.col("f.h") / fineness))
    cells = placed.groupBy(cell.alias("cell")).agg(
        F.count("*").alias("count"), F.avg("value").alias("mean"), F.var_pop("value").alias("spread")
    )
    step = (F.col("f.high") - F.col("f.low")) / (points - 1)
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("f.low") + step * i)
    rows = cells.withColumn("f", facts).select("count", "mean", "spread", "f", F.explode(grid).alias("x"))
    z = F.try_divide(F.col("x") - F.col("mean"), F.col("f.h"))
    wide = F.try_divide(F.col("spread"), F.col("f.h") * F.col("f.h")) / 2
    kernel = F.exp(z * z * -0.5) * F.col("count") * (1 + wide * (z * z - 1))
    norm = F.max(F.col("f.n") * F.col("f.h")) * math.sqrt(2 * math.pi)
    return rows.groupBy("x").agg(F.try_divide(F.sum(kernel), norm).alias("density"))
