"""A trend over a stream: value counts per group, merged from what every batch has stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlark.functions.calendar import to_ntz
from gridlark.operators.columns import ref, require
from gridlark.operators.profiling import CALENDAR_GROUPS, rounded
from gridlark.operators.ranking import quantiles

COUNTS = "group string, value double, n long"


def accumulate_trend(
    stream: DataFrame, target: str, date_column: str, by: str, folder: str, checkpoint: str, key: str | None = None, delay: str | None = None
) -> StreamingQuery:
    """Store the value counts of everything that has arrived, one part per batch.

    A batch that is run again after a failure replaces its own part, so every row counts
    once; rows of any age count, also in late files. With a ``key`` (and a ``delay``, how far
    apart copies may be) rows that were sent twice count once: the keys of that time are
    the stream's state, bounded by its watermark, and rows older than that are dropped.
    """
    require(stream, target, date_column)
    if by not in CALENDAR_GROUPS:
        raise ValueError(f"unknown grouping {by!r}; one of {sorted(CALENDAR_GROUPS)}")
    if key is not None:
        if delay is None:
            raise ValueError("a key needs a delay")
        stream = stream.withWatermark(date_column, delay).dropDuplicatesWithinWatermark([key])
    ts = to_ntz(ref(date_column), stream.schema[date_column].dataType)
    rows = stream.select(CALENDAR_GROUPS[by](ts).cast("string").alias("group"), ref(target).cast("double").alias("value"))

    def store(batch: DataFrame, number: int) -> None:
        counts = batch.where("group IS NOT NULL").groupBy("group", "value").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stored_trend(spark: SparkSession, folder: str, digits: int | None = 2) -> DataFrame:
    """``group, count, mean, median, std`` of all batches, as the batch trend has them; groups are text."""
    parts = spark.read.schema(f"{COUNTS}, batch long").option("basePath", folder).parquet(folder)
    counts = parts.groupBy("group", "value").agg(F.sum("n").alias("n"))
    value, n = F.col("value"), F.col("n")
    present = F.when(value.isNotNull(), n)
    means = counts.groupBy("group").agg(F.coalesce(F.sum(present), F.lit(0)).alias("count"), F.try_divide(F.sum(value * n), F.sum(present)).alias("mean"))
    # A calendar has few groups.
    apart = counts.join(F.broadcast(means), "group").groupBy("group").agg(F.sum(n * (value - F.col("mean")) ** 2).alias("squares"))
    medians = quantiles(counts.select("group", "value", n.alias("weight")), {"median": 0.5}, ["group"], few_keys=True, weighted=True)
    joined = means.join(F.broadcast(apart), "group").join(F.broadcast(medians), "group", "left")
    std = F.sqrt(F.try_divide(F.col("squares"), F.col("count") - 1))
    return joined.select("group", "count", *[rounded(c, digits).alias(name) for name, c in (("mean", F.col("mean")), ("median", F.col("median")), ("std", std))])
