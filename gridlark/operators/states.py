"""Profiles as stored states that are merged without reading old data.

A state is one small row per column and part of the data: counts, moments, extremes, and
sketches of distinct values and quantiles. A new part adds its rows; the profile of all parts is
put together from the states alone. A part that is written again replaces its state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.operators.columns import is_missing, numeric_columns, ref, string_columns
from gridlark.operators.profiling import QUARTERS

# Size of a quantile sketch, and the share of the rows by which its ranks may be off (it promises less).
SKETCH_SIZE = 2048
RANK_ERROR = 0.004
DISTINCT_BITS = 14
STATE = "column string, n_rows long, nulls long, mean double, squares double, low double, high double, distinct binary, quantiles binary"


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric or text column, from one pass; a column without values has empty fields.

    Distinct values are sketched over hashes of the values, quantiles over numbers.
    """
    numbers, texts = set(numeric_columns(df)), set(string_columns(df))
    columns = [c for c in columns or df.columns if c in numbers | texts]
    cells = []
    for c in columns:
        missing = is_missing(df, c)
        value = F.when(~missing, ref(c).cast("double")) if c in numbers else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("column"), value.alias("value"), F.when(~missing, F.xxhash64(ref(c))).alias("hash")))
    value = F.col("value")
    return df.select(F.inline(F.array(*cells))).groupBy("column").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("hash").isNull()).alias("nulls"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.hll_sketch_agg("hash", DISTINCT_BITS).alias("distinct"),
        F.kll_sketch_agg_double(value, SKETCH_SIZE).alias("quantiles"),
    )


def write_state(state: DataFrame, folder: str, part: str) -> None:
    """Store the state of one part of the data; writing a part again replaces it."""
    state.write.mode("overwrite").parquet(f"{folder}/part={part}")


def read_states(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{STATE}, part string").option("basePath", folder).parquet(folder)


def merged_profile(states: DataFrame) -> DataFrame:
    """Per column: ``n_rows, nulls, count, mean, std, min, q25, median, q75, max, distinct``.

    All but the quartiles and the number of distinct values are exact.
    """
    n = F.col("n_rows") - F.col("nulls")
    means = states.groupBy(F.col("column").alias("of")).agg(
        F.try_divide(F.sum(F.when(F.col("mean").isNotNull(), F.col("mean") * n)), F.sum(F.when(F.col("mean").isNotNull(), n))).alias("overall")
    )
    # Squares around the overall mean: those inside a part, and the part's distance. One row per column and part.
    apart = F.col("mean") - F.col("overall")
    merged = states.join(F.broadcast(means), F.col("column") == F.col("of")).groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("nulls").alias("nulls"),
        F.max("overall").alias("mean"),
        F.sum(F.col("squares") + n * apart * apart).alias("squares"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.hll_union_agg("distinct").alias("sketch"),
        F.kll_merge_agg_double("quantiles").alias("ranks"),
    )
    count = F.col("n_rows") - F.col("nulls")
    known = F.col("min").isNotNull()
    quarters = [F.when(known, F.kll_sketch_get_quantile_double("ranks", F.lit(p))).alias(name) for name, p in QUARTERS.items()]
    return merged.select(
        "column", "n_rows", "nulls", count.alias("count"), "mean", F.sqrt(F.try_divide(F.col("squares"), count - 1)).alias("std"),
        "min", *quarters, "max", F.hll_sketch_estimate("sketch").alias("distinct"),
    )
