"""Train/test splits and cross-validation folds that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.functions.domain import CV_FOLDS, SEED, TEST_FRACTION
from gridlark.operators.columns import ref, require
from gridlark.operators.ranking import order_statistics

SLICES = 1_000_000


def row_hash(df: DataFrame, seed: int = SEED) -> Column:
    """64-bit hash of a whole row and the seed: the same row always falls the same way."""
    return F.xxhash64(F.lit(seed), *[ref(c) for c in df.columns])


def with_split(
    df: DataFrame, target: str, test_fraction: float | None = None, seed: int | None = None, hash_column: Column | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Append ``is_test`` by hash: no shuffle, about ``test_fraction`` of the rows.

    A fraction of 0 or none stands for the default. Rows that are equal fall on the
    same side, so duplicates cannot leak from train to test.
    """
    require(df, target)
    fraction = test_fraction or TEST_FRACTION
    hashed = hash_column if hash_column is not None else row_hash(df, seed or SEED)
    return df.withColumn("is_test", F.pmod(hashed, F.lit(slices)) < round(fraction * slices))


def exact_split(
    df: DataFrame, target: str, test_fraction: float | None = None, seed: int | None = None, hash_column: Column | None = None
) -> DataFrame:
    """Append ``is_test`` so that exactly ``ceil(n * fraction)`` rows are true.

    The test rows are those with the smallest hashes. The limit, and how many rows lie
    below it, are found by an exact order statistic (bucket counts, no global sort); only rows whose hash equals the
    limit are ordered, by their columns. Rows should be distinct, as they are after
    de-duplication: then that group has a hash collision at most.
    """
    require(df, target)
    fraction = test_fraction or TEST_FRACTION
    hashed = hash_column if hash_column is not None else row_hash(df, seed or SEED)
    marked = df.withColumn("_hash", hashed.cast("bigint"))
    share = F.lit(float(fraction))
    limit = order_statistics(
        marked.select(F.col("_hash").alias("value")), {"limit": lambda n: F.ceil(share * n) - 1}, places=True
    )
    # How many rows with the limit itself are still to be taken.
    open_places = (F.ceil(share * F.col("n")) - F.col("limit_before")).alias("open")
    marked = marked.withColumn("_at", limit.select(F.struct("limit", open_places)).scalar())
    at_limit = F.col("_hash") == F.col("_at.limit")
    ties = marked.where(at_limit).withColumn(
        "_place", F.row_number().over(W.partitionBy("_hash").orderBy(*[ref(c) for c in df.columns]))
    )
    columns = [ref(c) for c in df.columns]
    sure = marked.where(~at_limit).select(*columns, (F.col("_hash") < F.col("_at.limit")).alias("is_test"))
    return sure.unionByName(ties.select(*columns, (F.col("_place") <= F.col("_at.open")).alias("is_test")))


def train_test(df: DataFrame, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """The two sides of a marked frame, without the mark."""
    return df.where(~F.col(flag)).drop(flag), df.where(F.col(flag)).drop(flag)


def hash_folds(df: DataFrame, folds: int = CV_FOLDS, seed: int = SEED, hash_column: Column | None = None) -> DataFrame:
    """Append ``fold`` 0..folds-1 by hash, without a shuffle."""
    hashed = hash_column if hash_column is not None else row_hash(df, seed)
    return df.withColumn("fold", F.pmod(hashed, F.lit(folds)).cast("int"))


def contiguous_folds(df: DataFrame, key: str, folds: int = CV_FOLDS) -> DataFrame:
    """Append ``fold``: blocks of the order of a unique numeric key, not shuffled.

    The first ``n mod folds`` blocks have one row more. Only the block ends are looked
    up (order statistics); rows are compared with them in place.
    """
    require(df, key)

    def last_of(fold: int):
        def position(n: Column) -> Column:
            size = F.floor(n / folds)
            return (fold + 1) * size + F.least(F.lit(fold + 1), n % folds) - 1

        return position

    whole = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    values = df.select(ref(key).cast("bigint" if whole else "double").alias("value"))
    names = [f"e{i}" for i in range(folds - 1)]
    ends = order_statistics(values, {name: last_of(i) for i, name in enumerate(names)})
    marked = df.withColumn("_ends", ends.select(F.struct(*names)).scalar())
    passed = sum(((F.col(f"_ends.{name}") < ref(key)).cast("int") for name in names), F.lit(0))
    return marked.withColumn("fold", passed).drop("_ends")
