"""Exact ranks, running counts and quantiles that never sort a whole group in one task.

Values are cut into buckets by the logarithm of their size (doubles) or their leading bits
(whole numbers), and buckets into parts by their ratio to the bucket's lower end. Running totals go over bucket counts; rows are only ordered within one
part of a bucket, which has a fixed number of possible values whatever the distribution. Equal values are
counted before they are moved, so a value held by a third of all rows is one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.operators.columns import ref

# Buckets of the first level: so many to a doubling of the value, or a run of whole numbers that
# share all but the last bits.
PER_DOUBLING = 64
ZERO_AT = 1 << 20
COARSE_BITS = 45
# Parts of a bucket: steps of the value's ratio to the bucket's lower end, or further bits.
FINE_STEPS = float(1 << 29)
FINE_BITS = 22
MISSING_BUCKET = -(1 << 40)


def coarse_bucket(value: Column, whole_numbers: bool = False) -> Column:
    """First level: a whole number that never falls as the value rises.

    Doubles go by the logarithm of their size, one call a row: no more than ``2 ** 18``
    buckets whatever the data. A missing value has a bucket of its own: as the result is
    never null, a join on it adds no filter below a shuffle, and all uses of the bucketed
    rows stay one plan. Generated code stays small enough to be compiled: a longer
    expression here makes every pass several times slower.
    """
    if whole_numbers:
        return F.coalesce(F.shiftright(value, COARSE_BITS), F.lit(MISSING_BUCKET))
    # The logarithm of zero is null; infinity's is taken as one above all others.
    step = F.floor(F.least(F.log2(F.abs(value)), F.lit(2048.0)) * PER_DOUBLING) + ZERO_AT
    return F.coalesce(F.signum(value).cast("bigint") * step, F.when(value.isNotNull(), 0).otherwise(MISSING_BUCKET))


def fine_bucket(value: Column, coarse: Column, whole_numbers: bool = False) -> Column:
    """Second level inside a bucket of the first, rising with the value too: at most ``2 ** 23`` parts.

    Values of one part agree in some 35 leading bits, so a part has a fixed number of
    possible values. The divisor is one number for a whole bucket, which keeps the order.
    """
    if whole_numbers:
        parts = (1 << (COARSE_BITS - FINE_BITS)) - 1
        return F.coalesce(F.shiftright(value, FINE_BITS).bitwiseAND(F.lit(parts)), F.lit(0).cast("bigint"))
    # A zero divisor is that of zero's bucket, which has one part.
    lower = F.pow(F.lit(2.0), (F.abs(coarse) - ZERO_AT) / F.lit(float(PER_DOUBLING)))
    return F.coalesce(F.floor(F.try_divide(value, lower) * FINE_STEPS), F.lit(0).cast("bigint"))


def before(partition: Sequence[str], order: str) -> W:
    return W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def running(weight: str, partition: Sequence[str], order: str) -> Column:
    """Sum of ``weight`` over the rows strictly before this one."""
    return F.coalesce(F.sum(weight).over(before(partition, order)), F.lit(0).cast("bigint"))


def ranked_values(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append ``smaller`` (rows with a smaller value) and ``rank`` (distinct smaller values).

    ``counts`` are ``(keys, value, weight)`` rows of distinct values. ``keys`` must be
    names with a known, small number of values (column pairs), which bounds the
    broadcast bucket totals. Rows are ordered within one part of one bucket only.
    """
    keys = list(keys)
    coarse = counts.withColumn("b1", coarse_bucket(F.col("value")))
    totals = coarse.groupBy(*keys, "b1").agg(F.sum("weight").alias("rows"), F.count("*").alias("values"))
    totals = totals.select(
        *keys, "b1",
        running("rows", keys, "b1").alias("rows1"), running("values", keys, "b1").alias("values1"),
    )
    parted = coarse.join(F.broadcast(totals), [*keys, "b1"]).withColumn(
        "b2", fine_bucket(F.col("value"), F.col("b1"))
    )
    path, parent = [*keys, "b1", "b2"], [*keys, "b1"]
    # The two totals only follow the bucket; grouping by them too keeps this use of
    # ``parted`` the same plan as the one below, so the bucket totals are made once.
    fine = parted.groupBy(*path, "rows1", "values1").agg(F.sum("weight").alias("rows"), F.count("*").alias("values"))
    fine = fine.select(
        *path, running("rows", parent, "b2").alias("rows2"), running("values", parent, "b2").alias("values2")
    )
    placed = parted.withColumns(
        {
            "rows3": running("weight", path, "value"),
            "values3": F.row_number().over(W.partitionBy(*path).orderBy("value")) - 1,
        }
    ).join(fine, path)
    return placed.select(
        *counts.columns,
        (F.col("rows1") + F.col("rows2") + F.col("rows3")).alias("smaller"),
        (F.col("values1") + F.col("values2") + F.col("values3")).alias("rank"),
    )


MOMENTS = ("count", "mean", "std", "min", "max")


def order_statistics(
    df: DataFrame,
    positions: dict[str, Callable[[Column], Column]],
    keys: Sequence[str] = (),
    few_keys: bool = True,
    moments: bool = False,
    weighted: bool = False,
    places: bool = False,
) -> DataFrame:
    """Values at given positions of the sorted ``value`` column, interpolated linearly.

    ``df`` has the key columns and a double or 64-bit whole-number column ``value`` (then
    positions are whole and values stay exact); missing values and null
    keys do not count, and a key without values has no positions. ``positions`` maps an output name to a function that gives the
    0-based position from ``n``, the number of values of the key. Exact for any
    distribution.

    ``few_keys``: the keys have a small, known number of values (column names, months),
    so only the rows in the wanted buckets are moved, found by a broadcast join of at
    most two buckets per key and position. Otherwise value counts are shuffled once.

    ``moments`` adds count, mean, sample standard deviation, min and max. With
    ``few_keys`` they are put together from the bucket counts: no further scan.

    ``weighted``: ``df`` also has ``weight``, how many rows a row stands for (no moments).

    ``places`` adds ``n`` and, per position, ``<name>_before``: the rows with a smaller value.
    """
    keys = list(keys)
    if weighted and moments:
        raise ValueError("no moments of weighted rows")
    # Missing values weigh nothing; they only make their key known.
    whole_numbers = df.schema["value"].dataType == T.LongType()
    named = df if whole_numbers else df.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    for key in keys:
        named = named.where(F.col(key).isNotNull())
    present = F.col("value").isNotNull().cast("bigint")
    weight = F.col("weight") * present if weighted else present
    if few_keys:
        rows = named.select(*keys, "value", weight.alias("weight"))
    else:
        rows = named.groupBy(*keys, "value").agg(F.sum(weight).alias("weight"))
    rows = rows.withColumn("b1", coarse_bucket(F.col("value"), whole_numbers))

    coarse = rows.groupBy(*keys, "b1").agg(
        F.sum("weight").alias("size"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("value").alias("middle"),
        F.var_pop("value").alias("spread"),
    )
    whole = W.partitionBy(*keys)
    coarse = coarse.select(
        *keys, "b1", "size", "low", "high", "middle", "spread",
        running("size", keys, "b1").alias("start"),
        F.sum("size").over(whole).alias("n"),
        F.try_divide(F.sum(F.col("middle") * F.col("size")).over(whole), F.sum("size").over(whole)).alias("mean"),
    )
    # The lookup carries two columns it does not use itself: so it and the moments read
    # the same bucket counts, and Spark scans and shuffles them once.
    carried = ["middle", "spread"] if moments and few_keys else []
    found = _pick(rows, coarse, positions, keys, few_keys, carried, places)
    if not moments:
        return found
    if few_keys:
        off = F.col("middle") - F.col("mean")
        squares = F.sum(F.col("size") * (F.col("spread") + off * off))
        facts = coarse.groupBy(*keys).agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("count"),
            F.max("mean").alias("mean"),
            F.sqrt(F.try_divide(squares, F.sum("size") - 1)).alias("std"),
            F.min("low").alias("min"),
            F.max("high").alias("max"),
        )
    else:
        facts = named.groupBy(*keys).agg(*moment_columns(F.col("value")))
    if not keys:
        both = facts.withColumn("_found", found.select(F.struct(*positions)).scalar())
        return both.select(*MOMENTS, "_found.*")
    return facts.join(F.broadcast(found) if few_keys else found, keys, "left").select(*keys, *MOMENTS, *positions)


def moment_columns(value: Column) -> list[Column]:
    return [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def _pick(
    rows: DataFrame,
    coarse: DataFrame,
    positions: dict[str, Callable[[Column], Column]],
    keys: list[str],
    few_keys: bool,
    carried: list[str],
    places: bool = False,
) -> DataFrame:
    """Look the positions up: bucket, part of the bucket, value."""
    spots = {
        name: F.greatest(position(F.col("n")).cast("double"), F.lit(0.0)) for name, position in positions.items()
    }
    ranks = F.array(*[end.cast("bigint") for s in spots.values() for end in (F.floor(s), F.ceil(s))])

    def holds_a_rank(start: Column, size: Column) -> Column:
        return F.exists(ranks, lambda r: (r >= start) & (r < start + size))

    wanted = coarse.where(holds_a_rank(F.col("start"), F.col("size"))).select(
        *keys, "b1", "start", "n", *carried
    )
    hits = rows.join(F.broadcast(wanted) if few_keys else wanted, [*keys, "b1"])
    path = [*keys, "b1", "b2"]
    counted = (
        hits.withColumn("b2", fine_bucket(F.col("value"), F.col("b1"), rows.schema["value"].dataType == T.LongType()))
        .groupBy(*path, "start", "n", *carried, "value")
        .agg(F.sum("weight").alias("weight"))
    )
    fine = counted.groupBy(*path, "start", "n").agg(F.sum("weight").alias("size"))
    fine = fine.withColumn("start", F.col("start") + running("size", [*keys, "b1"], "b2"))
    fine = fine.where(holds_a_rank(F.col("start"), F.col("size"))).select(*path, F.col("start").alias("first"))
    placed = counted.join(fine, path).withColumn("first", F.col("first") + running("weight", path, "value"))

    def at(rank: Column, what: str) -> Column:
        here = (rank >= F.col("first")) & (rank < F.col("first") + F.col("weight"))
        return F.max(F.when(here, F.col(what)))

    picks = [F.max("n").alias("n")]
    for i, spot in enumerate(spots.values()):
        picks += [at(F.floor(spot), "value").alias(f"_a{i}"), at(F.ceil(spot), "value").alias(f"_b{i}")]
        if places:
            picks.append(at(F.floor(spot), "first").alias(f"_first{i}"))
    found = placed.groupBy(*keys).agg(*picks)
    out = []
    for i, (name, spot) in enumerate(spots.items()):
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        between = a if rows.schema["value"].dataType == T.LongType() else a + (b - a) * (spot - F.floor(spot))
        out.append(between.alias(name))
        if places:
            out.append(F.col(f"_first{i}").alias(f"{name}_before"))
    if places:
        out.append(F.col("n"))
    return found.select(*keys, *out)


def quantiles(
    df: DataFrame, probs: dict[str, float], keys: Sequence[str] = (), few_keys: bool = True, moments: bool = False,
    weighted: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per key, one column per name."""
    positions = {name: (lambda n, p=p: F.lit(float(p)) * (n - 1)) for name, p in probs.items()}
    return order_statistics(df, positions, keys, few_keys, moments, weighted)


def column_quantiles(df: DataFrame, column: str, probs: dict[str, float]) -> DataFrame:
    """One row with exact quantiles of one column."""
    return quantiles(df.select(ref(column).cast("double").alias("value")), probs)


def group_quantiles(
    df: DataFrame, column: str, group: str, probs: dict[str, float], few_keys: bool = False, moments: bool = False
) -> DataFrame:
    """Exact quantiles of ``column`` per value of ``group`` (null groups left out)."""
    rows = df.select(ref(group).alias(group), ref(column).cast("double").alias("value"))
    return quantiles(rows, probs, [group], few_keys, moments)


def approximate_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], keys: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """One-pass sketch quantiles, for profiling where a bounded rank error is enough."""
    aggs = [F.percentile_approx(ref(column), F.lit(p), F.lit(accuracy)).alias(name) for name, p in probs.items()]
    return df.groupBy(*[ref(k) for k in keys]).agg(*aggs)
