"""Correlations of numeric columns: Pearson, Spearman, Kendall (tau-b)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridlark.operators.columns import numeric_columns, ref
from gridlark.operators.ranking import before, coarse_bucket, fine_bucket, ranked_values, running
from gridlark.sources.shared import materialize

METHODS = ("pearson", "spearman", "kendall")


def _pair_name(i: int, j: int) -> str:
    return f"{i}:{j}"


def _no_pairs(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")


def _pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows with both values; null where ``corr`` would divide by 0."""
    a_spread = F.stddev_pop(F.when(b.isNotNull(), a))
    b_spread = F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), a_spread * b_spread)


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_a, column_b, r)`` of all pairs a before b, in one aggregate.

    Each pair uses the rows where both are present. A constant column gives null.
    """
    pairs = list(combinations(columns, 2))
    values = df.select([F.nanvl(ref(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    one_row = values.agg(*[_pearson(ref(a), ref(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def pair_points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(pair, x, y, weight)``: distinct value pairs per column pair, both present.

    Equal points are counted on the map side, so repeated rows cost nothing later.
    """
    values = df.select([F.nanvl(ref(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    points = F.array(
        *[
            F.struct(
                F.lit(_pair_name(i, j)).alias("pair"), ref(columns[i]).alias("x"), ref(columns[j]).alias("y")
            )
            for i, j in combinations(range(len(columns)), 2)
        ]
    )
    present = values.select(F.inline(points)).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return present.groupBy("pair", "x", "y").agg(F.count("*").alias("weight"))


def _ranks(points: DataFrame, axis: str) -> DataFrame:
    """Per pair and value of one axis: ``before_`` (rows with a smaller value), ``ties_``
    (rows with the value) and ``rank_`` (distinct smaller values).
    """
    counts = points.groupBy("pair", F.col(axis).alias("value")).agg(F.sum("weight").alias("weight"))
    return ranked_values(counts, ["pair"]).select(
        "pair",
        F.col("value").alias(axis),
        F.col("smaller").alias(f"before_{axis}"),
        F.col("weight").alias(f"ties_{axis}"),
        F.col("rank").alias(f"rank_{axis}"),
    )


def shared_ranks(placed: DataFrame, columns: int) -> DataFrame:
    """``(place, value, ranks)``: for each value of a column its average rank among the rows that have the other column.

    ``placed`` are :func:`pair_points` with the columns' places; ``ranks`` has one entry per
    column. A column's values are counted and put in order once: the running counts for
    every other column go over the same buckets.
    """
    weights = [f"w{j}" for j in range(columns)]
    sides = F.array(*[
        F.struct(F.col(f"place_{a}").alias("place"), F.col(a).alias("value"), F.col(f"place_{b}").alias("other"), "weight")
        for a, b in (("x", "y"), ("y", "x"))
    ])
    beside = [F.sum(F.when(F.col("other") == j, F.col("weight")).otherwise(0)).alias(w) for j, w in enumerate(weights)]
    counts = placed.select(F.inline(sides)).groupBy("place", "value").agg(*beside)
    coarse = counts.withColumn("b1", coarse_bucket(F.col("value")))
    path, parent, keys = ["place", "b1", "b2"], ["place", "b1"], ["place"]
    totals = coarse.groupBy(*parent).agg(*[F.sum(w).alias(w) for w in weights])
    totals = totals.select(*parent, *[running(w, keys, "b1").alias(f"{w}_1") for w in weights])
    # Buckets of a known number of columns; their number is bounded.
    parted = coarse.join(F.broadcast(totals), parent).withColumn("b2", fine_bucket(F.col("value"), F.col("b1")))
    fine = parted.groupBy(*path).agg(*[F.sum(w).alias(w) for w in weights])
    fine = fine.select(*path, *[running(w, parent, "b2").alias(f"{w}_2") for w in weights])
    placed = parted.withColumns({f"{w}_3": running(w, path, "value") for w in weights}).join(fine, path)
    ranks = [F.col(f"{w}_1") + F.col(f"{w}_2") + F.col(f"{w}_3") + (F.col(w) + 1) / 2.0 for w in weights]
    return placed.select("place", "value", F.array(*ranks).alias("ranks"))


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation with average ranks, each pair ranked over its complete rows."""
    points = pair_points(df, columns)
    ids = F.split("pair", ":")
    # Never null, so that the joins add no filter and both uses of the points are one plan.
    places = {f"place_{axis}": F.coalesce(ids.getItem(k).cast("int"), F.lit(-1)) for k, axis in enumerate("xy")}
    placed = points.withColumns(places)
    ranks = shared_ranks(placed, len(columns))
    for axis in ("x", "y"):
        own = ranks.select(F.col("place").alias(f"place_{axis}"), F.col("value").alias(axis), F.col("ranks").alias(f"ranks_{axis}"))
        placed = placed.join(own, [f"place_{axis}", axis])
    # Ranks of a pair have mean (n + 1) / 2; taking it off first avoids cancellation.
    totals = points.groupBy("pair").agg(F.sum("weight").alias("n"))
    middle = (F.col("n") + 1) / 2.0
    centred = placed.join(F.broadcast(totals), "pair").select(
        "pair",
        "weight",
        (F.element_at("ranks_x", F.col("place_y") + 1) - middle).alias("u"),
        (F.element_at("ranks_y", F.col("place_x") + 1) - middle).alias("v"),
    )
    sums = centred.groupBy("pair").agg(
        F.sum(F.col("weight") * F.col("u") * F.col("v")).alias("uv"),
        F.sum(F.col("weight") * F.col("u") * F.col("u")).alias("uu"),
        F.sum(F.col("weight") * F.col("v") * F.col("v")).alias("vv"),
    )
    scale = F.sqrt(F.col("uu")) * F.sqrt(F.col("vv"))
    return _named(sums.select("pair", F.try_divide(F.col("uv"), scale).alias("r")), columns)


def _named(by_pair: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the pair id by the two column names."""
    ids = F.split("pair", ":")
    names = F.array(*[F.lit(c) for c in columns])

    def name(part: int):
        return F.element_at(names, ids.getItem(part).cast("int") + 1)

    return by_pair.select(name(0).alias("column_a"), name(1).alias("column_b"), "r")


# Rows of one y-block of the ordered count below; a block is one window partition.
BLOCK = 65536
# Points that one task spreads over their bits.
POINTS_A_TASK = 40_000


def kendall_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kendall's tau-b of all column pairs, exact and without comparing rows pairwise.

    Two points with different x first differ in exactly one bit of their x rank (from
    the top). So for every bit, points that agree above it form a family, and the pairs
    that the bit decides are counted by one running total over y within the family:
    ``concordant = sum over bit-1 points of the weight of bit-0 points with smaller y``.
    The work is ``points * log2(distinct x)``. A family is cut into blocks of y ranks
    with block totals carried forward, so no task holds a whole family.
    """
    points = pair_points(df, columns)
    x_ranks, y_ranks = _ranks(points, "x"), _ranks(points, "y")
    ranked = materialize(points.join(x_ranks.select("pair", "x", "rank_x"), ["pair", "x"]).join(
        y_ranks.select("pair", "y", "rank_y"), ["pair", "y"]
    ).select("pair", "rank_x", "rank_y", "weight"))
    # A point becomes a row per bit, and points near in x meet in the bits' families: parts by
    # their number and in order of x bound what a task holds.
    ranked = ranked.repartitionByRange(max(1, -(-ranked.count() // POINTS_A_TASK)), "pair", "rank_x", "rank_y")
    bits = F.sequence(F.lit(0), F.lit(62))
    top = F.broadcast(x_ranks.groupBy("pair").agg(F.max("rank_x").alias("top")))
    # Bits above the largest rank decide nothing.
    used = F.filter(bits, lambda b: F.call_function("shiftright", F.col("top"), b) > 0)
    spread = ranked.join(top, "pair").select("pair", "rank_x", "rank_y", "weight", F.explode(used).alias("bit"))
    shifted = F.call_function("shiftright", F.col("rank_x"), F.col("bit"))
    one = shifted.bitwiseAND(F.lit(1).cast("bigint")) == 1
    family = ["pair", "bit", "prefix"]
    cells = spread.groupBy(
        "pair", "bit", F.floor(shifted / 2).alias("prefix"), F.col("rank_y"), F.floor(F.col("rank_y") / BLOCK).alias("block")
    ).agg(
        F.sum(F.when(one, F.lit(0)).otherwise(F.col("weight"))).alias("zeros"),
        F.sum(F.when(one, F.col("weight")).otherwise(F.lit(0))).alias("ones"),
    )
    blocks = cells.groupBy(*family, "block").agg(F.sum("zeros").alias("block_zeros"))
    blocks = blocks.select(
        *family, "block",
        F.coalesce(F.sum("block_zeros").over(before(family, "block")), F.lit(0)).alias("carried"),
        F.sum("block_zeros").over(W.partitionBy(*family)).alias("all_zeros"),
    )
    inside = F.coalesce(F.sum("zeros").over(before([*family, "block"], "rank_y")), F.lit(0))
    placed = cells.withColumn("inside", inside).where("ones > 0").join(blocks, [*family, "block"])
    below = (F.col("carried") + F.col("inside")).cast("double")
    above = F.col("all_zeros") - below - F.col("zeros")
    score = placed.groupBy("pair").agg(F.sum(F.col("ones") * (below - above)).alias("score"))

    def tied(ranks: DataFrame, axis: str) -> DataFrame:
        t = F.col(f"ties_{axis}").cast("double")
        return ranks.groupBy("pair").agg(
            F.sum(t * (t - 1) / 2).alias(f"tied_{axis}"), F.sum(f"ties_{axis}").cast("double").alias(f"n_{axis}")
        )

    # One row per column pair on every side.
    parts = tied(x_ranks, "x").join(F.broadcast(tied(y_ranks, "y")), "pair").join(F.broadcast(score), "pair", "left")
    pairs = F.col("n_x") * (F.col("n_x") - 1) / 2
    scale = F.sqrt(pairs - F.col("tied_x")) * F.sqrt(pairs - F.col("tied_y"))
    tau = F.try_divide(F.coalesce(F.col("score"), F.lit(0.0)), scale)
    return _named(parts.select("pair", tau.alias("r")), columns)


def correlation_pairs(df: DataFrame, method: str = "pearson", columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_a, column_b, r)`` of every pair of numeric columns, a before b."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {METHODS}")
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        return _no_pairs(df)
    return {"pearson": pearson_pairs, "spearman": spearman_pairs, "kendall": kendall_pairs}[method](df, columns)


def correlation_matrix(df: DataFrame, method: str = "pearson", columns: Sequence[str] | None = None) -> DataFrame:
    """Full matrix in long form: both orders of each pair and the diagonal.

    The diagonal is 1, but null for a column that has no two different values.
    """
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        return _no_pairs(df)
    upper = correlation_pairs(df, method, columns)
    both = F.array(
        F.struct(F.col("column_a").alias("column_a"), F.col("column_b").alias("column_b"), "r"),
        F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "r"),
    )
    spread = df.agg(
        *[
            (F.min(ref(c)) < F.max(ref(c))).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]
    )
    diagonal = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_a"), F.lit(c).alias("column_b"), F.when(F.col(f"v{i}"), F.lit(1.0)).alias("r")
            )
            for i, c in enumerate(columns)
        ]
    )
    return upper.select(F.inline(both)).unionByName(spread.select(F.inline(diagonal)))


def strong_pairs(df: DataFrame, limit: float = 0.8, method: str = "pearson", columns: Sequence[str] | None = None) -> DataFrame:
    """Column pairs with ``abs(r)`` above the limit, each pair once."""
    return correlation_pairs(df, method, columns).where(F.abs("r") > limit)


def heatmap(df: DataFrame, columns: Sequence[str], method: str = "pearson", digits: int = 2) -> DataFrame:
    """The matrix as one row per column and one column per column, rounded."""
    matrix = correlation_matrix(df, method, columns)
    cells = [F.max(F.when(F.col("column_b") == c, F.col("r"))).alias(c) for c in columns]
    wide = matrix.groupBy(F.col("column_a").alias("column")).agg(*cells)
    return wide.select("column", *[F.bround(ref(c), digits).alias(c) for c in columns])
