"""Uniform shuffle into exact shards through a hypergeometric communication matrix.

A uniformly random arrangement of all rows is drawn in three steps: the matrix says how
many rows of each partition go to each shard (drawn row by row from the hypergeometric
law, so that shard sizes are exact); each partition permutes its rows and deals them by
its matrix row; after the exchange each shard permutes what it got.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import gapless, read_table
from gridlark.sources.shared import materialize

SHARDS = 40
SEED = 20240
# Bytes counted per row beside its text.
OVERHEAD = 16
# Numpy draws hypergeometric numbers only below this many rows.
NUMPY_BOUND = 1_000_000_000


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Row counts from each partition (rows) to each shard (columns).

    Shard sizes are at most one apart; each row of the matrix is drawn without
    replacement from the places that are left in the shards.
    """
    total = sum(rows)
    left = np.full(shards, total // shards, np.int64)
    left[: total % shards] += 1
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(rows), shards), np.int64)
    for k, n in enumerate(rows):
        matrix[k] = _draw(rng, left, n)
        left -= matrix[k]
    return matrix


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """A multivariate hypergeometric draw of ``n`` places, shard by shard."""
    out, places = np.zeros_like(left), int(left.sum())
    for j, here in enumerate(left.tolist()):
        others = places - here
        if max(here, others) < NUMPY_BOUND:
            out[j] = rng.hypergeometric(here, others, n)
        else:
            out[j] = _one_by_one(rng, here, others, n)
        n -= int(out[j])
        places = others
    return out


def _one_by_one(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """The same law beyond numpy's bound, place by place; ``n`` is what one partition holds."""
    taken = 0
    for _ in range(n):
        hit = int(rng.integers(good + bad)) < good
        taken += hit
        good -= hit
        bad -= not hit
    return taken


def shuffle(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (a few narrow columns) with ``shard`` and the gapless place ``slot`` in it.

    Every arrangement is equally likely for the seeds' hash; shard sizes are at most one
    apart. The rows are written once with their partition and place, so that later passes
    and repeated tasks see the same partitions. No rows give no rows; repeated rows are
    rows of their own.
    """
    spark = rows.sparkSession
    names = rows.columns
    placed = rows.withColumns({"_part": F.spark_partition_id().cast("long"), "_place": F.monotonically_increasing_id()})
    placed = materialize(placed)
    # One number per partition comes to the driver.
    counts = [(r[0], r[1]) for r in placed.groupBy("_part").count().orderBy("_part").collect()]
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    ends = [(part, matrix[k].cumsum().tolist()) for k, (part, _) in enumerate(counts)]
    dealt = spark.createDataFrame(ends, "_part long, _ends array<long>")
    first = placed.withColumn("_draw", F.xxhash64(F.lit(seed), "_part", "_place"))
    local = gapless(first, "_part", "_draw", max([n for _, n in counts], default=1), "_rank")
    shard = F.size(F.filter("_ends", lambda end: end <= F.col("_rank")))
    sent = local.join(dealt, "_part").withColumn("shard", shard)
    again = sent.withColumn("_draw", F.xxhash64(F.lit(seed + 1), "_part", "_place"))
    done = gapless(again.select(*names, "_draw", "shard"), "shard", "_draw", -(-total // shards) or 1, "slot")
    return done.select(*names, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every document.

    The law is ``rows``: counts at most one apart, so ``grown_shard`` is null. A null text
    has no bytes (size ``OVERHEAD``, checksum 0); equal texts are rows of their own.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select("doc_id", (F.length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = shuffle(narrow, shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))
