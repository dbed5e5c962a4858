"""Exact top-k inner products by MaxScore over vector shards.

The vectors of an input partition are packed into shards without a shuffle; so are the
queries. Shards are dealt evenly to buckets, and query blocks are sent to every bucket, where
they stream past its shards: no side of the pairs is ever brought together or to the driver.
In a shard a query's dimensions are its terms: each has a bound from the shard's largest and
smallest value. Terms are split by their bounds: the essential ones, without which no vector
can reach the threshold, are traversed for all vectors and a block of queries at once; the
others are probed only for vectors that can still compete. The threshold is the query's k-th
best score so far. The best of all buckets are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlark.llm.common import read_table
from gridlark.sources.shared import materialize

K = 5
QUERY_EVERY = 50
SCALE = 256
SHARD = 4096
QUERY_BLOCK = 512
# Components of a shard or block, and shards of a bucket, that a task may hold.
MOST_CELLS = 1 << 20
BUCKET = 16
# Vectors that give a first threshold, and terms that are probed at once.
SEEDS = 512
PROBE = 8
# Terms are probed once fewer than one pair of query and vector in so many can still compete.
CROWDED = 64
EXACT = float(1 << 53)
# What single-precision products hold exactly.
EXACT_SINGLE = float(1 << 24)
_CELLS = {2: "<i2", 4: "<i4", 8: "<f8"}


def _whole(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, lengths and flat scaled components of the rows without nulls and non-finite components."""
    names, vectors = batch.column(0), batch.column(1)
    there = pc.and_(names.is_valid(), vectors.is_valid())
    names, vectors = names.filter(there), vectors.filter(there)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(SCALE * vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    finite = np.isfinite(flat)
    row = np.repeat(np.arange(len(lengths)), lengths)
    keep = np.bincount(row[~finite], minlength=len(lengths)) == 0
    return names.to_numpy(zero_copy_only=False).astype("<i8")[keep], lengths[keep], flat[keep[row]]


def _block(ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> dict[str, list]:
    """One packed row, its components as the narrowest numbers that hold them all."""
    dims = int(lengths.max(initial=0))
    # A shorter vector has zeros for the components it lacks.
    cells = np.zeros((len(ids), dims))
    cells[np.arange(dims) < lengths[:, None]] = flat
    most = np.abs(flat).max(initial=0)
    kind = next(k for size, k in _CELLS.items() if size == 8 or most < 1 << (8 * size - 1))
    return {"ids": [ids.tobytes()], "dims": pa.array([dims], pa.int32()), "cells": [cells.astype(kind).tobytes()]}


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """``ids, dims, cells`` with up to ``rows`` vectors a row, fewer of long ones."""

    def pack(parts):
        ids, lengths, flat = np.zeros(0, "<i8"), np.zeros(0, np.int64), np.zeros(0)
        for batch in parts:
            ids, lengths, flat = (np.concatenate(x) for x in zip((ids, lengths, flat), _whole(batch)))
            size = min(rows, max(1, MOST_CELLS // max(1, int(lengths.max(initial=0)))))
            ends = np.append(0, np.cumsum(lengths))
            full = len(ids) - len(ids) % size
            for i in range(0, full, size):
                yield pa.RecordBatch.from_pydict(_block(ids[i : i + size], lengths[i : i + size], flat[ends[i] : ends[i + size]]))
            ids, lengths, flat = ids[full:], lengths[full:], flat[ends[full] :]
        if len(ids):
            yield pa.RecordBatch.from_pydict(_block(ids, lengths, flat))

    return df.mapInArrow(pack, "ids binary, dims int, cells binary")


def _matrix(ids: bytes, dims: int, cells: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    kind = _CELLS[len(cells) // (len(names) * dims)] if cells else "<f8"
    return names, np.frombuffer(cells, kind).reshape(len(names), dims)


class Best:
    """The best ``k`` ids of each query of a block, flat: ``of`` is the query's place, then id and score."""

    def __init__(self, k: int, of: np.ndarray | None = None, ids: np.ndarray | None = None, scores: np.ndarray | None = None) -> None:
        """From any rows: a repeated id counts once, by its best score; equal scores go by id."""
        self.k = k
        if of is None:
            of, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
        # Whole scores are turned around by their complement, which has no overflow.
        order = np.lexsort((~scores, ids, of))
        of, ids, scores = of[order], ids[order], scores[order]
        once = np.append(True, (of[1:] != of[:-1]) | (ids[1:] != ids[:-1]))[: len(of)]
        of, ids, scores = of[once], ids[once], scores[once]
        order = np.lexsort((ids, ~scores, of))
        of, ids, scores = of[order], ids[order], scores[order]
        start = np.flatnonzero(np.diff(of, prepend=-1))
        place = np.arange(len(of)) - np.repeat(start, np.diff(start, append=len(of)))
        keep = place < k
        self.of, self.ids, self.scores, self.last = of[keep], ids[keep], scores[keep], place[keep] == k - 1

    def __add__(self, other: Best) -> Best:
        return Best(self.k, *(np.concatenate(x) for x in zip((self.of, self.ids, self.scores), (other.of, other.ids, other.scores))))

    def raise_to(self, thresholds: np.ndarray) -> None:
        """Raise the thresholds of the queries that have all ``k`` to the last one's score."""
        score = self.scores[self.last].astype(np.float64)
        # Beyond exact doubles a threshold must not be rounded up.
        score = np.where(np.abs(score) >= EXACT, np.nextafter(score, -np.inf), score)
        of = self.of[self.last]
        thresholds[of] = np.maximum(thresholds[of], score)


class Shard:
    """One shard's vectors and the bounds of its dimensions."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray) -> None:
        self.ids, self.cells = ids, cells
        self.high, self.low = cells.max(axis=0).astype(np.float64), cells.min(axis=0).astype(np.float64)
        # One row of each of the first ids, as the k-th best is that of k different ids.
        self.seeds = np.unique(ids[:SEEDS], return_index=True)[1] if len(ids) > SEEDS else np.zeros(0, np.int64)

    def top(self, query_id: int, query: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the shard's best ``k``, best first; those below ``threshold`` may lack."""
        best = self.best(np.array([query_id]), query[None], k, np.array([float(threshold)]))
        return best.ids, best.scores

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, thresholds: np.ndarray) -> Best:
        """The shard's best ``k`` of every query; those below its threshold may lack."""
        dims = min(queries.shape[1], self.cells.shape[1])
        queries = queries[:, :dims].astype(np.float64)
        high, low = self.high[:dims], self.low[:dims]
        reach = np.abs(queries) @ np.maximum(np.abs(high), np.abs(low))
        beyond = np.flatnonzero(reach >= EXACT)
        if len(beyond):
            near = np.flatnonzero(reach < EXACT)
            found = self.best(query_ids[near], queries[near], k, thresholds[near]) if len(near) else Best(k)
            parts = [(near[found.of], found.ids, found.scores), *((np.full(len(self.ids), q), *self._plain(queries[q])) for q in beyond)]
            of, ids, scores = (np.concatenate(x) for x in zip(*parts))
            other = ids != query_ids[of]
            return Best(k, of[other], ids[other], scores[other])
        kind = np.float32 if reach.max(initial=0) < EXACT_SINGLE else np.float64
        queries = queries.astype(kind)
        thresholds = np.maximum(thresholds, self._first(query_ids, queries, k))
        ends = queries * high.astype(kind), queries * low.astype(kind)
        most, least = np.maximum(*ends).astype(np.float64), np.minimum(*ends).astype(np.float64)
        # One order for the block, by the terms' bounds over all its queries.
        order = np.argsort((least - most).sum(axis=0), kind="stable")
        rest = np.append(np.cumsum(most[:, order][:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1)), axis=1)
        least_of = np.append(np.zeros((len(queries), 1)), np.cumsum(least[:, order], axis=1), axis=1)
        # Without its essential terms a vector has at most the least of them and the most of the rest.
        essential = int((least_of + rest >= thresholds[:, None]).sum(axis=1).max(initial=0))
        essential = min(essential, dims)
        terms = order[:essential]
        scores = queries[:, terms] @ self.cells[:, terms].astype(kind).T
        alive = scores >= (thresholds - rest[:, essential]).astype(kind)[:, None]
        # Probing pays where few can still compete; until then further terms are traversed.
        while essential < dims and np.count_nonzero(alive) * CROWDED > alive.size:
            terms = order[essential : essential + PROBE]
            essential += len(terms)
            scores += queries[:, terms] @ self.cells[:, terms].astype(kind).T
            alive = scores >= (thresholds - rest[:, essential]).astype(kind)[:, None]
        of, row = np.divmod(np.flatnonzero(alive), len(self.ids))
        scores = scores[of, row].astype(np.float64)
        other = self.ids[row] != query_ids[of]
        of, row, scores = of[other], row[other], scores[other]
        for at in range(essential, dims, PROBE):
            terms = order[at : at + PROBE]
            scores = scores + np.einsum("ij,ij->i", queries[np.ix_(of, terms)].astype(np.float64), self.cells[np.ix_(row, terms)].astype(np.float64))
            alive = scores + rest[of, min(at + PROBE, dims)] >= thresholds[of]
            of, row, scores = of[alive], row[alive], scores[alive]
        return Best(k, of, self.ids[row], scores.astype(np.int64))

    def _first(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score among the seeds, or minus infinity where there are fewer others."""
        if len(self.seeds) <= k:
            return np.full(len(queries), -np.inf)
        scores = queries @ self.cells[self.seeds, : queries.shape[1]].astype(queries.dtype).T
        scores[query_ids[:, None] == self.ids[self.seeds]] = -np.inf
        return np.partition(scores, len(self.seeds) - k, axis=1)[:, len(self.seeds) - k].astype(np.float64)

    def _plain(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products beyond exact doubles, in whole numbers; scores end at the range of a long."""
        whole = [int(x) for x in query]
        scores = [sum(a * int(b) for a, b in zip(whole, row)) for row in self.cells[:, : len(whole)]]
        return self.ids, np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores], dtype=np.int64)


def _pairs(shards: DataFrame, blocks: DataFrame) -> DataFrame:
    """``asks, ids, dims, cells``: a bucket a partition, its shards before all query blocks.

    Shards are numbered from the counts of the partitions that packed them, one number a task.
    """
    spark = shards.sparkSession
    at = shards.withColumn("part", F.shiftright("_at", 33))
    sizes = sorted((r["part"], r["count"]) for r in at.groupBy("part").count().collect())
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(1, min(total, max(-(-total // BUCKET), width)))
    number = F.col("start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    spread = at.join(F.broadcast(spark.createDataFrame(starts, "part long, start long")), "part")
    spread = spread.select(F.lit(False).alias("asks"), "ids", "dims", "cells", F.pmod(number, F.lit(buckets)).cast("int").alias("bucket"))
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    asked = blocks.select(F.lit(True).alias("asks"), "ids", "dims", "cells", every)
    dealt = spread.unionAll(asked).repartitionById(buckets, F.col("bucket"))
    return dealt.sortWithinPartitions("asks").select("asks", "ids", "dims", "cells")


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each query.

    Columns ``vec_id`` and ``embedding``; queries are the rows whose id is divisible by
    ``query_every``. Null ids, and vectors null or with null or non-finite components, take
    no part. Vectors of unequal length are compared as if the shorter ended in zeros.
    Repeated rows of one id count once, by their best score, and never answer their own
    id. A query has fewer rows if there are fewer others. No rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    shards = materialize(_packed(rows, SHARD).withColumn("_at", F.monotonically_increasing_id()))
    blocks = materialize(_packed(rows.where(F.col("vec_id") % query_every == 0), QUERY_BLOCK))

    def search(parts):
        shards: list[Shard] = []
        for batch in parts:
            for asks, ids, dims, cells in zip(*(c.to_pylist() for c in batch.columns)):
                names, matrix = _matrix(ids, dims, cells)
                if not asks:
                    shards.append(Shard(names, matrix))
                    continue
                best, thresholds = Best(k), np.full(len(names), -np.inf)
                for shard in shards:
                    best += shard.best(names, matrix, k, thresholds)
                    best.raise_to(thresholds)
                out = {"query_id": names[best.of], "vec_id": best.ids, "score": best.scores}
                yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    found = _pairs(shards, blocks).mapInArrow(search, "query_id long, vec_id long, score long")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))
