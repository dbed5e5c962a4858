"""SimHash near-duplicates: BK-trees over shards of fingerprints.

Two fingerprints that differ in at most two bits agree on one of three blocks of bits, so
each fingerprint is put into three shards, named by a block and its bits. A shard with
too many fingerprints is split by the same rule over its remaining bits, as often as
needed; what is left of the bits bounds the size of a shard. Each shard is a BK-tree in
one task: children are keyed by their distance to the parent, and a search follows only
edges within the radius. A tree gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlark.llm.common import batches, read_table, text_bytes
from gridlark.llm.components import components
from gridlark.sources.shared import materialize

RADIUS = 2
SHINGLE = 3
SEED = 42
# Fingerprints in one tree; a fuller shard is split.
MAX_SHARD = 4096
ALL_BITS = (1 << 64) - 1


def fingerprint(data: bytes | None) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(mask: int) -> list[int]:
    """The free bits beside ``mask`` in ``RADIUS + 1`` blocks."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [sum(1 << b for b in block.tolist()) for block in np.array_split(np.array(free, dtype=object), RADIUS + 1) if len(block)]


class BKTree:
    """Burkhard-Keller tree of 64-bit numbers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of stored values at most ``radius`` bits away."""
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            children = self.children[at]
            if len(children) <= 2 * radius + 1:
                stack.extend(c for k, c in children.items() if d - radius <= k <= d + radius)
            else:
                stack.extend(children[k] for k in range(max(0, d - radius), d + radius + 1) if k in children)
        return found


def forest(values: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``RADIUS`` among distinct values."""
    if len(values) == 2:
        return [(values[1], values[0])] if (values[0] ^ values[1]).bit_count() <= RADIUS else []
    tree, parent, links = BKTree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, RADIUS):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                links.append((value, values[j]))
        tree.insert(value)
    return links


def _shard_links(parts):
    """Forests of consecutive rows with equal shard names."""
    name, held = None, []
    for batch in parts:
        masks, keys, fps = (c.to_numpy() for c in batch.columns)
        if not len(fps):
            continue
        cuts = np.flatnonzero((np.diff(masks) != 0) | (np.diff(keys) != 0)) + 1
        edges: list[tuple[int, int]] = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
            here = (int(masks[lo]), int(keys[lo]))
            if here != name:
                edges += forest(held) if len(held) > 1 else []
                name, held = here, []
            held += fps[lo:hi].view(np.uint64).tolist()
        yield _edge_batch(edges)
    yield _edge_batch(forest(held) if len(held) > 1 else [])


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], names=["a", "b"])


def links(fps: DataFrame, max_shard: int = MAX_SHARD) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs within the radius.

    ``fps`` holds distinct fingerprints ``fp``. Shards above ``max_shard`` are split until
    none is left or too few bits remain for more than ``max_shard`` values.
    """
    masks = [0]
    keyed = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    found = []
    while True:
        parts = {m: [m | p for p in _parts(m)] for m in masks}
        pairs = F.create_map(*(x for m, new in parts.items() for x in (F.lit(_signed(m)).cast("long"), F.array(*(F.lit(_signed(n)).cast("long") for n in new)))))
        keyed = keyed.select(F.explode(pairs[F.col("mask")]).alias("mask"), "fp")
        # Different ways through the blocks may lead to one shard.
        keyed = keyed.distinct() if masks != [0] else keyed
        keyed = keyed.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")
        masks = sorted({n for new in parts.values() for n in new})
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("size")).where("size > 1")
        sizes = materialize(sizes)
        splits = min(64 - m.bit_count() for m in masks) >= max_shard.bit_length()
        full = sizes.where(F.col("size") > max_shard) if splits else sizes.limit(0)
        rest = sizes.where(F.col("size") <= max_shard) if splits else sizes
        found.append(keyed.join(rest.drop("size"), ["mask", "key"]))
        if not full.limit(1).count():
            break
        keyed = materialize(keyed.join(full.drop("size"), ["mask", "key"]).select("mask", "fp"))
    out = None
    for rows in found:
        n = max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        sharded = rows.select("mask", "key", "fp").repartition(n, "mask", "key").sortWithinPartitions("mask", "key", "fp")
        edges = sharded.mapInArrow(_shard_links, "a long, b long")
        out = edges if out is None else out.union(edges)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, fp`` of every row: the text's hash, and its fingerprint as a signed long."""

    def step(ids, digests, texts):
        return {"doc_id": ids, "digest": digests, "fp": [_signed(fingerprint(t)) for t in texts]}

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), text_bytes())
    return batches(rows, step, f"doc_id {dict(docs.dtypes)['doc_id']}, digest long, fp long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, fp, component_id`` of every row of ``docs``.

    Null, empty and blank texts have fingerprint zero and are linked like any other.
    Repeated rows share their fingerprint. A null ``doc_id`` never is a component's id
    unless all rows of the component have none. No rows give no rows.
    """
    hashed = materialize(fingerprints(docs))
    ids = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(ids.select("fp"))).select(F.col("node").alias("fp"), "root")
    rooted = materialize(ids.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select("doc_id", "digest", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id; all columns stay.

    Repeated rows of that document count as its copies; one of them stays.
    """
    groups = near_duplicates(docs)
    mine = ["_gridlark_first_id", "_gridlark_first_digest"]
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias(mine[0]), F.col("digest").alias(mine[1]), "fp")
    # A component's fingerprints are told apart by its id, or, without ids, by the fingerprint.
    alone = F.when(F.col("component_id").isNull(), F.col("fp"))
    first = groups.groupBy("component_id", alone).agg(F.min(row).alias("row")).select(*(f"row.{c}" for c in mine))
    marked = docs.select("*", F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("_gridlark_row"))
    same = F.col("_gridlark_row.doc_id").eqNullSafe(F.col(mine[0])) & (F.col("_gridlark_row.digest") == F.col(mine[1]))
    copies = Window.partitionBy("_gridlark_row.doc_id", "_gridlark_row.digest").orderBy("_gridlark_row.digest")
    kept = marked.join(first, same, "left_semi").withColumn("_gridlark_copy", F.row_number().over(copies))
    return kept.where("_gridlark_copy = 1").select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
