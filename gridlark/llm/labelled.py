"""Bounded samples of labelled documents, and a small logistic regression."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.sources.shared import materialize


def fold(parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``text, label, pick`` of at most ``per_class`` labelled rows of each class, and the classes' sizes.

    Rows are picked by a hash of their id (``pick``), among those where ``may_learn``
    holds. Ids without one label, or without text, take no part. The picked ids are bounded
    by the parameter, so that they are broadcast and the texts aren't shuffled.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other")).where("label = other")
    known = materialize(known.where(may_learn).select("doc_id", "label", F.xxhash64("doc_id", F.lit(17)).alias("pick")))
    sizes = {int(r[0]): int(r[1]) for r in known.groupBy("label").count().collect()}
    picked = known.where("label = 0").orderBy("pick").limit(per_class).union(known.where("label = 1").orderBy("pick").limit(per_class))
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    # A repeated id counts once.
    return materialize(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"), F.min("pick").alias("pick"))), sizes


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * np.append(b[:-1], 0) / len(y)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(b)) * (ridge / len(y) + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        b -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return b


def pick(docs: DataFrame, most: int) -> DataFrame:
    """``pick, text`` of at most ``most`` documents with text, by a hash of their text's digest.

    The picked digests are bounded by the parameter and broadcast; equal texts count once.
    """
    digest = F.xxhash64("text")
    order = F.xxhash64("digest", F.lit(29))
    picked = docs.where("text IS NOT NULL").select(digest.alias("digest")).distinct().orderBy(order).limit(most)
    rows = docs.where("text IS NOT NULL").select(digest.alias("digest"), "text").join(F.broadcast(picked), "digest")
    return materialize(rows.groupBy("digest").agg(F.min("text").alias("text")).select(F.col("digest").alias("pick"), "text"))


def apart(extra: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The extra spans that touch none of the base, by one sweep over both in order."""
    if not base:
        return extra
    starts, ends = [], []
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if starts and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for span in extra:
        at = bisect_left(starts, span[2]) - 1
        if at < 0 or ends[at] <= span[1]:
            out.append(span)
    return out


def mixed(rows: DataFrame, most: int) -> list:
    """At most ``most`` rows of a training set, half with a span (``marked``) and half without.

    They are drawn by a hash of the document and the place in it, so that one long document
    isn't the sample.
    """
    rows = materialize(rows.withColumn("draw", F.xxhash64("pick", "start", "broken")))
    parts = [rows.where(F.col("marked") == m).orderBy("draw", "pick", "start", "broken").limit(most // 2).collect() for m in (True, False)]
    return sorted((r for part in parts for r in part), key=lambda r: (r["draw"], r["pick"], r["start"]))


def span_text(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))
