"""Records of CSV files with line breaks inside quotes, read by ranges of bytes.

Lines can be read from the middle of a file, records can't: whether a line starts inside a
quoted field depends on all quotes before it. But only on their number being odd, so every
range counts its own quotes, running totals over the ranges of a file say how each begins,
and then every range puts its lines together by itself. A record that crosses from one
range to the next leaves a fragment in each; these few rows are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Kinds of pieces: a whole record, the end of one begun before, the start of one that goes on,
# and the start of a header that does.
WHOLE, HEAD, TAIL, TITLE = range(4)
PIECES = "file string, block long, kind int, text string"


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """One row ``record`` per record of the files at ``path``, without each file's first one, the header.

    Quotes inside quoted fields are doubled; an unquoted field holds none. Line breaks in a
    quoted field stay as they are. Blank lines between records are left out. No range is held whole:
    what waits is the record that is open. Order isn't kept between ranges.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    begins = counted.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # One row per range of a file. The join streams the lines in their order.
    placed = lines.join(F.broadcast(begins), ["file", "block"])
    pieces = placed.select("file", "block", "inside", "value").mapInArrow(_pieces, PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select(F.col("text").alias("record"))
    ends = pieces.where(F.col("kind") != WHOLE)
    # A range's head comes before its tail; a tail opens a record, heads go on with it.
    order = W.partitionBy("file").orderBy("block", "kind").rowsBetween(W.unboundedPreceding, 0)
    numbered = ends.withColumn("number", F.sum((F.col("kind") >= TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    joined = numbered.where("number > 0").groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("record"), F.max("kind").alias("kind")
    )
    return whole.unionByName(joined.where(F.col("kind") == TAIL).select("record"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of consecutive ranges as pieces of records."""
    where: tuple[str, int] | None = None
    waiting: list[str] = []
    inside = continued = header = False
    out: dict[str, list] = {k: [] for k in ("file", "block", "kind", "text")}

    def put(kind: int, text: str) -> None:
        for k, v in zip(out, (*where, kind, text)):
            out[k].append(v)

    def close() -> None:
        """A range ends: what is open is a fragment."""
        if where is not None and (waiting or continued):
            put(HEAD if continued else TITLE if header else TAIL, "\n".join(waiting))

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))
        for v in out.values():
            v.clear()
        return batch

    for batch in batches:
        files, blocks, begins, values = batch.columns
        odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2).astype(bool).tolist()
        rows = zip(files.to_pylist(), blocks.to_pylist(), begins.to_pylist(), values.to_pylist(), odd)
        for name, block, begins_inside, text, flips in rows:
            if where != (name, block):
                close()
                where, waiting = (name, block), []
                inside = continued = begins_inside
                header = block == 0
            waiting.append(text)
            inside ^= flips
            if inside:
                continue
            record = "\n".join(waiting).removesuffix("\r")
            waiting = []
            if continued:
                put(HEAD, record)
                continued = False
            elif header:
                header = False
            elif record:
                put(WHOLE, record)
        if out["text"]:
            yield flush()
    close()
    if out["text"]:
        yield flush()
