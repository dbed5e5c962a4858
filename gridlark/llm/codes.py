"""Vector code compression: codebooks for parts of vectors, with norm-of-sum bounds.

Vectors are whole numbers, cut into parts; each part is replaced by the index of its
nearest codebook entry, and entries move to the floor of their parts' mean. A row keeps,
for each part and group of entries, a lower bound of its distance to the group and the
round in which the bound was taken. All codebooks of earlier rounds are kept, so a bound
of round t is lowered by the true displacement of its entries between t and now, not by
the sum of their moves; only groups whose bound doesn't clear the distance to the present
entry are scanned again, exactly. Bounds are rounded downwards and compared with a margin,
so codes are those of a full scan.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import fresh, read_table
from gridlark.sources.shared import discard, materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Entries that share one bound.
GROUP = 16
# Rows that are assigned at once.
BLOCK = 4096
# Up to this size sums of products of whole numbers are exact in doubles.
EXACT = 1 << 21


def largest(length: int) -> int:
    """The largest scaled component of which squared distances still fit a long."""
    return math.isqrt((2**63 - 1) // max(length, 1)) // 2


def whole(rows: DataFrame, length: int) -> DataFrame:
    """Rows whose vector has the length, no null or non-finite component and none too large."""
    limit = float(largest(length)) / SCALE
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") == length) & F.coalesce(good, F.lit(False)))


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number rows to entries, exact."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) <= EXACT and x.shape[1] <= 64:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k, None] - entries[None, :, k]) ** 2
    return out


def _below(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers that are not above ``x``."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


class Books:
    """All codebooks so far, as ``history[round][part]``, and the displacements between rounds."""

    def __init__(self, history: list[np.ndarray], group: int = GROUP) -> None:
        self.history = history
        self.group = group
        self.now = history[-1]
        self.groups = -(-self.now.shape[1] // group)
        # The farthest that an entry of a group has moved since each round.
        self.moved = np.stack([self._moved(old) for old in history])

    def _moved(self, old: np.ndarray) -> np.ndarray:
        # As doubles: a displacement may round, which the margin of the comparison covers.
        step = np.sqrt(((self.now - old).astype(np.float64) ** 2).sum(axis=2))
        pad = np.zeros((len(step), self.groups * self.group - step.shape[1]))
        return np.concatenate([step, pad], axis=1).reshape(len(step), self.groups, self.group).max(axis=2)

    def assign(self, x: np.ndarray, code: np.ndarray | None, bound: np.ndarray | None, stamp: np.ndarray | None):
        """Codes, bounds and stamps of rows ``x`` (rows, parts, width); also squared errors and scans.

        ``bound`` of a group leaves out the entry that the row is assigned to.
        """
        n, parts, _ = x.shape
        now = len(self.history) - 1
        fresh_rows = code is None
        code = np.zeros((n, parts), np.int64) if fresh_rows else code.astype(np.int64)
        bound = np.full((n, parts, self.groups), -np.inf, np.float32) if fresh_rows else bound.copy()
        stamp = np.full((n, parts, self.groups), now, np.uint8) if fresh_rows else stamp.copy()
        error = np.zeros((n, parts), np.int64)
        scans = 0
        for part in range(parts):
            entries, rows = self.now[part], x[:, part]
            best = code[:, part].copy()
            own = ((rows - entries[best]) ** 2).sum(axis=1)
            first, old_group = own.copy(), best // self.group
            old = best.copy()
            lower = bound[:, part].astype(np.float64) - self.moved[stamp[:, part], part, np.arange(self.groups)]
            reach = np.sqrt(first.astype(np.float64))
            slack = 1e-9 * (1 + reach)[:, None] + 1e-9 * np.abs(np.where(np.isfinite(lower), bound[:, part], 0))
            open_groups = ~(lower > reach[:, None] + slack)
            nearest: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for g in range(self.groups):
                at = np.flatnonzero(open_groups[:, g])
                if not len(at):
                    continue
                lo = g * self.group
                d = _distances(rows[at], entries[lo : lo + self.group])
                scans += d.size
                nearest[g] = at, d
                least = d.argmin(axis=1)
                value = d[np.arange(len(at)), least]
                index = lo + least
                better = (value < own[at]) | ((value == own[at]) & (index < best[at]))
                own[at[better]], best[at[better]] = value[better], index[better]
            # The bound of a scanned group is its least distance without the entry chosen.
            for g, (at, d) in nearest.items():
                inside = best[at] - g * self.group
                held = (inside >= 0) & (inside < d.shape[1])
                d = d.astype(np.float64)
                d[np.flatnonzero(held), inside[held]] = np.inf
                bound[at, part, g] = _below(np.sqrt(d.min(axis=1)))
                stamp[at, part, g] = now
            # An entry that was left goes back under the bound of its group, if that wasn't scanned.
            left = np.flatnonzero((best != old) & ~open_groups[np.arange(n), old_group])
            g = old_group[left]
            bound[left, part, g] = _below(np.minimum(lower[left, g], np.sqrt(first[left].astype(np.float64))))
            stamp[left, part, g] = now
            code[:, part], error[:, part] = best, own
        return code, bound, stamp, error, scans


def _vectors(column: pa.Array, parts: int) -> np.ndarray:
    """Scaled whole numbers of a batch of vectors of one length, as (rows, parts, width)."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), parts, -1)


def _raw(a: np.ndarray) -> pa.Array:
    """One binary value a row."""
    a = np.ascontiguousarray(a)
    width = a.dtype.itemsize * math.prod(a.shape[1:])
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(a), [None, pa.py_buffer(a.tobytes())])
    return fixed.cast(pa.binary())


def _cooked(column: pa.Array, kind, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _round(rows: DataFrame, books: Books, width: int, started: bool, last: bool = False) -> DataFrame:
    """One pass: rows with their codes, bounds and stamps, and each task's changes of sums and counts.

    Sum rows have ``part, entry, added, sums`` and no code; a row adds to the sums only
    when its code changes, with a minus for the entry that it leaves. The last pass leaves
    vectors, bounds and sums out.
    """
    shared = fresh(rows.sparkSession, books)
    id_type, label_type = (dict(rows.dtypes)[c] for c in ("vec_id", "label"))
    schema = f"vec_id {id_type}, label {label_type}, embedding {dict(rows.dtypes)['embedding']}, code binary, bound binary, stamp binary, error long, part int, entry int, added long, sums array<long>"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, entries = books.now.shape[:2]
        added = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, BLOCK):
                batch = whole_batch.slice(at, BLOCK)
                x = _vectors(batch.column(2), parts)
                state = [None, None, None]
                if started:
                    state = [
                        _cooked(batch.column(3), np.uint8, (parts,)),
                        _cooked(batch.column(4), np.float32, (parts, books.groups)),
                        _cooked(batch.column(5), np.uint8, (parts, books.groups)),
                    ]
                code, bound, stamp, error, _ = books.assign(x, *state)
                for p in () if last else range(parts):
                    moved = np.flatnonzero(code[:, p] != state[0][:, p]) if started else np.arange(len(x))
                    np.add.at(sums[p], code[moved, p], x[moved, p])
                    added[p] += np.bincount(code[moved, p], minlength=entries)
                    if started:
                        before = state[0][moved, p].astype(np.int64)
                        np.subtract.at(sums[p], before, x[moved, p])
                        added[p] -= np.bincount(before, minlength=entries)
                empty = [pa.nulls(len(x), arrow.field(k).type) for k in ("embedding", "bound", "stamp")]
                vector, *state = empty if last else [batch.column(2), _raw(bound), _raw(stamp)]
                columns = [*batch.columns[:2], vector, _raw(code.astype(np.uint8)), *state, pa.array(error.sum(axis=1))]
                columns += [pa.nulls(len(x), f.type) for f in list(arrow)[7:]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        p, e = np.nonzero((added != 0) | (sums != 0).any(axis=2))
        if len(p):
            columns = [pa.nulls(len(p), f.type) for f in list(arrow)[:7]]
            columns += [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(added[p, e]), pa.array(sums[p, e].tolist(), arrow.field("sums").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    ready = rows.select("vec_id", "label", "embedding", *(["code", "bound", "stamp"] if started else []))
    return materialize(ready.mapInArrow(run, schema))


def _totals(table: DataFrame, width: int) -> list:
    """Changes of counts and sums by part and entry: at most parts times entries rows are read back."""
    # As decimals: partial sums of very many rows may leave a long.
    wide = [F.sum(F.col("sums")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in range(width)]
    return table.where("part IS NOT NULL").groupBy("part", "entry").agg(F.sum("added").alias("n"), *wide).collect()


def encode(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, group: int = GROUP
) -> tuple[DataFrame, np.ndarray | None]:
    """``vec_id, label, code, error`` of every vector, ``code`` one byte a part; and the codebooks.

    ``vectors`` has ``vec_id, embedding, label``; other columns are left out. The first
    codebook is that of the ``entries`` smallest ids, ascending (equal ids by vector, null
    ids last), fewer if there are fewer rows. Left out are vectors that are null or empty or
    hold null or non-finite components, whose length differs from that of the smallest id or
    doesn't cut into ``parts``, and components so large that squared distances leave a long
    (above some 300 000 for 64 components). Repeated rows are coded one by one. No such
    rows give no rows and no codebooks.

    A round reads the rows once and writes them with their bounds, in place of the round
    before; the driver gets the first ``entries`` rows and, each round, one row of sums per
    entry.
    """
    if entries > 256:
        raise ValueError("a code is one byte a part: at most 256 entries")
    spark = vectors.sparkSession
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows_with = rows.where((F.size("embedding") > 0) & F.coalesce(usable, F.lit(False)) & (F.size("embedding") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = rows_with.orderBy(*order).limit(1).collect()
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, label {dict(rows.dtypes)['label']}, code binary, error long"
    length = len(head[0][2]) if head else 0
    kept = whole(rows, length)
    first = kept.orderBy(*order).limit(entries).collect() if head else []
    if not first:
        return spark.createDataFrame([], schema), None
    book = np.floor(np.array([r[2] for r in first]) * SCALE).astype(np.int64).reshape(len(first), parts, -1)
    width = length // parts
    history = [np.ascontiguousarray(book.transpose(1, 0, 2))]
    count = np.zeros(history[0].shape[:2], dtype=object)
    total = np.zeros(history[0].shape, dtype=object)
    table = _round(kept, Books(history, group), width, False)
    for done in range(rounds):
        for row in _totals(table, width):
            count[row[0], row[1]] += int(row[2])
            total[row[0], row[1]] += np.array([int(x) for x in row[3:]], dtype=object)
        moved = history[-1].copy()
        for p, e in np.argwhere(count > 0):
            moved[p, e] = [int(s) // int(count[p, e]) for s in total[p, e]]
        history.append(moved)
        before, table = table, _round(table.where("part IS NULL"), Books(history, group), width, True, done == rounds - 1)
        discard(before)
    return table.where("part IS NULL").select("vec_id", "label", "code", "error"), history[-1]


def decode(code: bytes, books: np.ndarray) -> np.ndarray:
    """The whole-number vector that a code stands for."""
    return np.concatenate([books[p, c] for p, c in enumerate(code)])


def books_text(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, comma-joined."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, group: int = GROUP) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector; see :func:`encode`.

    ``code`` is in hexadecimal. ``label_error`` sums the errors of one label, nulls
    together; it is null if the sum leaves a long.
    """
    coded, books = encode(vectors, parts, entries, rounds, group)
    digest = hashlib.sha256(books_text(books).encode() if books is not None else b"").hexdigest()
    # Sums by label are merged before they move, also where one label holds most rows.
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("sum"))
    sums = sums.select(F.col("label").alias("of"), F.expr("try_cast(sum AS BIGINT)").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read_table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds in SQL: components as rows, all distances, least one, floors of means."""

    def assigned(k: int) -> str:
        return f"""d{k} AS MATERIALIZED (SELECT r, part, entry, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d
          FROM x JOIN c{k} c USING (part, place) GROUP BY ALL),
        a{k} AS MATERIALIZED (SELECT r, part, min(entry) AS entry, any_value(d) AS d
          FROM d{k} JOIN (SELECT r, part, min(d) AS d FROM d{k} GROUP BY ALL) USING (r, part, d) GROUP BY r, part)"""

    def moved(k: int) -> str:
        return f"""c{k + 1} AS MATERIALIZED (SELECT part, entry, place, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN
          (SELECT part, entry, place, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v FROM x JOIN a{k} USING (r, part) GROUP BY ALL) m
          USING (part, entry, place))"""

    steps = [assigned(0)]
    for k in range(ROUNDS):
        steps += [moved(k), assigned(k + 1)]
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    x AS MATERIALIZED (SELECT r, i // (n // {PARTS}) AS part, i % (n // {PARTS}) AS place, CAST(floor({SCALE} * CAST(e[i + 1] AS DOUBLE)) AS BIGINT) AS v
      FROM (SELECT r, e, len(e) AS n, unnest(range(len(e))) AS i FROM kept)),
    c0 AS MATERIALIZED (SELECT part, r AS entry, place, v FROM x WHERE r < {ENTRIES}),
    {", ".join(steps)},
    codes AS (SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
    book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS h FROM c{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM kept JOIN codes USING (r), book"""


SQL = _sql()
