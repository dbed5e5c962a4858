"""Conversation structure repair: the cheapest edits, ties to the least audit text.

A conversation has the right structure if its roles are nothing, or an optional system
turn and then pairs of user and assistant. A shortest-path pass over its rows, from the
last to the first, gives the cost from every node (row, state) to the end; arcs on a
cheapest path are optimal. Nodes are ranked by the first 1, 2, 4, ... letters of the audit
texts that leave them, each length from the ranks of the one before; ranks choose the arc,
and the doubled pointers then visit the nodes of the least path.

Only one byte a row, its fault and role initial, goes into the search; texts don't. Rows
are range-sorted, so that a conversation with a third of all rows is read by many tasks;
what meets in one task is one byte a row, as much as the audit that is returned in one
cell, and it is searched in blocks. Texts pass by in order and are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import read_table
from gridlark.sources.shared import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after system, after user, after assistant. An inserted or renamed
# row has the one role that may follow, user or assistant.
FOLLOWS = (2, 2, 3, 2)
STEP = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
NAMES = {2: "user", 3: "assistant"}
INITIALS = "sua"
# Faults in a row's byte, above the two bits of its role's initial.
FINE, CUT, BLANK, DUPLICATE = range(4)
LETTERS = np.frombuffer(b" DIKR", np.uint8)
FAR = 1 << 60
END = (0, 10, 5, 0)
# Rows that are searched at once.
BLOCK = 1 << 14


def _column(code: int, a: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    """Costs to the end before a row, from those after it."""
    a0, a1, a2, a3 = a
    v0, v1, v2, v3 = a0 + DELETE, a1 + DELETE, a2 + DELETE, a3 + DELETE
    kind, initial = code >> 2, code & 3
    if kind < BLANK:
        price = TRUNCATED if kind == CUT else KEEP
        # A row that may stay fits by its own role or, for one more, by another.
        u = price + a2 + (REROLE if initial != 1 else 0)
        s = price + a3 + (REROLE if initial != 2 else 0)
        v0, v1, v2, v3 = min(v0, u), min(v1, u), min(v2, s), min(v3, u)
        if initial == 0:
            v0 = min(v0, price + a1)
    v2 = min(v2, INSERT + v3)
    v3 = min(v3, INSERT + v2)
    return min(v0, INSERT + v2), min(v1, INSERT + v2), v2, v3


def costs(codes: bytes, after: tuple[int, int, int, int] = END) -> list[tuple[int, int, int, int]]:
    """Cost to the end of each state before every row, and, last, after all rows."""
    out = [after]
    for code in reversed(codes):
        out.append(_column(code, out[-1]))
    out.reverse()
    return out


_STEP = np.array([*zip(*STEP)], dtype=np.int64)
_FOLLOWS = np.array(FOLLOWS, dtype=np.int64)


def least_paths(pieces: list[tuple[bytes, tuple[int, int, int, int] | None, int]]) -> list[tuple[bytes, int]]:
    """Least cheapest audit and final state of each piece ``(codes, costs after it, first state)``.

    Without costs after it a piece runs to its conversation's end; else to its last row.
    """
    columns: list[tuple[int, int, int, int]] = []
    codes, starts, ends, closed = bytearray(), [], [], []
    for piece, after, state in pieces:
        starts.append(4 * len(columns) + state)
        columns += costs(piece, END if after is None else after)
        codes += piece
        codes.append(255)
        ends.append(len(columns) - 1)
        closed.append(after is None)
    cost = np.array(columns, dtype=np.int64)
    code = np.frombuffer(bytes(codes), np.uint8).astype(np.int64)[:, None]
    n = len(cost)
    here = np.arange(n, dtype=np.int64)[:, None] * 4
    state = np.arange(4, dtype=np.int64)[None, :]
    last = code == 255
    # After the last row of an open piece no arc leaves: the next piece goes on from there.
    sink = np.zeros((n, 1), dtype=bool)
    sink[np.array(ends)[~np.array(closed)]] = True
    ahead = np.vstack([cost[1:], cost[:1]])
    stays = ~last & (code >> 2 < BLANK)
    price = np.where(code >> 2 == CUT, TRUNCATED, KEEP)
    kept = np.where(last, -1, _STEP[np.where(last, 3, code & 3)[:, 0]])
    follows = np.broadcast_to(_FOLLOWS, (n, 4))
    by_keep = np.take_along_axis(ahead, np.maximum(kept, 0), axis=1) + price
    # Optimal arcs by their letters in ascending order; those of one node differ in letter.
    arcs = [
        (~last & (cost == ahead + DELETE), here + 4 + state),
        (~sink & (cost == np.take_along_axis(cost, follows, axis=1) + INSERT), here + follows),
        (stays & (kept >= 0) & (cost == by_keep), here + 4 + np.maximum(kept, 0)),
        (stays & (cost == np.take_along_axis(ahead, follows, axis=1) + price + REROLE), here + 4 + follows),
    ]
    letter, pointer = _ranked(arcs, 4 * n)
    jumps = [pointer]
    while True:
        further = jumps[-1][jumps[-1]]
        if (further == jumps[-1]).all():
            break
        jumps.append(further)
    # A step number is a sum of powers of two: the longest jumps first, then from all nodes so far.
    nodes, steps, owner = np.array(starts), np.zeros(len(starts), np.int64), np.arange(len(starts))
    final = jumps[-1][nodes]
    for k in reversed(range(len(jumps))):
        to = jumps[k][nodes]
        real = letter[to] > 0
        nodes, steps, owner = np.append(nodes, to[real]), np.append(steps, steps[real] + (1 << k)), np.append(owner, owner[real])
    real = letter[nodes] > 0
    nodes, steps, owner = nodes[real], steps[real], owner[real]
    order = np.lexsort((steps, owner))
    text = LETTERS[letter[nodes[order]]].tobytes()
    cuts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(starts))))
    return [(text[a:b], int(f) % 4) for a, b, f in zip(cuts, cuts[1:], final)]


def _ranked(arcs: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Letter and target of each node's least optimal arc, chosen by ranks of audit prefixes.

    ``rank`` orders nodes by the first letters of their least audits, twice as many each
    round; a node without arcs comes before all others, as a shorter text does.
    """
    letter, pointer = np.zeros(size, np.int64), np.arange(size)
    for k, (valid, to) in reversed(list(enumerate(arcs, 1))):
        at = np.flatnonzero(valid.reshape(-1))
        letter[at], pointer[at] = k, to.reshape(-1)[at]
    rank, jump = letter.copy(), pointer
    while True:
        key = rank * (size + 1) + rank[jump]
        rank = np.unique(key, return_inverse=True)[1]
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    # The arc with the least letter, then with the least rank where it leads.
    best = np.full(size, np.iinfo(np.int64).max)
    chosen, target = np.zeros(size, np.int64), np.arange(size)
    for k, (valid, to) in enumerate(arcs, 1):
        at, to = np.flatnonzero(valid.reshape(-1)), to.reshape(-1)
        key = k * (size + 1) + rank[to[at]]
        less = key < best[at]
        best[at[less]], chosen[at[less]], target[at[less]] = key[less], k, to[at[less]]
    return chosen, target


def audits(conversations: list[bytes], block: int = BLOCK) -> list[tuple[int, str]]:
    """Cost and least audit of each conversation, given one byte a row.

    Longer ones than ``block`` are searched in pieces, from the costs at their ends.
    """
    out: list[tuple[int, str] | None] = [None] * len(conversations)
    short = [i for i, c in enumerate(conversations) if len(c) <= block]
    for i, (text, _) in zip(short, least_paths([(conversations[i], None, 0) for i in short]) if short else ()):
        out[i] = costs(conversations[i])[0][0], text.decode()
    for i, codes in enumerate(conversations):
        if out[i] is not None:
            continue
        cuts = list(range(0, len(codes), block))
        after: list[tuple[int, int, int, int]] = [END]
        for at in reversed(cuts):
            column = after[-1]
            for code in reversed(codes[at : at + block]):
                column = _column(code, column)
            after.append(column)
        after.reverse()
        parts, state = [], 0
        for k, at in enumerate(cuts):
            text, state = least_paths([(codes[at : at + block], after[k + 1] if k + 1 < len(cuts) else None, state)])[0]
            parts.append(text)
        out[i] = after[0][0], b"".join(parts).decode()
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the query: ``conv_id, turn, role, text, copies``, with no copy of a dropped row.

    Null roles and texts, and null numbers in the hashed key, are one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    draw = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _own_fault(text: Column) -> Column:
    """The fault that a row has by itself."""
    return F.when(_blank(text), BLANK).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(FINE).cast("int")


def _rows(rows: DataFrame) -> DataFrame:
    """Rows with a digest of their text; a dropped row leaves only its conversation's id."""
    there = F.col("copies") > 0
    return rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, F.md5(F.col("text").cast("binary"))).otherwise("").alias("digest"),
        F.when(there, F.col("text")).alias("text"),
        "copies",
    )


def _marks(rows: DataFrame) -> DataFrame:
    """Different rows by turn, role and digest, with their number and fault."""
    initial = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.col("role") == "", 3).otherwise(initial).cast("int")
    keys = ["conv_id", "turn", "role", "digest"]
    counted = rows.select(*keys, F.when(F.col("copies") > 0, _own_fault(F.col("text"))).alias("fault"), initial.alias("initial"), "copies")
    # Equal rows are merged before they move, so a row that fills a third of the table is one row.
    counted = counted.groupBy(*keys, "fault", "initial").agg(F.sum("copies").alias("copies"))
    first = counted.where("copies > 0").groupBy(*(F.col(k).alias(f"{k}_1") for k in ("conv_id", "role", "digest")))
    first = first.agg(F.min("turn").alias("turn_1"), F.max(F.col("turn").isNull()).alias("null_1"))
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_1")) & (F.col("role") == F.col("role_1")) & (F.col("digest") == F.col("digest_1"))
    later = F.col("turn").isNotNull() & (F.col("null_1") | (F.col("turn") > F.col("turn_1")))
    fault = F.when((F.col("fault") != BLANK) & F.coalesce(later, F.lit(False)), DUPLICATE).otherwise(F.col("fault"))
    return materialize(counted.join(first, same, "left").select(*keys, fault.cast("int").alias("fault"), "initial", "copies"))


def _segments(marks: DataFrame) -> DataFrame:
    """Runs of one conversation in range-sorted rows: one byte a row, and the turns seen."""
    id_type = dict(marks.dtypes)["conv_id"]
    schema = f"conv_id {id_type}, part int, place long, codes binary, low long, high long, turns long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, number = None, None, 0
        codes, low, high, turns = bytearray(), None, None, 0
        done: dict[str, list] = {k: [] for k in ("conv_id", "part", "place", "codes", "low", "high", "turns")}

        def close(part):
            for k, v in zip(done, (name, part, number, bytes(codes), low, high, turns)):
                done[k].append(v)

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(done.values(), arrow)], schema=arrow)
            for v in done.values():
                v.clear()
            return batch

        part = 0
        for batch in batches:
            arrow = pa.schema([("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("place", pa.int64()), ("codes", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())])
            for conv, turn, fault, initial, copies, part in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or conv != name or len(codes) >= BLOCK:
                    if out is not None:
                        close(part)
                        number += 1
                    name, out = conv, True
                    codes, low, high, turns = bytearray(), None, None, 0
                if not copies:
                    continue
                codes.append(fault << 2 | initial)
                if copies > 1:
                    codes += bytes([(fault if fault >= BLANK else DUPLICATE) << 2 | initial]) * (copies - 1)
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
            if len(done["codes"]) > 4096:
                yield flush()
        if out is not None:
            close(part)
            yield flush()

    keys = ["conv_id", "turn", "role", "digest"]
    ordered = marks.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select("conv_id", F.col("turn").cast("long"), "fault", "initial", "copies", F.spark_partition_id().alias("part")).mapInArrow(run, schema)


_LEGAL = np.zeros((4, 4), dtype=bool)
_LEGAL[0, 1] = _LEGAL[1, 2] = _LEGAL[2, 1] = True
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _facts(codes: bytes, low: int | None, high: int | None, turns: int) -> tuple:
    rows = np.frombuffer(codes, np.uint8)
    faults = np.bincount(rows >> 2, minlength=4)
    initial = rows & 3
    illegal = int((~_LEGAL[initial[:-1], initial[1:]]).sum())
    gaps = 0 if low is None else min(high - low + 1 - turns, 2**63 - 1)
    return gaps, int(faults[BLANK]), int(faults[DUPLICATE]), int(faults[CUT]), illegal


def diagnose(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    ``rows`` has ``conv_id, turn, role, text, copies`` (see :func:`damaged`).
    """
    return _diagnosed(_rows(rows))


def _diagnosed(rows: DataFrame) -> DataFrame:
    segments = _segments(_marks(rows))
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, {FACTS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, begun = None, False
        codes, low, high, turns = bytearray(), None, None, 0
        held: list[tuple] = []
        waiting = 0

        def solve(kind):
            found = audits([h[1] for h in held])
            columns = [*zip(*((h[0], *_facts(*h[1:]), cost, audit) for h, (cost, audit) in zip(held, found)))]
            held.clear()
            arrow = [kind, *[pa.int64()] * 6, pa.string()]
            names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow)], names=names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, text, first, last, count in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != name:
                    if begun:
                        held.append((name, bytes(codes), low, high, turns))
                        waiting += len(codes) + 1
                    name, begun = conv, True
                    codes, low, high, turns = bytearray(), None, None, 0
                    if waiting >= BLOCK:
                        yield solve(kind)
                        waiting = 0
                codes += text
                if first is not None:
                    # A turn that two runs share counts once.
                    turns += count - (high is not None and first == high)
                    low, high = first if low is None else low, last
        if begun:
            held.append((name, bytes(codes), low, high, turns))
            yield solve(kind)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return ordered.select("conv_id", "codes", "low", "high", "turns").mapInArrow(run, schema)


class _Replay:
    """Applies an audit to the rows of a conversation as they pass by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = FOLLOWS[self.state]
            yield NAMES[self.state], ""

    def row(self, role: str, text: str | None, copies: int) -> Iterator[tuple[str, str]]:
        for _ in range(copies):
            yield from self._inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = STEP[self.state][INITIALS.index(role[0])]
                yield role, text
            elif letter == "R":
                self.state = FOLLOWS[self.state]
                yield NAMES[self.state], text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


def _replayed(rows: DataFrame, facts: DataFrame, consume, schema: str) -> DataFrame:
    """Rows and audits side by side in order; ``consume`` turns each conversation's repaired rows into output rows.

    Texts are read once, in the order of the audit, and not held. The hash of a
    conversation's text can only be taken in order, so one conversation is one task here.
    """
    marked = rows.where("copies > 0").select("conv_id", F.lit(1).alias("tag"), "turn", "role", "digest", "copies", F.when(~_blank(F.col("text")), F.col("text")).alias("text"))
    names = [f.split()[0] for f in FACTS.split(", ")]
    both = facts.withColumn("tag", F.lit(0)).unionByName(marked, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "digest")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one, out = None, []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            for conv, tag, role, copies, text, *about in zip(*(c.to_pylist() for c in batch.columns)):
                if tag == 0:
                    if open_one is not None:
                        out += open_one.end()
                    open_one = consume(conv, about)
                else:
                    out += open_one.row(role, text, copies)
            if out:
                yield batch_of()
                out = []
        if open_one is not None:
            out += open_one.end()
            if out:
                yield batch_of()

    return ordered.select("conv_id", "tag", "role", "copies", "text", *names).mapInArrow(run, schema)


class _Digest:
    """One row a conversation: the facts and the hash of the repaired text."""

    def __init__(self, conv, about) -> None:
        self.facts, self.replay = (conv, *about), _Replay(about[-1])
        self.hash, self.empty = hashlib.sha256(), True

    def _add(self, rows) -> None:
        for role, text in rows:
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self, role, text, copies):
        self._add(self.replay.row(role, text, copies))
        return ()

    def end(self):
        self._add(self.replay.rest())
        return [(*self.facts, self.hash.hexdigest())]


class _Rows:
    """The repaired rows, numbered from 0."""

    def __init__(self, conv, about) -> None:
        self.conv, self.number, self.replay = conv, 0, _Replay(about[-1])

    def _out(self, rows):
        for role, text in rows:
            yield self.conv, self.number, role, text
            self.number += 1

    def row(self, role, text, copies):
        return self._out(self.replay.row(role, text, copies))

    def end(self):
        return self._out(self.replay.rest())


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired conversations as ``conv_id, turn, role, text``, turns from 0.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are left out. Null
    roles and texts are one space, so a null text is blank. Rows go by turn, nulls first,
    then by role and by the text's digest; equal rows of a turn are repeats. Null ids are
    one conversation. Conversations without a right row vanish; no rows give no rows.
    """
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(1).cast("long").alias("copies"))
    rows = _rows(rows)
    facts = materialize(_diagnosed(rows))
    return _replayed(rows, facts, _Rows, f"conv_id {dict(rows.dtypes)['conv_id']}, turn long, role string, text string")


def report(rows: DataFrame) -> DataFrame:
    """The facts of :func:`diagnose` and the hash of the repaired rows, for every conversation."""
    rows = _rows(rows)
    facts = materialize(_diagnosed(rows))
    return _replayed(rows, facts, _Digest, f"conv_id {dict(rows.dtypes)['conv_id']}, {FACTS}, repaired_sha256 string")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(damaged(read_table(spark, sf_dir, "conversations")))


def _sql() -> str:
    """The damage, the cost pass with audit texts beside costs, and the replay, as recursions in SQL."""

    def add(cost: str, letter: str, value: str) -> str:
        # Twelve digits of cost before the audit: texts compare as (cost, audit).
        return f"(lpad(CAST(CAST(left({value}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || substr({value}, 13))"

    price = "CASE WHEN fault = 1 THEN 5 ELSE 0 END"
    stays = "fault < 2"

    def row(s: int) -> str:
        by_role = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s]
        keeps = [f"CASE WHEN {stays} AND initial = '{c}' THEN {add(price, 'K', f'v{t}')} END" for c, t in by_role.items()]
        renamed = f"CASE WHEN {stays} THEN {add(f'1 + {price}', 'R', f'v{FOLLOWS[s]}')} END"
        return f"least({', '.join([add('2', 'D', f'v{s}'), renamed, *keeps])}) AS x{s}"

    return f"""WITH RECURSIVE crc AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM (SELECT unnest(range(256)) AS n))),
    named AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    drawn AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(CAST(f.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS draw
      FROM conversations f JOIN named m ON f.conv_id IS NOT DISTINCT FROM m.conv_id, crc),
    hurt AS (SELECT c, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
      CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE draw <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM hurt),
    rows_in AS MATERIALIZED (SELECT c, i, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
      CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 3
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault FROM placed),
    facts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
      count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
      count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows_in GROUP BY c),
    search AS (SELECT c, n + 1 AS i, '{0:012d}' AS v0, '{10:012d}II' AS v1, '{5:012d}I' AS v2, '{0:012d}' AS v3 FROM facts
      UNION ALL SELECT c, i, least(x0, {add('5', 'I', 'y2')}) AS v0, least(x1, {add('5', 'I', 'y2')}) AS v1, y2 AS v2, y3 AS v3 FROM
      (SELECT *, least(x2, {add('5', 'I', 'x3')}) AS y2, least(x3, {add('5', 'I', 'x2')}) AS y3 FROM
      (SELECT r.c, r.i, {", ".join(row(s) for s in range(4))} FROM search s JOIN rows_in r ON r.c = s.c AND r.i = s.i - 1))),
    audits AS MATERIALIZED (SELECT c, CAST(left(v0, 12) AS BIGINT) AS cost, substr(v0, 13) AS audit FROM search WHERE i = 1),
    replay AS (SELECT c, 0 AS p, 0::BIGINT AS i, 0 AS state, CAST(NULL AS VARCHAR) AS line FROM audits
      UNION ALL SELECT c, p, i, state, CASE letter WHEN 'K' THEN role || ':' || text WHEN 'R' THEN name || ':' || text WHEN 'I' THEN name || ':' END AS line FROM
      (SELECT *, CASE WHEN state = 3 THEN 'assistant' ELSE 'user' END AS name FROM
      (SELECT y.c, y.p + 1 AS p, y.i + CASE WHEN letter = 'I' THEN 0 ELSE 1 END AS i, letter, r.role, r.text,
        CASE letter WHEN 'D' THEN state WHEN 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN state = 2 THEN 3 ELSE 2 END END AS state
        FROM (SELECT q.c, q.p, q.i, q.state, substr(audit, q.p + 1, 1) AS letter FROM replay q JOIN audits a ON a.c = q.c WHERE q.p < length(audit)) y
        LEFT JOIN rows_in r ON r.c = y.c AND r.i = y.i + 1 AND letter <> 'I'))),
    repaired AS (SELECT c, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (line IS NOT NULL), '')) AS h FROM replay GROUP BY c)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
    FROM named LEFT JOIN facts USING (c) LEFT JOIN audits USING (c) LEFT JOIN repaired USING (c)"""


SQL = _sql()
