"""Best-fit packing of token sequences by large-item matching.

Only lengths matter for the plan, and there are at most ``capacity`` of them, so the whole
corpus is packed from one histogram: full pieces stand alone; pieces above a third of the
capacity are matched, at most two per bin, each with the largest partner that fits; smaller
ones go best-fit, longest first, into the gaps that remain. The plan is a list of runs
"so many pieces of this length, so many per bin"; a piece finds its bin by its rank among
the pieces of its length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, gapless, read_table
from gridlark.sources.shared import materialize

CAPACITY = 1024
END_ID = 2
# Longer runs of whitespace are more than the fast encoder's pattern can look back over.
_LONG_RUN = 100_000
_LONG_BLANK = re.compile(rf"\s{{{_LONG_RUN}}}")


@lru_cache(maxsize=2)
def _encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """Text to ids. The rank file is the same vocabulary, several times faster."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    if ranks_path is None:
        return lambda text: slow.encode(text, add_special_tokens=False).ids
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        # Special tokens spelled in a text are ids of their own for the tokenizer file.
        if any(s in text for s in special) or (len(text) >= _LONG_RUN and _LONG_BLANK.search(text)):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def tokenizer_files(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """Paths of a public vocabulary as tokenizer file and rank file, and its split pattern."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def pieces(docs: DataFrame, files: tuple = (), capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document.

    A document is its ids and the end id. A longer one than ``capacity`` is cut into full
    pieces, of which the first may be shorter. Null and empty texts have the end id only.
    A very long text takes memory in proportion to its length in the task that has it.
    """
    files = tuple(files) or tokenizer_files()

    def step(ids, texts):
        encode = _encoder(*files)
        out = defaultdict(list)
        for doc_id, text in zip(ids, texts):
            tokens = np.array(encode(text or "") + [END_ID], dtype="<u4")
            first = len(tokens) % capacity or capacity
            cuts = [0, *range(first, len(tokens) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                for name, value in (("doc_id", doc_id), ("piece", k), ("start", a), ("length", b - a), ("ids_crc32", zlib.crc32(tokens[a:b].tobytes()))):
                    out[name].append(value)
        return out if out else None

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"
    return batches(docs.select("doc_id", "text"), step, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces, first bin, pieces per bin, offset)``.

    Pieces of a run fill bins one after the other, ``pieces per bin`` at a time from
    ``offset`` on.
    """
    left = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int, int]] = []
    # Open bins by the room that is left: (first bin, bins).
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def put(length: int, n: int, first: int, per_bin: int, offset: int) -> None:
        runs.append((length, used[length], n, first, per_bin, offset))
        used[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    def opened(room: int, first: int, n: int) -> None:
        if room and n:
            open_bins[room].append((first, n))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        while left.get(length):
            have = left[length]
            partner = next((m for m in large if m in left and length + m <= capacity and (m != length or have > 1)), None)
            if partner is None:
                put(length, have, bins, 1, 0)
                opened(capacity - length, bins, have)
                bins += have
            elif partner == length:
                n = have // 2
                put(length, 2 * n, bins, 2, 0)
                opened(capacity - 2 * length, bins, n)
                bins += n
            else:
                n = min(have, left[partner])
                put(length, n, bins, 1, 0)
                put(partner, n, bins, 1, length)
                opened(capacity - length - partner, bins, n)
                bins += n
    for length in sorted(left, reverse=True):
        while left.get(length):
            have = left[length]
            room = min((r for r in open_bins if r >= length and open_bins[r]), default=None)
            if room is None:
                per = capacity // length
                n, rest = divmod(have, per)
                if n:
                    put(length, n * per, bins, per, 0)
                    opened(capacity - per * length, bins, n)
                    bins += n
                if rest:
                    put(length, rest, bins, rest, 0)
                    opened(capacity - rest * length, bins, 1)
                    bins += 1
                continue
            first, n = open_bins[room].pop()
            per = room // length
            full = min(n, have // per)
            rest = have - full * per if full < n else 0
            offset = capacity - room
            if full:
                put(length, full * per, first, per, offset)
                opened(room - per * length, first, full)
            if rest and full < n:
                put(length, rest, first + full, rest, offset)
                opened(room - rest * length, first + full, 1)
                full += 1
            opened(room, first + full, n - full)
    return runs


def pack(docs: DataFrame, files: tuple = (), capacity: int = CAPACITY) -> DataFrame:
    """The pieces of :func:`pieces` with ``sequence_id`` and ``offset``.

    Sequences are numbered from 0 without gaps and filled from offset 0 without gaps.
    The plan depends on the histogram of lengths alone (at most ``capacity`` numbers come
    to the driver); its runs, a bounded number too, are broadcast. Repeated rows are
    pieces of their own; no rows give no rows.
    """
    cut = materialize(pieces(docs, files, capacity).withColumn("_place", F.monotonically_increasing_id()))
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}
    runs = sorted(plan(counts, capacity))
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    ranked = gapless(cut.withColumn("_draw", F.xxhash64("_place")), "length", "_draw", max(counts.values(), default=1), "_rank")
    shared = fresh(docs.sparkSession, table)
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(parts):
        table = shared.value
        # Runs are sorted by length and rank, so one search in the joint key finds a run.
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in parts:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            run = table[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            within = rank - run[:, 1]
            sequence = run[:, 3] + within // run[:, 4]
            offset = run[:, 5] + within % run[:, 4] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=list(names))

    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    return rows.mapInArrow(place, schema)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
