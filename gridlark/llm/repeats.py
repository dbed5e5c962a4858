"""Removal of repeated passages by longest previous factors, distributed over anchors.

A byte goes if a string of ``DEPTH`` bytes that covers it also starts in a document with a
smaller id. In a suffix array the nearest smaller positions before and after a suffix give
its longest earlier match; here positions count by document, and matches are asked for up
to ``DEPTH`` bytes.

No task holds the suffix array of the corpus; longest-previous-factor arrays are made bucket
by bucket. Every window of ``DEPTH`` bytes has an
anchor, the gram of ``GRAM`` bytes in it with the smallest hash, so equal windows have
equal anchors. Round one counts anchors: a window whose anchor occurs in one document only
can't repeat. Round two sorts the windows of the other anchors, bucket by bucket, in suffix
order, and finds those with an earlier match. Between the rounds only bit masks travel
back to the text, which is kept in packed chunks.

Round one also counts the contexts of each anchor. The windows of an anchor with more than
``HOT`` of them are dealt out one by one, by a hash of the whole window, into buckets of
their own, so no bucket holds all that surrounds a common phrase.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import read_table, text_bytes
from gridlark.sources.shared import materialize

DEPTH = 50
GRAM = 20
SPAN = DEPTH - GRAM + 1
CHUNK_BYTES = 2 << 20
# Text per bucket of anchors; about one byte in sixteen is an anchor.
BUCKET_BYTES = 8 << 20
# Contexts (of up to 80 bytes) of one anchor in one bucket, and windows in a bucket for those of anchors with more.
HOT = 1 << 15
HOT_WINDOWS = 1 << 19
SLICE = 1 << 21
_PLACE = np.uint64((1 << 22) - 1)
_FACTOR = 0x9E3779B97F4A7C15
NO_ID = np.iinfo(np.int64).max


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram: polynomial by doubling, then mixed."""
    power = lambda n: np.uint64(pow(_FACTOR, n, 1 << 64))
    part, size = data.astype(np.uint64) + np.uint64(1), 1
    whole, done, left = None, 0, GRAM
    while True:
        if left & 1:
            if whole is None:
                whole, done = part, size
            else:
                n = len(part) - done
                whole = whole[:n] * power(size) + part[done:]
                done += size
        left >>= 1
        if not left:
            break
        part = part[:-size] * power(size) + part[size:]
        size *= 2
    whole = whole ^ (whole >> np.uint64(31))
    whole = whole * np.uint64(0xD6E8FEB86659FD93)
    return whole ^ (whole >> np.uint64(32))


class Runs:
    """Runs of consecutive windows with one anchor: first and last start, hash, document, place of the anchor."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        out = []
        for at in range(0, len(data), SLICE):
            piece = data[at : at + SLICE + DEPTH - 1]
            if len(piece) < DEPTH:
                continue
            hashes = _gram_hashes(piece)
            # The smallest hash, the leftmost of equal ones.
            low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
            step = 1
            while 2 * step <= SPAN:
                low = np.minimum(low[:-step], low[step:])
                step *= 2
            low = np.minimum(low[: len(low) - (SPAN - step)], low[SPAN - step :])
            anchor = (low & _PLACE).astype(np.int32)
            doc = np.searchsorted(ends, [at, at + len(anchor) - 1], side="right")
            inner = ends[doc[0] : doc[1] + 1] - at
            counts = np.diff(np.concatenate([[0], np.minimum(inner, len(anchor))]))
            owner = np.repeat(np.arange(doc[0], doc[0] + len(counts), dtype=np.int32), counts)
            room = np.repeat(inner.astype(np.int32), counts) - np.arange(len(anchor), dtype=np.int32)
            starts = np.flatnonzero(room >= DEPTH).astype(np.int32)
            if not len(starts):
                continue
            mine = anchor[starts]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(mine) != 0) | (np.diff(starts) != 1)]))
            last = np.append(new[1:], len(starts)) - 1
            out.append((starts[new].astype(np.int64) + at, starts[last].astype(np.int64) + at, hashes[mine[new]], owner[starts[new]], (mine - starts)[new]))
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.first, self.last, chosen, self.doc, self.offset = [np.concatenate(c) for c in zip(*out)] if out else empty
        # Anchors have small hashes; mixed once more they are even over the buckets.
        chosen = (chosen ^ (chosen >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.hash = (chosen ^ (chosen >> np.uint64(32))) * np.uint64(_FACTOR)

    def buckets(self, n: int) -> np.ndarray:
        return (((self.hash >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)).astype(np.int64)


def _distinct(runs: Runs, ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors of a chunk in order of bucket and hash.

    Gives their hashes, their buckets, the place of each run's anchor among them, and
    whether several documents of the chunk have it.
    """
    # The bucket goes by the hash's top bits, so one sort orders both.
    hashes, place = np.unique(runs.hash, return_inverse=True)
    owner = ids[runs.doc]
    low, high = np.full(len(hashes), NO_ID), np.full(len(hashes), np.iinfo(np.int64).min)
    np.minimum.at(low, place, owner)
    np.maximum.at(high, place, owner)
    bucket = (((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)
    return hashes, bucket, place, low != high


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, ids, sizes, data``: documents packed as they are read, about ``CHUNK_BYTES`` each."""

    def pack(parts):
        base, seq = TaskContext.get().partitionId() << 32, 0
        press = zstandard.ZstdCompressor(level=1)
        ids, texts, size = [], [], 0

        def row():
            cells = {"chunk": [base + seq], "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), "data": [press.compress(b"".join(texts))]}
            return pa.RecordBatch.from_pydict(cells)

        for batch in parts:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc_id)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield row()
                    ids, texts, size, seq = [], [], 0, seq + 1
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return rows.mapInArrow(pack, "chunk long, ids array<long>, sizes array<long>, data binary")


def _opened(ids: list, sizes: list, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.array([NO_ID if i is None else i for i in ids], np.int64)
    text = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, sum(sizes))) if data else b""
    return order, np.array(sizes, np.int64), np.frombuffer(text, np.uint8)


def _packed_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _parts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """The buckets that a sorted bucket column holds, each with the range of its rows."""
    names, first = np.unique(bucket, return_index=True)
    return list(zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)]))


def _range(bucket: np.ndarray, name: int) -> slice:
    """The rows of one bucket in a sorted bucket column."""
    return slice(*np.searchsorted(bucket, [name, name + 1]).tolist())


def _context_counts(runs: Runs, place: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """How many different contexts each of a chunk's ``n`` anchors has."""
    counts = np.bincount(place, minlength=n)
    many = np.flatnonzero(counts[place] > 1)
    raw = text.tobytes()
    rows = zip(runs.first[many].tolist(), runs.last[many].tolist(), place[many].tolist())
    # Equal contexts have equal anchors.
    found = {raw[a : z + DEPTH]: p for a, z, p in rows}
    distinct = np.bincount(np.fromiter(found.values(), np.int64, len(found)), minlength=n)
    return np.where(counts > 1, distinct, counts)


def _anchor_lists(buckets: int):
    """Round one, at the text: each chunk's distinct anchors, six bytes each, and their counts of contexts, by bucket."""

    def run(parts):
        for batch in parts:
            for chunk, ids, sizes, data in zip(*(c.to_pylist() for c in batch.columns)):
                order, lengths, text = _opened(ids, sizes, data)
                runs = Runs(text, lengths)
                hashes, bucket, place, _ = _distinct(runs, order, buckets)
                counts = _context_counts(runs, place, text, len(hashes)).astype("<u4")
                low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows = [(b, *(x[lo:hi].tobytes() for x in (low, counts))) for b, lo, hi in _parts(bucket)]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()), "anchors": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _shared_anchors(hot: int):
    """Round one, at a bucket: which anchors of each chunk other chunks have too, and which are hot everywhere."""

    def run(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(a, np.uint8).reshape(-1, 6) for a in table.column("anchors").to_pylist()]
        wide = np.zeros((sum(map(len, lists)), 8), np.uint8)
        wide[:, :6] = np.concatenate(lists)
        _, place, counts = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        contexts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
        again, many = counts[place] > 1, (np.bincount(place, contexts) > hot)[place]
        masks, hots, n_hot = [], [], []
        ends = np.cumsum([len(x) for x in lists])
        for x, end in zip(lists, ends):
            mine = slice(end - len(x), end)
            masks.append(_packed_bits(again[mine]))
            hots.append(_packed_bits(many[mine]) if many[mine].any() else b"")
            n_hot.append(int(contexts[mine][many[mine]].sum()))
        cells = {"mask": pa.array(masks, pa.binary()), "hot": pa.array(hots, pa.binary()), "n_hot": pa.array(n_hot, pa.int64())}
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), **cells})

    return run


def _window_hashes(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the ``DEPTH`` bytes at each start."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(DEPTH):
        out = out * np.uint64(_FACTOR) + text[starts + j] + np.uint64(1)
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


class _Contexts:
    """The windows of a chunk's shared anchors as contexts, by bucket.

    Equal contexts of a chunk travel once, for their smallest id; the others are known to
    repeat. Each window of a hot anchor is a context of its own, in one of the ``extra``
    buckets after the others.
    """

    def __init__(self, order: np.ndarray, sizes: np.ndarray, text: np.ndarray, masks: list, buckets: int, extra: int) -> None:
        runs = Runs(text, sizes)
        hashes, bucket, place, several = _distinct(runs, order, buckets)
        shared, hot = several, np.zeros(len(hashes), bool)
        for b, mask, hots in masks:
            mine = _range(bucket, b)
            n = mine.stop - mine.start
            shared[mine] |= _bits(mask, n)
            if hots:
                hot[mine] = _bits(hots, n)
        picked = np.flatnonzero(shared[place])
        single = hot[place[picked]]
        each = np.where(single, runs.last[picked] - runs.first[picked] + 1, 1)
        inside, single, picked = _spread(each), np.repeat(single, each), np.repeat(picked, each)
        first = runs.first[picked] + inside
        last, offset, at_bucket = np.where(single, first, runs.last[picked]), runs.offset[picked] - inside, bucket[place[picked]]
        if single.any():
            at_bucket[single] = buckets + (_window_hashes(text, first[single]) % np.uint64(extra)).astype(np.int64)
        by_bucket = np.argsort(at_bucket, kind="stable")
        self.first, self.last, self.bucket = first[by_bucket], last[by_bucket], at_bucket[by_bucket]
        self.owner, offset = order[runs.doc[picked[by_bucket]]], offset[by_bucket]
        raw = text.tobytes()
        seen: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.lowest: list[int] = []
        self.offsets: list[int] = []
        self.slot = np.empty(len(self.first), np.int64)
        at, where = -1, []
        rows = (self.first, self.last, offset, self.bucket, self.owner)
        for i, (a, z, into, b, own) in enumerate(zip(*(r.tolist() for r in rows))):
            if b != at:
                seen, at = {}, b
            context = raw[a : z + DEPTH]
            k = seen.get(context)
            if k is None:
                k = seen[context] = len(self.texts)
                self.texts.append(context)
                self.lowest.append(own)
                self.offsets.append(into)
                where.append(b)
            elif own < self.lowest[k]:
                self.lowest[k] = own
            self.slot[i] = k
        self.where = np.array(where, np.int64)


def _context_lists(buckets: int, extra: int):
    """Round two, at the text: contexts with their smallest id, by bucket."""

    def run(parts):
        press = zstandard.ZstdCompressor(level=3)
        for batch in parts:
            for chunk, ids, sizes, data, masks in zip(*(c.to_pylist() for c in batch.columns)):
                found = _Contexts(*_opened(ids, sizes, data), [(m["bucket"], m["mask"], m["hot"]) for m in masks or []], buckets, extra)
                rows = []
                for b, lo, hi in _parts(found.where):
                    sizes_b = np.array([len(t) for t in found.texts[lo:hi]], np.uint8)
                    offsets = np.array(found.offsets[lo:hi], np.uint8)
                    body = sizes_b.tobytes() + offsets.tobytes() + np.array(found.lowest[lo:hi], "<i8").tobytes() + b"".join(found.texts[lo:hi])
                    rows.append((b, int(hi - lo), press.compress(body)))
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()), "n": pa.array([r[1] for r in rows], pa.int32()), "body": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _neighbours(keys: list[np.ndarray], order: np.ndarray, least: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in suffix order, at most ``DEPTH``; 0 for the first.

    Fewer than ``least`` may be given as 0.
    """
    shared = np.full(len(order), DEPTH, np.int32)
    for at, key in reversed(list(zip(_WORDS, keys))):
        sorted_key = key[order]
        if least >= DEPTH:
            shared[1:][sorted_key[1:] != sorted_key[:-1]] = 0
            continue
        differs = sorted_key[1:] ^ sorted_key[:-1]
        places = np.flatnonzero(differs)
        # Whole bytes before the first differing one; a word's first byte is its highest.
        equal = np.zeros(len(places), np.int32)
        rest = differs[places]
        for width in (32, 16, 8):
            high = rest >> np.uint64(64 - width) == 0
            equal[high] += width // 8
            rest[high] <<= np.uint64(width)
        shared[places + 1] = at + equal
    shared[:1] = 0
    return shared


def _smaller_before(owner: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Bytes shared with the previous position of a smaller owner, 0 without one; fewer than ``least`` may be anything less.

    All positions look at once: between a position and the one it points to no owner is
    smaller than its own. If the one pointed to isn't smaller either, the pointer of that
    one is taken over, with the lesser of both lengths.
    """
    at = np.arange(len(owner)) - 1
    length = shared.copy()
    open_ = np.flatnonzero(length >= max(least, 1))
    while True:
        # A length that is too short can't grow again.
        open_ = open_[(at[open_] >= 0) & (length[open_] >= max(least, 1))]
        open_ = open_[owner[at[open_]] >= owner[open_]]
        if not len(open_):
            break
        via = at[open_]
        length[open_] = np.minimum(length[open_], length[via])
        at[open_] = at[via]
    length[at < 0] = 0
    return length


# Starts of the eight-byte words that tell windows apart; the last one overlaps.
_WORDS = (*range(0, DEPTH - 8, 8), DEPTH - 8)


def longest_previous_factors(text: np.ndarray, starts: np.ndarray, owner: np.ndarray, least: int = 0) -> np.ndarray:
    """For each suffix of ``starts`` the longest match, up to ``DEPTH`` bytes, with one of a smaller owner.

    Matches shorter than ``least`` aren't followed and may be given shorter than they are.
    The suffixes are put in suffix order to that depth. The longest match is with the
    nearest suffix of a smaller owner before or after: as long as the least of the lengths
    that neighbours share on the way there.
    """
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(text), np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j : j + len(text)]
    keys = [word[starts + j] for j in _WORDS]
    order = np.lexsort((owner, *keys[::-1]))
    shared = _neighbours(keys, order, least)
    ranked = owner[order]
    before = _smaller_before(ranked, shared, least)
    # The same from the other end: what a suffix shares with the next one stands there with the next one.
    after = _smaller_before(ranked[::-1].copy(), np.append(shared[1:], 0)[::-1], least)[::-1]
    out = np.zeros(len(starts), np.int64)
    out[order] = np.maximum(before, after)
    return out


def earlier_matches(text: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which of the suffixes at ``starts`` match ``DEPTH`` bytes of one with a smaller owner."""
    return longest_previous_factors(text, starts, owner, DEPTH) >= DEPTH


def _spread(counts: np.ndarray) -> np.ndarray:
    """``0 .. count - 1`` for each of the counts."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _matched_windows(table: pa.Table) -> pa.Table:
    """Round two, at a bucket: which windows of each chunk's contexts occur in an earlier document.

    Equal contexts are one from here on, for their smallest owner. Only contexts that share
    their anchor's gram with another one can share some windows but not all; the windows of
    those are sorted as suffixes. Where all contexts of a gram are single windows, as those
    of hot anchors are, different ones share none.
    """
    slots: dict[bytes, int] = {}
    lowest: list[int] = []
    grams: list[bytes] = []
    slot, owners, sizes = [], [], []
    for n, body in zip(table.column("n").to_pylist(), table.column("body").to_pylist()):
        body = zstandard.ZstdDecompressor().decompress(body)
        owner = np.frombuffer(body, "<i8", n, 2 * n)
        at = 10 * n
        for size, offset, own in zip(body[:n], body[n : 2 * n], owner.tolist()):
            context = body[at : at + size]
            at += size
            k = slots.get(context)
            if k is None:
                k = slots[context] = len(lowest)
                lowest.append(own)
                grams.append(context[offset : offset + GRAM])
            elif own < lowest[k]:
                lowest[k] = own
            slot.append(k)
        owners.append(owner)
        sizes.append(n)
    counts: dict[bytes, int] = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    least = np.array(lowest, np.int64)
    lengths = np.fromiter(map(len, slots), np.int64, len(slots))
    windows = lengths - DEPTH + 1
    offset = np.cumsum(windows) - windows
    matched = np.zeros(int(windows.sum()), bool)
    wide = {g for g, n in zip(grams, windows.tolist()) if n > 1}
    mixed = np.flatnonzero(np.fromiter((counts[g] > 1 and g in wide for g in grams), bool, len(grams)))
    if len(mixed):
        each = windows[mixed]
        chosen = set(mixed.tolist())
        text = np.frombuffer(b"".join(c for k, c in enumerate(slots) if k in chosen), np.uint8)
        begins = np.cumsum(lengths[mixed]) - lengths[mixed]
        within = _spread(each)
        found = earlier_matches(text, np.repeat(begins, each) + within, np.repeat(least[mixed], each))
        matched[np.repeat(offset[mixed], each) + within] = found
    masks, done = [], 0
    for n, owner in zip(sizes, owners):
        mine = np.array(slot[done : done + n], np.int64)
        done += n
        each = windows[mine]
        bits = matched[np.repeat(offset[mine], each) + _spread(each)] | np.repeat(owner > least[mine], each)
        masks.append(_packed_bits(bits))
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "mask": pa.array(masks, pa.binary())})


def _removed(found: _Contexts, replies: list, size: int) -> np.ndarray:
    """Whether each byte of a chunk is covered by a matched window."""
    counts = np.array([len(t) - DEPTH + 1 for t in found.texts], np.int64)
    offset = np.cumsum(counts) - counts
    matched = np.zeros(int(counts.sum()), bool)
    for b, mask in replies:
        mine = _range(found.where, b)
        n = int(counts[mine].sum())
        matched[offset[mine.start] : offset[mine.start] + n] = _bits(mask, n)
    each = found.last - found.first + 1
    inside = _spread(each)
    lowest = np.array(found.lowest, np.int64)
    # Copies in one chunk repeat their smallest id's; that one asks the other chunks.
    copy = found.owner > lowest[found.slot] if len(each) else np.zeros(0, bool)
    hit = matched[np.repeat(offset[found.slot], each) + inside] | np.repeat(copy, each) if len(each) else np.zeros(0, bool)
    starts = (np.repeat(found.first, each) + inside)[hit]
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + DEPTH, -1)
    return np.cumsum(change[:-1]) > 0


def _cleaned(buckets: int, extra: int, keep_text: bool):
    def run(parts):
        for batch in parts:
            for _, ids, sizes, data, masks, replies in zip(*(c.to_pylist() for c in batch.columns)):
                order, lengths, text = _opened(ids, sizes, data)
                found = _Contexts(order, lengths, text, [(m["bucket"], m["mask"], m["hot"]) for m in masks or []], buckets, extra)
                gone = _removed(found, [(m["bucket"], m["mask"]) for m in replies or []], len(text))
                out: dict[str, list] = {"doc_id": ids, "n_bytes": sizes, "n_removed": [], "n_spans": [], "kept": []}
                at = 0
                for n in sizes:
                    mine, body = gone[at : at + n], text[at : at + n]
                    at += n
                    removed = int(mine.sum())
                    out["n_removed"].append(removed)
                    out["n_spans"].append(int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()))
                    kept = (body[~mine] if removed else body).tobytes()
                    out["kept"].append(kept if keep_text else hashlib.sha256(kept).hexdigest())
                types = [pa.int64()] * 4 + [pa.binary() if keep_text else pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every document.

    ``kept`` holds the remaining bytes, or their SHA-256 in hex if not ``keep_text``. Null
    texts are empty; texts shorter than ``DEPTH`` bytes stay. Rows with one id are one
    document to each other: equal ids aren't smaller. Rows without an id come after all
    others, and aren't smaller than each other. No rows give no rows. Anchors with more
    than ``hot`` contexts are dealt out by window.
    """
    chunks = materialize(_chunks(docs))
    size = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    anchors = chunks.mapInArrow(_anchor_lists(buckets), "chunk long, bucket int, anchors binary, counts binary")
    # The work is Python's and not seen in bytes, so the number of tasks is given.
    masks = anchors.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared_anchors(hot), "chunk long, bucket int, mask binary, hot binary, n_hot long")
    first = materialize(_by_chunk(masks, "masks", "mask", "hot", "n_hot"))
    n_hot = first.select(F.sum(F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + m["n_hot"]))).first()[0] or 0
    extra = -(-n_hot * SPAN // HOT_WINDOWS)
    spread = chunks.repartition(buckets, "chunk")
    asked = spread.join(first, "chunk", "left")
    contexts = asked.mapInArrow(_context_lists(buckets, extra), "chunk long, bucket int, n int, body binary")
    replies = contexts.repartition(buckets + extra, "bucket").groupBy("bucket").applyInArrow(_matched_windows, "chunk long, bucket int, mask binary")
    second = _by_chunk(replies, "replies", "mask")
    answered = spread.join(first, "chunk", "left").join(second, "chunk", "left")
    kind = "binary" if keep_text else "string"
    return answered.mapInArrow(_cleaned(buckets, extra, keep_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")


def _by_chunk(masks: DataFrame, name: str, *cells: str) -> DataFrame:
    """One row of bit masks per chunk; bounded by a bit for each window of a chunk."""
    return masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *cells)).alias(name))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), keep_text=False).withColumnRenamed("kept", "kept_sha256")
