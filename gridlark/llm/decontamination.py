"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words that occurs in some item. A document is
streamed through it once; at each word the longest suffix that occurs in an item is
known, so every window of ``window`` words that some item holds is found, with the items
that hold it, in time linear in the document.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, read_table, text_bytes
from gridlark.sources.shared import materialize

WINDOW = 10
# A document of which more than this share of words is hit is no longer worth keeping.
MAX_COVERAGE = 0.5
# Words of items in one automaton; more items are matched in further passes.
MAX_ITEM_WORDS = 2_000_000

# Words: ASCII letters and digits in lower case, and everything beyond ASCII. All other
# bytes become blanks; UTF-8 keeps bytes of longer characters at 0x80 and above.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_TABLE).split() if data else []


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each state."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = array("q", [-1])
        self.size = array("q", [0])
        self._items: list[list[int]] = []

    def _state(self, size: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, at: int, word: int, child: int) -> int:
        """A copy of ``child`` that holds only the strings one longer than those of ``at``."""
        copy = self._state(self.size[at] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while at >= 0 and self.next[at].get(word) == child:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        child = self.next[last].get(word)
        if child is not None:
            return child if self.size[child] == self.size[last] + 1 else self._split(last, word, child)
        new = self._state(self.size[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            child = self.next[last][word]
            self.link[new] = child if self.size[child] == self.size[last] + 1 else self._split(last, word, child)
        return new

    def add(self, text: bytes | None) -> None:
        """Add one item; items are numbered in the order they are added."""
        numbers = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
        self._items.append(numbers)
        last = 0
        for n in numbers:
            last = self._extend(last, n)

    def finish(self) -> "SuffixAutomaton":
        """Mark states with their items, and windows' and short items' states."""
        states = len(self.size)
        holders: list[list[int]] = [[] for _ in range(states)]
        short: list[tuple[tuple[int, int], ...]] = [()] * states
        seen = array("q", [-1]) * states
        for item, numbers in enumerate(self._items):
            at = 0
            for n in numbers:
                at = self.next[at][n]
                up = at
                # Above the window's length the holders of the window's own state are asked for.
                while up > 0 and seen[up] != item:
                    seen[up] = item
                    if self.size[up] >= self.window:
                        holders[up].append(item)
                    up = self.link[up]
            if 0 < len(numbers) < self.window:
                short[at] += ((len(numbers), item),)
        self.top = array("q", [-1]) * states  # the state of the last ``window`` words
        for s in sorted(range(1, states), key=self.size.__getitem__):
            up = self.link[s]
            short[s] += short[up]
            if self.size[s] >= self.window:
                self.top[s] = s if self.size[up] < self.window else self.top[up]
        self.holders, self.short = [tuple(h) for h in holders], short
        return self

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal hit runs ``[start, end)`` of word positions, and the numbers of the items."""
        move, link, size, short, top, w = self.next, self.link, self.size, self.short, self.top, self.window
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        tops: set[int] = set()
        at = length = 0
        root = move[0]
        for i, n in enumerate(map(self.words.get, words)):
            if n is None:
                at = length = 0
                continue
            child = move[at].get(n)
            if child is None:
                while at and child is None:
                    at = link[at]
                    child = move[at].get(n)
                length = size[at]
                if child is None:
                    child = root[n]
            at = child
            length += 1
            reach = 0
            if length >= w:
                tops.add(top[at])
                reach = w
            if short[at]:
                for k, item in short[at]:
                    if k <= length:
                        items.add(item)
                        reach = max(reach, k)
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for s in tops:
            items.update(self.holders[s])
        return spans, items


def _cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``data`` without the bytes from the first to the last word of each span."""
    plain = data.translate(_TABLE)
    places, at = [], 0
    for word in plain.split():
        at = plain.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, done = [], 0
    for start, end in spans:
        kept.append(data[done : places[start][0]])
        done = places[end - 1][1]
    return b"".join([*kept, data[done:]])


def _automata(benchmark: DataFrame, window: int, limit: int):
    """Automata of at most ``limit`` item words each (or one longer item)."""
    automaton, names, words = SuffixAutomaton(window), [], 0
    for row in benchmark.select("item_id", text_bytes()).orderBy("item_id", "text").toLocalIterator():
        automaton.add(row[1])
        names.append(None if row[0] is None else str(row[0]))
        words += len(automaton._items[-1])
        if words >= limit:
            yield automaton.finish(), names
            automaton, names, words = SuffixAutomaton(window), [], 0
    if names:
        yield automaton.finish(), names


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = MAX_ITEM_WORDS) -> DataFrame:
    """``doc_id, text, n_words, starts, ends, items`` for every document.

    ``starts`` and ``ends`` are the hit runs in word positions, ``items`` the distinct
    ids of items with an occurring window. Null and empty texts have no words; repeated
    rows are judged one by one; an empty benchmark hits nothing; items without words
    hold no window; an item without an id hits words but isn't listed. An automaton is
    broadcast for at most ``limit`` item words; further items take further passes.
    """
    out = docs.select("doc_id", text_bytes()).withColumns(
        {"n_words": F.lit(0).cast("long"), "starts": F.array().cast("array<long>"), "ends": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
    )

    def step(ids, texts, counts, starts, ends, items, value):
        automaton, names = value
        for i, text in enumerate(texts):
            words = words_of(text)
            counts[i] = len(words)
            spans, found = automaton.matches(words)
            if spans:
                runs: list[list[int]] = []
                for a, b in sorted([*spans, *zip(starts[i], ends[i])]):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
                starts[i], ends[i] = [a for a, _ in runs], [b for _, b in runs]
                items[i] = sorted({*items[i], *(names[k] for k in found if names[k] is not None)})
        return {"doc_id": ids, "text": texts, "n_words": counts, "starts": starts, "ends": ends, "items": items}

    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, text binary, n_words long, starts array<long>, ends array<long>, items array<string>"
    shared = None
    for value in _automata(benchmark, window, limit):
        if shared is not None:
            # Written, so that neither driver nor tasks hold two automata.
            out = materialize(out)
            shared.destroy()
        shared = fresh(docs.sparkSession, value)
        del value
        out = batches(out, step, schema, shared)
    if shared is None:
        out = batches(out, step, schema, fresh(docs.sparkSession, (SuffixAutomaton(window).finish(), [])))
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One digest row per document; see :func:`matched`."""
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return matched(docs, benchmark, window).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, limit: int = MAX_ITEM_WORDS
) -> DataFrame:
    """The documents without benchmark passages; all columns and clean rows stay as they are.

    Hit runs are cut from the text (``n_chars``, if there, follows). A document of which
    more than ``max_coverage`` of the words is hit goes altogether. Null texts stay. With
    more than ``limit`` item words the runs of all automata are found on the original
    text, and judged and cut together at the last; one automaton is held at a time.
    """
    spans, shared = "_gridlark_spans", None
    out = docs.withColumn(spans, F.array().cast("array<long>"))
    for value in _automata(benchmark, window, limit):
        if shared is not None:
            # Written, so that the tasks of a later pass don't load this automaton again.
            out = materialize(out.withColumn(spans, _gathered(shared)(F.col("text").cast("binary"), spans)))
            shared.destroy()
        shared = fresh(docs.sparkSession, value)
        del value
    if shared is None:
        return docs

    @F.pandas_udf("binary")
    def cleaned(texts, earlier):
        import pandas as pd

        automaton, _ = shared.value
        result = []
        for text, before in zip(texts, earlier):
            words = words_of(text)
            runs = _united(automaton.matches(words)[0], before)
            gone = sum(b - a for a, b in runs) > max_coverage * len(words)
            result.append(text if not runs else None if gone else _cut(text, runs))
        return pd.Series(result, dtype=object)

    # A null result for a text that isn't null says that the document goes. Spark would push
    # the filter below the projection and match every text twice; it leaves such functions be.
    text = F.decode(cleaned.asNondeterministic()(F.col("text").cast("binary"), spans), "UTF-8")
    changed = out.select("*", F.struct(text.alias("t")).alias("_gridlark_cleaned"))
    changed = changed.where(F.col("text").isNull() | F.col("_gridlark_cleaned.t").isNotNull())
    new = {"text": F.col("_gridlark_cleaned.t")}
    if "n_chars" in docs.columns:
        same = F.col("_gridlark_cleaned.t").eqNullSafe(F.col("text"))
        new["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length("_gridlark_cleaned.t")).cast(dict(docs.dtypes)["n_chars"])
    return changed.withColumns(new).select(*docs.columns)


def _united(spans: list[tuple[int, int]], before) -> list[tuple[int, int]]:
    """Hit runs together with those of earlier passes, given as ``start, end, start, end, ...``."""
    if not len(before):
        return spans
    runs: list[tuple[int, int]] = []
    for a, b in sorted([*spans, *zip(before[::2].tolist(), before[1::2].tolist())]):
        if runs and a <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(b, runs[-1][1])
        else:
            runs.append((a, b))
    return runs


def _gathered(shared):
    """The hit runs of one more automaton, united with the earlier ones."""

    @F.pandas_udf("array<long>")
    def found(texts, earlier):
        import pandas as pd

        automaton, _ = shared.value
        rows = [_united(automaton.matches(words_of(t))[0], before) for t, before in zip(texts, earlier)]
        return pd.Series([[x for run in runs for x in run] for runs in rows], dtype=object)

    return found


SQL = r"""
WITH words_d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
words_b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM words_b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
starts AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words_d, sizes WHERE len(w) >= k)),
found AS (SELECT r, i, k, item_id FROM starts JOIN windows USING (k, s)),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words_d LEFT JOIN hits h USING (r) LEFT JOIN items t USING (r)"""


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
