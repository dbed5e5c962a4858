"""URL filters: host and path rules, and logistic regression where no rule fits.

The regression sees hashed character n-grams of host and path, told apart by a mark of
their own, with the host's end and the path's start marked. It is trained from a small
table of labelled URLs; the weights are one vector of fixed size that every task gets.
Features and scores of a batch are computed in blocks of characters, so that a very long
URL takes no more memory at a time than a short one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, read_table
from gridlark.sources.shared import materialize

# Places that n-grams are hashed to, and the lengths of n-grams.
PLACES = 1 << 14
GRAMS = (2, 3, 4, 5)
# The bound of the labelled table: URLs of each verdict.
PER_VERDICT = 1500
RIDGE = 1.0
STEPS = 400
# Bytes of URLs that are cut into n-grams at once.
BLOCK = 1 << 20

# Fixed values: (verdict, host, path start).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty for null and without ``://``."""
    start = F.instr(url, "://")
    # Plain string functions: no pattern runs over a very long URL more than once.
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "#", 1), "?", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits a host and its path; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(text: bytes, mark: int) -> np.ndarray:
    """Places of all n-grams of a marked text, repeats included."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    found = []
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, np.uint64(mark * 16 + n))
        for k in range(n):
            code = code * np.uint64(0x100000001B3) ^ data[k : len(data) - n + 1 + k]
        code *= np.uint64(0x9E3779B97F4A7C15)
        found.append((code >> np.uint64(40)).astype(np.int64) % PLACES)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _texts(host: str | None, path: str | None) -> tuple[bytes, bytes]:
    """Host and path with their outer ends marked."""
    return b"^." + (host or "").encode() + b"$", b"^" + (path or "").encode() + b"$"


def _pieces(text: bytes):
    """A text in blocks, each with the end of the block before; the length of that end is given too."""
    longest = max(GRAMS) - 1
    for at in range(0, len(text), BLOCK):
        yield text[max(0, at - longest) : at + BLOCK], min(at, longest)


def counts(host: str | None, path: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a URL's n-grams: counts are damped, and the vector has length one."""
    texts = _texts(host, path)
    if sum(map(len, texts)) <= BLOCK:
        places, total = np.unique(np.concatenate([_grams(text, mark) for mark, text in enumerate(texts)]), return_counts=True)
    else:
        dense = np.zeros(PLACES, np.int64)
        for mark, text in enumerate(texts):
            for piece, shared in _pieces(text):
                dense += np.bincount(_grams(piece, mark), minlength=PLACES)
                # What lies wholly in the overlap was counted with the block before.
                dense -= np.bincount(_grams(piece[:shared], mark), minlength=PLACES)
        places = np.flatnonzero(dense)
        total = dense[places]
    values = np.log1p(total.astype(np.float64))
    return places, values / max(np.sqrt((values * values).sum()), 1e-12)


def fit(urls: Sequence[tuple[str, str]], blocked: Sequence[bool], ridge: float = RIDGE) -> np.ndarray:
    """Weights of the n-grams and, last, the intercept; both verdicts weigh alike.

    Accelerated gradient steps on the ridge logistic loss, from a bounded table. Without
    URLs of both kinds the weights are zero.
    """
    y = np.array(blocked, dtype=np.float64)
    weights = np.zeros(PLACES + 1)
    if not len(y) or y.min() == y.max():
        return weights
    rows = [counts(h, p) for h, p in urls]
    at = np.concatenate([p for p, _ in rows])
    value = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # Rows have length one and an intercept, so a quarter of two bounds the curvature.
    rate = 1 / (0.5 + ridge / len(y))
    ahead, before = weights.copy(), weights
    for step in range(STEPS):
        z = np.bincount(row, value * ahead[at], minlength=len(y)) + ahead[-1]
        pull = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gradient = np.append(np.bincount(at, value * pull[row], minlength=PLACES), pull.sum())
        gradient[:-1] += ridge / len(y) * ahead[:-1]
        weights = ahead - rate * gradient
        ahead = weights + step / (step + 3) * (weights - before)
        before = weights
    return weights


def score(hosts: Sequence[str | None], paths: Sequence[str | None], weights: np.ndarray) -> list[float]:
    """The chance of a block, 0 to 1."""
    out = []
    for host, path in zip(hosts, paths):
        places, values = counts(host, path)
        z = float(values @ weights[places] + weights[-1])
        out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
    return out


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; the last two null where no rule fits."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return split.withColumns({"rule": rule, "verdict": verdict})


def labelled(judged: DataFrame, per_verdict: int = PER_VERDICT) -> DataFrame:
    """A table ``host, path, blocked`` of at most ``per_verdict`` different URLs of each verdict.

    They are drawn by a hash of host and path among the pages that a rule decides, so that
    the regression carries the rules over to what no rule names.
    """
    known = judged.where(F.col("verdict").isNotNull()).select("host", "path", (F.col("verdict") == "block").alias("blocked"))
    # A third of all pages may have one URL: it is merged before anything moves.
    known = materialize(known.distinct())
    order = [F.xxhash64("host", "path"), "host", "path"]
    return known.where("blocked").orderBy(*order).limit(per_verdict).union(known.where("NOT blocked").orderBy(*order).limit(per_verdict))


def train(urls: DataFrame, ridge: float = RIDGE) -> np.ndarray:
    """Weights from a small table ``host, path, blocked``, which is read back whole.

    The caller bounds the table. Rows without a label take no part.
    """
    rows = urls.where("blocked IS NOT NULL").select("host", "path", "blocked").collect()
    rows = sorted(rows, key=lambda r: (r[0] or "", r[1] or "", r[2]))
    return fit([(r[0], r[1]) for r in rows], [r[2] for r in rows], ridge)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, urls: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, chance`` of every page.

    ``urls`` is the labelled table (``host, path, blocked``); by default it is drawn from
    the pages that a rule decides. Where a rule fits, its verdict holds; elsewhere a URL
    whose ``chance`` exceeds a half is blocked. Null URLs and those without ``://`` have
    an empty host and path, fit no rule and are judged by the regression like any other;
    repeated rows are judged one by one; equal URLs get equal verdicts. Without labelled
    URLs of both kinds the chance is a half and all that no rule decides is allowed. No
    rows give no rows; other columns are left out.
    """
    judged = ruled(pages, rules)
    shared = fresh(pages.sparkSession, train(labelled(judged) if urls is None else urls))

    def step(ids, hosts, paths, names, verdicts, weights):
        # Pages of one host often share a URL; each is scored once a batch.
        open_rows = dict.fromkeys((h, p) for h, p, v in zip(hosts, paths, verdicts) if v is None)
        chances = dict(zip(open_rows, score([h for h, _ in open_rows], [p for _, p in open_rows], weights)))
        chance = [None if v is not None else chances[h, p] for h, p, v in zip(hosts, paths, verdicts)]
        final = [v if v is not None else "block" if c > 0.5 else "allow" for v, c in zip(verdicts, chance)]
        return {"page_id": ids, "host": hosts, "path": paths, "rule": pa.array(names, pa.string()), "verdict": final, "chance": pa.array(chance, pa.float64())}

    schema = f"page_id {dict(pages.dtypes)['page_id']}, host string, path string, rule string, verdict string, chance double"
    return batches(judged, step, schema, shared)


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages")).drop("chance")
