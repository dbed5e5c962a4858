"""Toxicity by compression distance: two zstandard dictionaries, window by window.

The ordinary dictionary is trained on windows of ordinary labelled text. The toxic one
holds the same content, and before it what is trained on toxic text: the words of toxic
documents that ordinary ones hardly have, near copies counting once. A window that
compresses better with the toxic dictionary is the more toxic the more bytes it saves. A
document's savings, the largest ones and their averages, are turned into a probability by a
logistic regression on labelled documents that no dictionary has seen.
"""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, read_table
from gridlark.llm.labelled import fold, logistic, sample

# The bounds of the labelled sample: rows per class, and windows of each row for training.
PER_CLASS = 2000
TRAINING_WINDOWS = 48
# Of every so many sampled rows, one calibrates and the others train dictionaries.
CALIBRATE_EVERY = 3
WINDOW = 48
STEP = 24
LEVEL = 7
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 2_048
# A word is toxic text if this share of toxic documents has it, and ordinary ones at most RATIO as often.
SHARE = 0.02
RATIO = 0.03
LEAST_DOCUMENTS = 3
# Savings of so many bytes count as a toxic window.
SAVING = 3
FEATURES = 7
# Words of the shingles whose least hash names a text among its near copies.
SHINGLE = 3
_MARKS = b".,;:!?#$%&*|()\"'-_"
THRESHOLD = 0.7
FOLDS = 3


def plain(text: str | None) -> bytes:
    """Lower-cased UTF-8 with single blanks around every word."""
    words = text.lower().encode().split() if text else []
    return b" " + b" ".join(words) + b" " if words else b""


def windows(data: bytes, width: int = WINDOW, step: int = STEP) -> list[bytes]:
    return [data[i : i + width] for i in range(0, max(1, len(data) - step), step)] if data else []


def _content(size: int, samples: list[bytes]) -> bytes:
    """The content of a trained dictionary; too few samples are content themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[300 - size :]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Distance:
    """Compressed lengths of windows with either dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        kind = zstandard.DICT_TYPE_RAWCONTENT
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        both = [zstandard.ZstdCompressionDict(part, dict_type=kind) for part in (ordinary, toxic + ordinary)]
        self._ordinary, self._toxic = (zstandard.ZstdCompressor(dict_data=d, **options).compress for d in both)

    def savings(self, data: bytes) -> list[int]:
        ordinary, toxic = self._ordinary, self._toxic
        return [len(ordinary(w)) - len(toxic(w)) for w in windows(data)]

    def features(self, text: str | None) -> tuple[float, ...]:
        """Largest saving, saving windows, and averages that chance savings leave near zero."""
        saved = np.array(self.savings(plain(text)) or [0])
        root = len(saved) ** 0.5
        hits, near = int((saved >= SAVING).sum()), int((saved >= SAVING - 1).sum())
        most = np.partition(saved, -4)[-4:].sum() if len(saved) > 4 else saved.sum()
        return float(saved.max()), float(np.log1p(hits)), hits / root, near / root, saved.sum() / root, saved.mean(), float(most)


_LOADED: dict[tuple[bytes, bytes], Distance] = {}


def _distance(model: dict) -> Distance:
    key = (model["ordinary"], model["toxic"])
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Distance(*key)
    return _LOADED[key]


def copy_name(text: str | None) -> int:
    """The least hash of a text's word shingles: near copies mostly share it."""
    words = plain(text).split()
    shingles = (b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))
    return min(map(xxhash.xxh64_intdigest, shingles)) >> 1


def _even(parts: list[bytes], most: int) -> list[bytes]:
    """At most ``most`` of the parts, evenly spread over all of them."""
    return parts if len(parts) <= most else [parts[i * len(parts) // most] for i in range(most)]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS) -> dict:
    """Dictionaries and calibration of a bounded sample outside the held-out fold.

    What comes to the driver is bounded by the sample's size: words that many toxic
    documents have, ``TRAINING_WINDOWS`` windows a document, three numbers a document.
    With one class only, every text gets that class's share.
    """
    rows, sizes = sample(docs, labels, "toxic", F.coalesce(fold(folds) != 1, F.lit(False)), per_class)
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    calibrates = F.pmod(F.col("pick"), F.lit(CALIBRATE_EVERY)) == 0
    learn, check = rows.where(~calibrates), rows.where(calibrates)
    counts = {int(r[0]): int(r[1]) for r in learn.groupBy("label").count().collect()}
    n_toxic, n_ordinary = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_ordinary:
        return {"prior": prior}

    # Near copies of a text count once: their words mark the text, not its kind.
    named = batches(learn.select("label", "text"), lambda marks, texts: {"label": marks, "copy": [copy_name(t) for t in texts], "text": texts}, "label int, copy long, text string")
    single = named.groupBy("label", "copy").agg(F.min("text").alias("text"))
    singles = {int(r[0]): int(r[1]) for r in single.groupBy("label").count().collect()}
    n_toxic, n_ordinary = singles[1], singles[0]

    def words(marks, texts):
        found = [(m, w) for m, t in zip(marks, texts) for w in {w.strip(_MARKS) for w in plain(t).split()}]
        return {"label": [m for m, _ in found], "word": [w for _, w in found]}

    seen = batches(single.select("label", "text"), words, "label int, word binary").where("length(word) > 3")
    table = seen.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary"))
    often = F.col("toxic") >= max(LEAST_DOCUMENTS, SHARE * n_toxic)
    rare = F.col("ordinary") / n_ordinary <= RATIO * F.col("toxic") / n_toxic
    marked = {bytes(r[0]) for r in table.where(often & rare).select("word").collect()}
    shared = fresh(docs.sparkSession, marked)

    def parts(picks, marks, texts, marked):
        out = {"pick": [], "label": [], "part": []}
        for pick, mark, text in zip(picks, marks, texts):
            data = plain(text)
            if mark:
                kept = [w.strip(_MARKS) for w in data.split() if w.strip(_MARKS) in marked]
                data = b" " + b" ".join(kept) + b" " if kept else b""
            for part in _even(windows(data, 64, 64), TRAINING_WINDOWS):
                for name, value in (("pick", pick), ("label", mark), ("part", part)):
                    out[name].append(value)
        return out

    found = batches(learn.select("pick", "label", "text"), parts, "pick long, label int, part binary", shared).orderBy("pick", "part").collect()
    samples = {k: [bytes(r[2]) for r in found if r[1] == k and len(r[2]) >= 16] for k in (0, 1)}
    if not samples[0] or not samples[1]:
        return {"prior": prior}
    model = {"prior": prior, "ordinary": _content(ORDINARY_BYTES, samples[0]), "toxic": _content(TOXIC_BYTES, samples[1])}
    return model | _calibrated(check, model, sizes)


def _calibrated(check: DataFrame, model: dict, sizes: dict[int, int]) -> dict:
    shared = fresh(check.sparkSession, model)

    def measure(picks, marks, texts, model):
        return {"pick": picks, "label": marks, "features": [list(_distance(model).features(t)) for t in texts]}

    found = batches(check.select("pick", "label", "text"), measure, "pick long, label int, features array<double>", shared).orderBy("pick").collect()
    y = np.array([r[1] for r in found], float)
    if len(set(y)) < 2:
        # Too few rows to calibrate: a saving window or two decide.
        return {"weights": np.array([0.5, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, -4.0])}
    x = np.array([r[2] for r in found])
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    # Classes weigh as they occur among the labels.
    share = {k: sizes[k] / (y == k).sum() for k in (0, 1)}
    weights = logistic((x - middle) / spread, y, np.where(y == 1, share[1], share[0]), ridge=0.5)
    slopes = weights[:-1] / spread
    return {"weights": np.append(slopes, weights[-1] - slopes @ middle)}


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    if "weights" not in model:
        return np.full(len(texts), model["prior"])
    x = np.array([_distance(model).features(t) for t in texts]).reshape(-1, FEATURES)
    return 1 / (1 + np.exp(-np.clip(x @ model["weights"][:-1] + model["weights"][-1], -30, 30)))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A text without words, null or empty, has no window and gets the score of no saving.
    Scores depend on the text alone. A null ``doc_id`` isn't held out.
    """
    shared = fresh(docs.sparkSession, model)

    def step(ids, held, texts, model):
        return {"doc_id": ids, "held_out": held, "score": score_texts(texts, model)}

    held = F.coalesce(fold(FOLDS) == 1, F.lit(False))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double"
    scored = batches(docs.select("doc_id", held.alias("held_out"), "text"), step, schema, shared)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
