"""Quality by nearest-neighbour voting in a latent-semantic space.

Documents are weighted term vectors over hashed words and surface marks (case, trailing
signs, repetition, variety). A bounded labelled sample gives the weights, a truncated
singular value decomposition and the labelled latent vectors; these are broadcast. Every
document is projected and compared with all labelled vectors in exact blocked cosine
products; its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, read_table
from gridlark.llm.labelled import fold, sample

# The bound of the labelled sample, per class.
PER_CLASS = 1500
WORDS = 1536
MARKS = 256
LATENT = 48
NEIGHBOURS = 31
# Similarities are raised to this power before they vote.
SHARPNESS = 8
BLOCK = 512
THRESHOLD = 0.3
FOLDS = 5
# The words' share in a vector beside its surface marks.
WORD_WEIGHT = 0.5


def _case(token: str) -> int:
    """Lower, title, upper or mixed case, or no letters."""
    if token.islower():
        return 0
    if token.istitle():
        return 1
    if token.isupper():
        return 2
    return 3 if any(c.isalpha() for c in token) else 4


def _token_terms(token: str) -> tuple[int, int]:
    """The word's and the surface mark's places."""
    signs = "".join({c for c in token if not c.isalnum()})
    word, tail = token.strip(signs), token[len(token.rstrip(signs)) :]
    kind = 0 if not tail else 1 if tail in ".,;:?!" else 2 + zlib.crc32(tail.encode()) % 30
    return zlib.crc32(word.lower().encode()) % WORDS, WORDS + (_case(token) * 32 + kind) % 160


class Terms:
    """Texts to counts of terms; the places of words seen before are kept, up to a bound."""

    def __init__(self, bound: int = 200_000) -> None:
        self.places: dict[str, tuple[int, int]] = {}
        self.bound = bound

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        """One dense row of term counts per text; words and marks are told apart by place."""
        out = np.zeros((len(texts), WORDS + MARKS), np.float32)
        if len(self.places) > self.bound:
            self.places.clear()
        places = self.places
        for row, text in zip(out, texts):
            tokens = text.split() if text else []
            if not tokens:
                continue
            for token, n in Counter(tokens).items():
                at = places.get(token)
                if at is None:
                    at = places[token] = _token_terms(token)
                row[at[0]] += n
                row[at[1]] += n
            same = sum(a == b for a, b in pairwise(tokens))
            row[WORDS + 160] = same
            # How varied the words are, among documents of about one length.
            size, variety = min(len(tokens).bit_length(), 15), len(set(tokens)) / len(tokens)
            row[WORDS + 161 + min(9, int(variety * 10))] = len(tokens) / 4
            row[WORDS + 176 + size] = 1
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, words and marks each of length one (or zero)."""
    out = np.empty_like(counts)
    words, marks = out[:, :WORDS], out[:, WORDS:]
    np.log1p(counts[:, :WORDS], out=words)
    # Marks are shares of the document's tokens.
    np.sqrt(counts[:, WORDS:], out=marks)
    out *= idf
    words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9) / WORD_WEIGHT
    marks /= np.maximum(np.linalg.norm(marks, axis=1, keepdims=True), 1e-9)
    return out


def fit(counts: np.ndarray, labels: np.ndarray) -> dict:
    """Weights, latent axes and labelled latent vectors of a sample of term counts."""
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    blocks = range(0, len(counts), BLOCK)
    gram = np.zeros((counts.shape[1], counts.shape[1]), np.float32)
    for i in blocks:
        x = weighted(counts[i : i + BLOCK], idf)
        gram += x.T @ x
    # Axes by the eigenvectors of the small Gram matrix of terms.
    axes = np.linalg.eigh(gram)[1][:, ::-1]
    del gram
    axes = np.ascontiguousarray(axes[:, :LATENT], dtype=np.float32)
    vectors = [_unit(weighted(counts[i : i + BLOCK], idf) @ axes) for i in blocks]
    return {"idf": idf, "axes": axes, "vectors": np.concatenate(vectors) if vectors else np.zeros((0, LATENT), np.float32), "labels": labels.astype(np.float32), "prior": float(labels.mean()) if len(labels) else 0.5}


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def score_counts(counts: np.ndarray, model: dict) -> np.ndarray:
    """Weighted share of label 1 among the nearest labelled vectors, 0 to 1."""
    latent = _unit(weighted(counts, model["idf"]) @ model["axes"])
    cosines = np.maximum(latent @ model["vectors"].T, 0)
    k = min(NEIGHBOURS, cosines.shape[1])
    near = np.argpartition(cosines, -k, axis=1)[:, -k:]
    votes = np.take_along_axis(cosines, near, axis=1) ** SHARPNESS
    total = votes.sum(axis=1)
    vote = (votes * model["labels"][near]).sum(axis=1)
    # A text without terms is like none: it gets the prior.
    return np.where(total > 1e-12, vote / np.maximum(total, 1e-12), model["prior"]).clip(0, 1).astype(np.float64)


_TERMS = Terms()


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    if not len(model["labels"]):
        return np.full(len(texts), model["prior"])
    parts = [score_counts(_TERMS.matrix(texts[i : i + BLOCK]), model) for i in range(0, len(texts), BLOCK)]
    return np.concatenate(parts) if parts else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS) -> dict:
    """The model of a sample of labelled rows outside the held-out fold.

    At most ``2 * per_class`` vectors of fixed size come to the driver. Without labelled
    rows the model scores every text 0.5.
    """
    rows, _ = sample(docs, labels, "quality", fold(folds) != 0, per_class)

    def vectors(ids, marks, texts):
        out = {"pick": ids, "label": marks, "places": [], "counts": []}
        for i in range(0, len(texts), BLOCK):
            for row in Terms().matrix(texts[i : i + BLOCK]):
                places = np.flatnonzero(row)
                out["places"].append(places.astype("<u2").tobytes())
                out["counts"].append(row[places].astype("<f4").tobytes())
        return out

    # Most places of a document are empty, so the driver gets a tenth of the whole vectors.
    found = batches(rows.select("pick", "label", "text"), vectors, "pick long, label int, places binary, counts binary")
    found = found.orderBy("pick").collect()
    counts = np.zeros((len(found), WORDS + MARKS), np.float32)
    for row, r in zip(counts, found):
        row[np.frombuffer(r[2], "<u2")] = np.frombuffer(r[3], "<f4")
    labels = np.array([r[1] for r in found], np.float32)
    del found
    return fit(counts, labels)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Texts without words, null or empty, get the sample's share of label 1. Scores depend
    on the text alone, so repeated texts score alike. A null ``doc_id`` isn't held out.
    """
    shared = fresh(docs.sparkSession, model)

    def step(ids, held, texts, model):
        return {"doc_id": ids, "held_out": held, "score": score_texts(texts, model)}

    held = F.coalesce(fold(FOLDS) == 0, F.lit(False))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double"
    scored = batches(docs.select("doc_id", held.alias("held_out"), "text"), step, schema, shared)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of ``threshold`` or more; all columns stay."""
    shared = fresh(docs.sparkSession, model)

    @F.pandas_udf("double")
    def quality(texts):
        import pandas as pd

        return pd.Series(score_texts(texts.tolist(), shared.value))

    return docs.where(quality("text") >= threshold)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
