"""Personal data: patterns, and a character-level BiLSTM-CRF trained on their spans.

The patterns label a bounded sample of documents. On it a bidirectional LSTM over
character classes with CRF transitions is trained in numpy, also on broken forms of the
spans that no pattern fits. Documents are cut into overlapping windows; the scores of
neighbouring windows are averaged where they overlap, and one Viterbi path through the whole
stretch reconciles them. What the model finds beside the patterns' spans is added.

All kinds hold a digit or an ``@``. This is a hard constraint of the tags: a window without
such a character is outside by definition and isn't computed.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gridlark.llm.common import batches, fresh, read_table
from gridlark.llm.crf import Adam, gradients, viterbi
from gridlark.llm.labelled import apart, mixed, pick, span_text

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
STRIDE = 64
HIDDEN = 12
# The bounds of the training sample: documents, and windows, half of them with a span.
SAMPLE_DOCS = 6_000
SAMPLE_WINDOWS = 1_500
EPOCHS = 14
# Shorter pieces that the model finds are none of their kind.
SHORTEST = {"email": 6, "ip": 7, "card": 12, "phone": 9}
BATCH = 64
RATE = 0.02
SEED = 5

_TRIGGER = re.compile("[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        twice = 2 * int(d)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping addresses, found from their ``@``; linear in the text."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            free = domain.end()
        else:
            # The local part of the next address can't reach over this sign.
            free = at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The patterns' spans ``(kind, start, end)`` in code points."""
    if not text or not _TRIGGER.search(text):
        return []
    found = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


# Character classes: padding, beyond ASCII, letters, digits, blanks, and signs on their own.
_SIGNS = "@.-_%+():,/\"'="
CLASSES = 7 + len(_SIGNS) + 1
_CLASS = np.full(129, CLASSES - 1, np.int64)
_CLASS[128] = 1
for _c in range(128):
    _s = chr(_c)
    if _s.islower():
        _CLASS[_c] = 2
    elif _s.isupper():
        _CLASS[_c] = 3
    elif _s.isdigit():
        _CLASS[_c] = 4
    elif _s == " ":
        _CLASS[_c] = 5
    elif _s.isspace():
        _CLASS[_c] = 6
    elif _s in _SIGNS:
        _CLASS[_c] = 7 + _SIGNS.index(_s)


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 128)]


class Tagger:
    """Bidirectional LSTM with a CRF on top; tag 0 is outside, the others are the kinds."""

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN, tags: int = 1 + len(KINDS)) -> None:
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(hidden)
        self.p: dict[str, np.ndarray] = {"out": rng.normal(0, scale, (2 * hidden, tags)), "bias": np.zeros(tags), "moves": np.zeros((tags, tags))}
        for d in "lr":
            self.p[f"in_{d}"] = rng.normal(0, 0.5, (CLASSES, 4 * hidden))
            self.p[f"in_{d}"][:, hidden : 2 * hidden] += 1
            self.p[f"again_{d}"] = rng.normal(0, scale, (hidden, 4 * hidden))
        self.hidden = hidden

    def _pass(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states of one direction, and what the backward pass needs."""
        n, length = x.shape
        k = self.hidden
        inputs, again = self.p[f"in_{d}"], self.p[f"again_{d}"]
        h, c = np.zeros((n, k), inputs.dtype), np.zeros((n, k), inputs.dtype)
        out, saved = np.empty((n, length, k), inputs.dtype), []
        for t in range(length) if d == "l" else range(length - 1, -1, -1):
            z = inputs[x[:, t]] + h @ again
            gates = 1 / (1 + np.exp(-z[:, : 3 * k]))
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            g = np.tanh(z[:, 3 * k :])
            before, old = c, h
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[:, t] = h
            if keep:
                saved.append((t, i, f, o, g, before, squashed, old))
        return out, saved

    def _back(self, x: np.ndarray, d: str, by_out: np.ndarray, saved, by: dict[str, np.ndarray]) -> None:
        n, k = len(x), self.hidden
        again = self.p[f"again_{d}"]
        by_h, by_c = np.zeros((n, k)), np.zeros((n, k))
        for t, i, f, o, g, before, squashed, old in reversed(saved):
            by_h = by_h + by_out[:, t]
            by_c = by_c + by_h * o * (1 - squashed**2)
            by_z = np.concatenate([by_c * g * i * (1 - i), by_c * before * f * (1 - f), by_h * squashed * o * (1 - o), by_c * i * (1 - g**2)], axis=1)
            np.add.at(by[f"in_{d}"], x[:, t], by_z)
            by[f"again_{d}"] += old.T @ by_z
            by_h = by_z @ again.T
            by_c = by_c * f

    def emissions(self, x: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(x, d, False)[0] for d in "lr"], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def loss_gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        passes = {d: self._pass(x, d, True) for d in "lr"}
        both = np.concatenate([passes[d][0] for d in "lr"], axis=2)
        loss, by_emission, by_move = gradients(both @ self.p["out"] + self.p["bias"], self.p["moves"], tags)
        by = {k: np.zeros_like(v) for k, v in self.p.items()}
        by["moves"] = by_move
        by["bias"] = by_emission.sum(axis=(0, 1))
        by["out"] = np.einsum("ntk,ntj->kj", both, by_emission)
        by_both = by_emission @ self.p["out"].T
        for j, d in enumerate("lr"):
            self._back(x, d, by_both[:, :, j * self.hidden : (j + 1) * self.hidden], passes[d][1], by)
        return loss, by

    def fit(self, x: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS) -> "Tagger":
        rng, adam = np.random.default_rng(SEED), Adam(self.p, RATE)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                _, by = self.loss_gradients(x[order[i : i + BATCH]], tags[order[i : i + BATCH]])
                size = np.sqrt(sum((g**2).sum() for g in by.values()))
                adam.step({k: g * min(1.0, 5 / max(size, 1e-9)) for k, g in by.items()})
        return self


def window_starts(text: str) -> list[int]:
    """Starts of the windows, on a grid of ``STRIDE``, that hold a digit or an ``@``."""
    margin = (WINDOW - STRIDE) // 2
    found: set[int] = set()
    for m in _TRIGGER.finditer(text):
        at = m.start() + margin
        found.update(range(max(0, -(-(at - WINDOW + 1) // STRIDE)), at // STRIDE + 1))
    return [k * STRIDE - margin for k in sorted(found)]


def cut(text: str, starts: list[int]) -> np.ndarray:
    """Character classes of windows; places outside the text are padding."""
    out = np.zeros((len(starts), WINDOW), np.int64)
    for row, start in zip(out, starts):
        part = classes(text[max(0, start) : start + WINDOW])
        row[max(0, -start) : max(0, -start) + len(part)] = part
    return out


# Windows of one stretch that are decoded together; a longer stretch goes on in the next piece.
LONGEST = 32


def pieces(starts: list[int]) -> list[tuple[list[int], int, int]]:
    """Stretches of neighbouring windows, with the places that each decides.

    Pieces of a stretch share a window, in the middle of which the next one takes over.
    """
    out: list[tuple[list[int], int, int]] = []
    at = 0
    while at < len(starts):
        end = at + 1
        while end < len(starts) and starts[end] == starts[end - 1] + STRIDE:
            end += 1
        lo, first = starts[at], at
        while end - first > LONGEST:
            last = first + LONGEST - 1
            middle = starts[last] + WINDOW // 2
            out.append((starts[first : last + 1], lo, middle))
            first, lo = last, middle
        out.append((starts[first:end], lo, starts[end - 1] + WINDOW))
        at = end
    return out


# How much a window's word counts at each of its places: most in the middle.
_SAY = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])


def reconciled(tagger: Tagger, windows: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Tags of stretches, each of ``sizes`` neighbouring windows.

    Where windows overlap their scores are averaged, and one Viterbi path goes through the
    whole stretch, so a span that crosses windows is decided once.
    """
    scores = tagger.emissions(windows)
    # Places outside a text are outside all spans.
    scores[windows == 0] = 0.0
    scores[windows == 0, 1:] = -1e9
    out: list[np.ndarray | None] = [None] * len(sizes)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    for size in sorted(set(sizes)):
        own = [i for i, n in enumerate(sizes) if n == size]
        length = (size - 1) * STRIDE + WINDOW
        total, weight = np.zeros((len(own), length, scores.shape[2])), np.zeros(length)
        for k in range(size):
            here = slice(k * STRIDE, k * STRIDE + WINDOW)
            total[:, here] += scores[[firsts[i] + k for i in own]] * _SAY[:, None]
            weight[here] += _SAY
        for i, tags in zip(own, viterbi(total / weight[:, None], tagger.p["moves"])):
            out[i] = tags
    return out


def model_spans(text: str, stretches: list[tuple[list[int], int, int]], tags: list[np.ndarray]) -> list[tuple[str, int, int]]:
    """Spans of a document from the tags of its stretches; runs of one kind that touch are one span."""
    found: list[tuple[str, int, int]] = []
    for (starts, lo, hi), row in zip(stretches, tags):
        own = np.flatnonzero(row)
        for at, tag in zip((own + starts[0]).tolist(), row[own].tolist()):
            if not max(lo, 0) <= at < min(hi, len(text)):
                continue
            kind = KINDS[tag - 1]
            if found and found[-1][0] == kind and found[-1][2] == at:
                found[-1] = (kind, found[-1][1], at + 1)
            else:
                found.append((kind, at, at + 1))
    whole = []
    for kind, a, b in found:
        # Blanks at the ends belong to no span.
        part = text[a:b]
        a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
        if b - a >= SHORTEST[kind] and ("@" in text[a:b] if kind == "email" else any(c.isdigit() for c in text[a:b])):
            whole.append((kind, a, b))
    return whole


_BROKEN_AT = (" @ ", "@ ", " @", "@@")
_BROKEN_DOT = (",", "-", " . ", ":", ". ")
_BROKEN_GAP = (".", "/", "_", " - ")
_BROKEN_PLUS = ("00", "(0)", "", "tel ")


def broken(text: str, base: list[tuple[str, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its spans rewritten so that hardly a pattern fits, and where they are now.

    Addresses get blanks or a second sign, network numbers other separators, card numbers
    other gaps or a wrong digit, telephone numbers another beginning.
    """
    out, spans, done, size = [], [], 0, 0
    for kind, a, b in sorted(base, key=lambda s: s[1:]):
        if a < done:
            continue
        found = text[a:b]
        if kind == "email":
            found = found.replace("@", str(rng.choice(_BROKEN_AT)))
        elif kind == "ip":
            found = found.replace(".", str(rng.choice(_BROKEN_DOT)))
        elif kind == "card":
            digits = _NOT_DIGIT.sub("", found)
            if rng.random() < 0.5:
                found = found[:-1] + str((int(found[-1]) + 1 + int(rng.integers(0, 8))) % 10)
            else:
                found = str(rng.choice(_BROKEN_GAP)).join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            found = str(rng.choice(_BROKEN_PLUS)) + found[1:]
        out += [text[done:a], found]
        size += a - done
        spans.append((kind, size, size + len(found)))
        size += len(found)
        done = b
    return "".join([*out, text[done:]]), spans


def labelled(picks: list, texts: list[str | None]) -> dict[str, list]:
    """Classes and tags of all windows of documents and of their broken forms."""
    out: dict[str, list] = {k: [] for k in ("pick", "start", "broken", "marked", "x", "tags")}
    for key, text in zip(picks, texts):
        base = base_spans(text)
        forms = [(False, text, base)]
        if base:
            forms.append((True, *broken(text, base, np.random.default_rng(key & 0xFFFFFFFF))))
        for is_broken, form, spans in forms:
            starts = window_starts(form or "")
            if not starts:
                continue
            tags = np.zeros(len(form) + 2 * WINDOW, np.uint8)
            for kind, a, b in reversed(spans):
                tags[WINDOW + a : WINDOW + b] = 1 + KINDS.index(kind)
            for lo in range(0, len(starts), BLOCK):
                for start, row in zip(starts[lo : lo + BLOCK], cut(form, starts[lo : lo + BLOCK])):
                    own = tags[WINDOW + start :][:WINDOW]
                    for k, v in zip(out, (key, start, is_broken, bool(own.any()), row.astype(np.uint8).tobytes(), own.tobytes())):
                        out[k].append(v)
    return out


def train(docs: DataFrame, most_docs: int = SAMPLE_DOCS, most_windows: int = SAMPLE_WINDOWS) -> Tagger | None:
    """A tagger trained on a bounded sample, labelled by the patterns, as it is and broken.

    None without any window.
    """
    rows = mixed(batches(pick(docs, most_docs), labelled, "pick long, start long, broken boolean, marked boolean, x binary, tags binary"), most_windows)
    if not rows:
        return None
    x, tags = (np.array([np.frombuffer(r[k], np.uint8) for r in rows], np.int64) for k in ("x", "tags"))
    return Tagger().fit(x, tags)


# Windows that are decoded at once, whatever document they are of.
BLOCK = 2048


def scan_texts(texts: list[str | None], tagger: Tagger | None) -> tuple[list[list], list[list]]:
    """The patterns' spans, and all spans, of each text; memory is bounded by blocks of windows."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return base, [list(b) for b in base]
    found: list[tuple[list, list]] = [([], []) for _ in texts]
    waiting: list[tuple[int, tuple]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if waiting:
            windows = np.concatenate([cut(texts[i], piece[0]) for i, piece in waiting])
            for (i, piece), tags in zip(waiting, reconciled(tagger, windows, [len(p[0]) for _, p in waiting])):
                found[i][0].append(piece)
                found[i][1].append(tags.astype(np.uint8))
        waiting.clear()
        held = 0

    for i, text in enumerate(texts):
        for piece in pieces(window_starts(text)) if text else ():
            waiting.append((i, piece))
            held += len(piece[0])
            if held >= BLOCK:
                flush()
    flush()
    return base, [b + apart(model_spans(t or "", *f), b) for t, b, f in zip(texts, base, found)]


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every document.

    Null and empty texts have no spans. A model's span that overlaps a pattern's is left out.
    A very long text is decoded in blocks of windows.
    """
    shared = fresh(docs.sparkSession, tagger)

    def step(ids, texts, tagger):
        base, spans = scan_texts(texts, tagger)
        out = {"doc_id": ids}
        for k in KINDS:
            out[f"n_{k}"] = [sum(s[0] == k for s in b) for b in base]
        out["base_sha256"] = [hashlib.sha256(span_text(b, KINDS).encode()).hexdigest() for b in base]
        out["spans"] = [span_text(s, KINDS) for s in spans]
        return out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string"
    return batches(docs.select("doc_id", "text"), step, schema, shared)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return find(docs, train(docs))
