"""Secrets: patterns, and a linear-chain CRF over tokens trained on their spans.

Tokens are tagged as secret begin, inside or outside. Features are the token's shape,
length and signs, its neighbours, and marks of the whole file; weights are trained by
maximum likelihood on a bounded sample that the patterns label, and tags are decoded by
Viterbi. What the model finds beside the patterns' spans is added.

No feature is a pattern. Every sampled document is also seen broken: keywords, separators,
prefixes and letter case are changed so that no pattern fits, while the labels stay, so
that shape and neighbours have to carry the tags.

Every token of a text is tagged. A token's score is a sum over its own features, its
neighbours' and the file's, so the parts of equal tokens are taken once a batch.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm.common import batches, fresh, read_table
from gridlark.llm.crf import Adam, gradients, viterbi
from gridlark.llm.labelled import apart, mixed, pick, span_text

KINDS = ("assign", "access", "hex")
MODEL_KIND = "secret"
OUTSIDE, BEGIN, INSIDE = range(3)
# The bounds of the training sample: documents, and segments, half of them with a secret.
SAMPLE_DOCS = 6_000
SAMPLE_SEGMENTS = 3_000
SEGMENT = 16
WEIGHTS = 1 << 12
EPOCHS = 25
BATCH = 128
RATE = 0.05
RIDGE = 1e-4
SEED = 11
# A secret's tags have to beat others by so much, which spares clean texts.
CAUTION = 1.5
MASK = "[secret]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# Runs of fewer than 16 can't pass, and a longer run matches as a whole.
_HEX = re.compile("[0-9a-f]{16,}")
_MARK = re.compile("[0-9=_:/+]")
_TOKEN = re.compile(r"\S+")
_KEYWORD = re.compile("password|passwd|secret|token|api_?key|akia|key|auth|credential", re.ASCII | re.IGNORECASE)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The patterns' spans ``(kind, start, end)`` in code points."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def segments(text: str | None) -> list[list[tuple[int, int]]]:
    """All tokens ``(start, end)`` in runs of at most ``SEGMENT``."""
    spans = [m.span() for m in _TOKEN.finditer(text or "")]
    cuts = _cuts([not _MARK.search(text, a, b) for a, b in spans])
    return [spans[a:b] for a, b in zip(cuts, cuts[1:])]


def _cuts(plain: list[bool]) -> list[int]:
    """Where runs begin, and the end: in a run's second half between two plain tokens, if there are such, so that secrets stay whole."""
    out = [0]
    while len(plain) - (at := out[-1]) > SEGMENT:
        out.append(at + next((k for k in range(SEGMENT, SEGMENT // 2, -1) if plain[at + k - 1] and plain[at + k]), SEGMENT))
    return [*out, len(plain)] if plain else out


_KINDS = ((re.compile("[a-z]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile("[0-9]+"), "0"), (re.compile("[^\\x00-\\x7F]+"), "u"))
_REPEATED = re.compile(r"(.)\1+", re.DOTALL)
_DIGIT = re.compile("[0-9]")
_UPPER = re.compile("[A-Z]")
_SIGN = re.compile("[^A-Za-z0-9]")


def _shape(token: str) -> str:
    """The whole token's pattern of character kinds, without lengths."""
    for run, letter in _KINDS:
        token = run.sub(letter, token)
    return _REPEATED.sub(r"\1", token)


def _own(token: str, key: str) -> list[str]:
    size, shape = max(1, len(token)), _shape(token)
    share = {n: 8 * len(p.findall(token)) // size for n, p in (("digits", _DIGIT), ("upper", _UPPER), ("signs", _SIGN))}
    longest = max(map(len, _SIGN.split(token)))
    return [
        f"shape={shape}", f"size={min(len(token).bit_length(), 8)}", f"digits={share['digits']}", f"upper={share['upper']},{share['signs']}",
        f"key={key}", f"switches={min(len(shape), 24) // 2},{min(longest, 40) // 4}",
        f"value={'=' in token or ':' in token}{longest >= 12}", f"run={min(longest, 32) // 2}",
    ]


def file_marks(text: str) -> list[str]:
    """Marks of the whole file: its size, and how many tokens are marked."""
    marks = len(_MARK.findall(text))
    return [f"file_size={len(text).bit_length()}", f"file_marks={min(marks.bit_length(), 10)}"]


FEATURES = 8 + 2 * 3 + 2 + 1


def _hashed(names: list[str]) -> list[int]:
    return [1 + zlib.crc32(n.encode()) % (WEIGHTS - 1) for n in names]


# A token with its letters and digits by kind, its keyword and its last character: its features follow from these.
_BY_KIND = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}})


def signature(token: str) -> tuple[str, str, str]:
    key = _KEYWORD.search(token)
    return token.translate(_BY_KIND), key[0].lower() if key else "", token[-1:]


def places(token: tuple[str, str, str]) -> tuple[list[int], list[int], list[int]]:
    """Hashed places of a signature's features: its own, as the token to the left, as the one to the right."""
    kinds, key, end = token
    sides = ([f"{side}size={min(len(kinds).bit_length(), 6)}", f"{side}key={key}", f"{side}end={end}"] for side in "lr")
    return _hashed(_own(kinds, key)), *map(_hashed, sides)


_cached_places = lru_cache(maxsize=1 << 14)(places)


def file_places(marks: list[str]) -> list[int]:
    return _hashed([*marks, "bias"])


def features(text: str, run: list[tuple[int, int]], marks: list[str], before: str = "", after: str = "") -> np.ndarray:
    """Hashed places of each token's features; place 0 is padding. ``before`` and ``after`` are the run's neighbours."""
    tokens = [_cached_places(signature(t)) for t in (before, *(text[a:b] for a, b in run), after)]
    out = np.zeros((SEGMENT, FEATURES), np.int64)
    of_file = file_places(marks)
    for i in range(len(run)):
        out[i] = [*tokens[i + 1][0], *tokens[i][1], *tokens[i + 2][2], *of_file]
    return out


class Tagger:
    def __init__(self) -> None:
        self.p = {"weights": np.zeros((WEIGHTS, 3)), "moves": np.zeros((3, 3))}

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.p["weights"][x].sum(axis=2)

    def fit(self, x: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS) -> "Tagger":
        rng, adam = np.random.default_rng(SEED), Adam(self.p, RATE)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                part = order[i : i + BATCH]
                _, by_emission, by_move = gradients(self.emissions(x[part]), self.p["moves"], tags[part])
                by = RIDGE * self.p["weights"]
                np.add.at(by, x[part], np.broadcast_to(by_emission[:, :, None, :], (*x[part].shape, 3)))
                adam.step({"weights": by, "moves": by_move + RIDGE * self.p["moves"]})
        return self

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Tags by Viterbi from emissions; inside never follows outside, nor starts a segment."""
        moves = self.p["moves"].copy()
        moves[OUTSIDE, INSIDE] = -1e9
        scores = scores.copy()
        scores[:, :, OUTSIDE] += CAUTION
        scores[:, 0, INSIDE] = -1e9
        return viterbi(scores, moves)


def truth(run: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> np.ndarray:
    """Tags of a segment's tokens by spans in order of their starts; overlapping ones are one."""
    tags = np.zeros(SEGMENT, np.int64)
    at = bisect_left(base, run[0][0], key=lambda s: s[2])
    for i, (a, b) in enumerate(run):
        while at < len(base) and base[at][2] <= a:
            at += 1
        if at < len(base) and base[at][1] < b:
            tags[i] = BEGIN if i == 0 or not tags[i - 1] or base[at][1] >= a else INSIDE
    return tags


def united(base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in order of their starts, overlapping ones joined."""
    out: list[tuple[str, int, int]] = []
    for kind, a, b in sorted(base, key=lambda s: s[1:]):
        if out and a < out[-1][2]:
            out[-1] = out[-1][0], out[-1][1], max(b, out[-1][2])
        else:
            out.append((kind, a, b))
    return out


# What stands between a name and its value when a pattern is broken.
_BETWEEN = (" is ", " -> ", " => ", " == ", " ", "/", "|", "='", " := ")
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def broken(text: str, base: list[tuple[str, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its spans rewritten so that no pattern fits, and where the secrets are now.

    A named value gets another name and separator, an access key another prefix, and a run
    of hexadecimal digits capitals or dashes.
    """
    out, spans, done = [], [], 0
    size = 0

    def put(part: str) -> None:
        nonlocal size
        out.append(part)
        size += len(part)

    for kind, a, b in united(base):
        put(text[done:a])
        secret = text[a:b]
        named = _ASSIGN.match(secret)
        if kind == "assign" and named:
            put("".join(rng.choice(list(_LOWER), rng.integers(3, 9))) + str(rng.choice(_BETWEEN)))
            secret = named[2]
        elif kind == "access":
            secret = "".join(rng.choice(list(_LOWER.upper()), 4)) + secret[4:]
        if _HEX.search(secret):
            # Letters change case half of the time; all-digit runs get dashes.
            flips = rng.random(len(secret)) < 0.5
            secret = "".join(c.upper() if f else c for c, f in zip(secret, flips))
            if _HEX.search(secret):
                secret = "-".join(secret[i : i + 8] for i in range(0, len(secret), 8))
        spans.append((MODEL_KIND, size, size + len(secret)))
        put(secret)
        done = b
    put(text[done:])
    return "".join(out), spans


def train(docs: DataFrame, most_docs: int = SAMPLE_DOCS, most_segments: int = SAMPLE_SEGMENTS) -> Tagger | None:
    """A tagger trained on a bounded sample, labelled by the patterns, as it is and broken.

    None without any segment.
    """
    rows = mixed(batches(pick(docs, most_docs), labelled, "pick long, start long, broken boolean, marked boolean, x binary, tags binary"), most_segments)
    if not rows:
        return None
    x = np.array([np.frombuffer(r["x"], "<u2") for r in rows], np.int64).reshape(-1, SEGMENT, FEATURES)
    return Tagger().fit(x, np.array([np.frombuffer(r["tags"], np.uint8) for r in rows], np.int64))


def labelled(picks: list, texts: list[str | None]) -> dict[str, list]:
    """Features and tags of all segments of documents and of their broken forms."""
    out: dict[str, list] = {k: [] for k in ("pick", "start", "broken", "marked", "x", "tags")}
    for key, text in zip(picks, texts):
        base = base_spans(text)
        forms = [(False, text, united(base))]
        if base:
            forms.append((True, *broken(text, base, np.random.default_rng(key & 0xFFFFFFFF))))
        for is_broken, form, spans in forms:
            runs = segments(form)
            marks = file_marks(form) if runs else []
            for i, run in enumerate(runs):
                tags = truth(run, spans)
                before = form[slice(*runs[i - 1][-1])] if i else ""
                after = form[slice(*runs[i + 1][0])] if i + 1 < len(runs) else ""
                for k, v in zip(out, (key, run[0][0], is_broken, bool(tags.any()), features(form, run, marks, before, after).astype("<u2").tobytes(), tags.astype(np.uint8).tobytes())):
                    out[k].append(v)
    return out


def model_spans(run: list[tuple[int, int]], tags: np.ndarray) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    for (a, b), tag in zip(run, tags.tolist()):
        if tag == BEGIN:
            out.append((MODEL_KIND, a, b))
        elif tag == INSIDE and out:
            out[-1] = (MODEL_KIND, out[-1][1], b)
    return out


class _Scores:
    """Emissions of runs of tokens, from parts that tokens of one signature share."""

    def __init__(self, tagger: Tagger) -> None:
        self.weights = tagger.p["weights"]
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.signatures: dict[tuple[str, str, str], int] = {}
        # By signature: emissions of its own features, as the token to the left, as the one to the right; whether it has no mark.
        self.parts = np.zeros((1 << 12, 3, 3))
        self.plain = np.zeros(1 << 12, dtype=bool)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """The place of each token's signature."""
        if len(self.at) > 1 << 17:
            self.at.clear()
        at, known = self.at, self.signatures
        for token in dict.fromkeys(tokens):
            if token not in at:
                found = signature(token)
                if found not in known:
                    self._learn(found)
                at[token] = known[found]
        return np.fromiter(map(at.__getitem__, tokens), np.int64, len(tokens))

    def _learn(self, found: tuple[str, str, str]) -> None:
        k = self.signatures[found] = len(self.signatures)
        if k == len(self.parts):
            self.parts, self.plain = (np.concatenate([x, np.zeros_like(x)]) for x in (self.parts, self.plain))
        for side, at in enumerate(places(found)):
            self.parts[k, side] = self.weights[at].sum(axis=0)
        self.plain[k] = not _MARK.search(found[0])

    def of_file(self, text: str) -> np.ndarray:
        return self.weights[file_places(file_marks(text))].sum(axis=0)

    def emissions(self, ids: np.ndarray, sizes: np.ndarray, of_files: np.ndarray) -> np.ndarray:
        """Of runs as rows of signatures, with the tokens before and after; as ``Tagger.emissions`` of their features."""
        out = self.parts[ids[:, 1:-1], 0] + self.parts[ids[:, :-2], 1] + self.parts[ids[:, 2:], 2] + of_files[:, None, :]
        out[np.arange(SEGMENT) >= sizes[:, None]] = FEATURES * self.weights[0]
        return out


def scan_texts(texts: list[str | None], tagger: Tagger | None) -> tuple[list[list], list[list]]:
    """The patterns' spans, and all spans, of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return base, [list(b) for b in base]
    spans: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    scores = _Scores(tagger)
    # Of each run: its text, its first token, its size, its row of signatures and its file's emissions.
    waiting: list[tuple[np.ndarray, ...]] = []

    def flush() -> None:
        if not waiting:
            return
        text, start, size, ids, of_files = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        tags = tagger.decode(scores.emissions(ids, size, of_files))
        last, places_in = -1, []
        for k in np.flatnonzero((tags != OUTSIDE).any(axis=1)).tolist():
            if text[k] != last:
                last = int(text[k])
                places_in = [m.span() for m in _TOKEN.finditer(texts[last])]
            spans[last] += model_spans(places_in[start[k] : start[k] + size[k]], tags[k])
        if len(scores.signatures) > 1 << 17:
            scores.clear()

    held = 0
    for i, text in enumerate(texts):
        tokens = text.split() if text else []
        if not tokens:
            continue
        ids = scores.numbers(["", *tokens, ""])
        cuts = np.array(_cuts(scores.plain[ids[1:-1]].tolist()))
        of_file = scores.of_file(text)
        for lo in range(0, len(cuts) - 1, 4096):
            start, size = cuts[lo : lo + 4097][:-1], np.diff(cuts[lo : lo + 4097])
            rows = ids[np.minimum(start[:, None] + np.arange(SEGMENT + 2), len(ids) - 1)]
            waiting.append((np.full(len(start), i), start, size, rows, np.broadcast_to(of_file, (len(start), 3))))
            held += len(start)
        # A text's signatures stay until its runs are tagged.
        if held >= 4096:
            flush()
            held = 0
    flush()
    return base, [b + apart(s, b) for b, s in zip(base, spans)]


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans, of every document.

    Null and empty texts have no spans. A model's span that overlaps a pattern's is left out.
    Every token is tagged, in runs.
    """
    shared = fresh(docs.sparkSession, tagger)

    def step(ids, texts, tagger):
        base, spans = scan_texts(texts, tagger)
        out = {"doc_id": ids}
        for k in KINDS:
            out[f"n_{k}"] = [sum(s[0] == k for s in b) for b in base]
        out["base_sha256"] = [hashlib.sha256(span_text(b, KINDS).encode()).hexdigest() for b in base]
        out["spans"] = [span_text(s, (*KINDS, MODEL_KIND)) for s in spans]
        return out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string"
    return batches(docs.select("doc_id", "text"), step, schema, shared)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each run of overlapping spans replaced by one mask."""
    out, done = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], MASK]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with secrets replaced by a mask; all rows, columns and clean texts stay.

    ``n_chars``, if there, follows a changed text.
    """
    shared = fresh(docs.sparkSession, tagger)

    @F.pandas_udf("string")
    def redacted(texts):
        import pandas as pd

        values = texts.tolist()
        _, spans = scan_texts(values, shared.value)
        return pd.Series([masked(t, s) if s else t for t, s in zip(values, spans)], dtype=object)

    out = docs.select("*", F.struct(redacted("text").alias("t")).alias("_gridlark_redacted"))
    new = {"text": F.col("_gridlark_redacted.t")}
    if "n_chars" in docs.columns:
        same = F.col("_gridlark_redacted.t").eqNullSafe(F.col("text"))
        new["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length("_gridlark_redacted.t")).cast(dict(docs.dtypes)["n_chars"])
    return out.withColumns(new).select(*docs.columns)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return find(docs, train(docs))
