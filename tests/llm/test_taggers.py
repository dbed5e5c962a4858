"""What the taggers add: broken spans in documents they haven't seen, in bounded time and memory."""

import time

import numpy as np
import pytest

from gridlark.llm import pii, secrets
from gridlark.llm.labelled import apart

WORDS = "the order of 12 came on page 7 with note and room 305 at 9:30 see http://x.org/a1 or v2.1 ok".split()


def lines(module, rng):
    digit = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    if module is pii:
        card = digit(15)
        card += next(d for d in "0123456789" if pii._luhn(card + d))
        return rng.choice([f"bob.{digit(2)}@mail.example.com", f"10.{rng.integers(256)}.{rng.integers(256)}.4", f"+1 (626) {digit(3)}-{digit(4)}", " ".join(card[i : i + 4] for i in range(0, 16, 4))])
    return rng.choice([f"password={hexes(18)}", f"api_key: '{hexes(24)}'", "AKIA" + hexes(16).upper(), hexes(40)])


def documents(module, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join([*rng.choice(WORDS, 12), str(lines(module, rng)), *rng.choice(WORDS, 12)]) for _ in range(n)]


@pytest.mark.parametrize("module,least", [(pii, 0.5), (secrets, 0.8)])
def test_broken_spans_are_found_in_unseen_documents(spark, module, least):
    seen = spark.createDataFrame(list(enumerate(documents(module, 500, 1))), "doc_id long, text string")
    tagger = module.train(seen)
    unseen = documents(module, 200, 2)
    found = total = wrong = 0
    for k, text in enumerate(unseen):
        base, everything = (x[0] for x in module.scan_texts([text], tagger))
        assert set(base) <= set(everything)
        wrong += len(everything) - len(base)
        form, spans = module.broken(text, base, np.random.default_rng(k))
        fits, added = (x[0] for x in module.scan_texts([form], tagger))
        for _, a, b in spans:
            if not any(s[1] < b and a < s[2] for s in fits):
                total += 1
                found += any(min(b, s[2]) - max(a, s[1]) > 0.5 * (b - a) for s in added)
    assert total > 100 and found / total >= least, (found, total)
    assert wrong <= 10


@pytest.mark.parametrize("module", [pii, secrets])
def test_clean_documents_stay_clean(spark, module):
    tagger = module.train(spark.createDataFrame(list(enumerate(documents(module, 300, 3))), "doc_id long, text string"))
    rng = np.random.default_rng(4)
    clean = [" ".join(rng.choice(WORDS, 60)) for _ in range(100)]
    assert sum(map(len, module.scan_texts(clean, tagger)[1])) <= 3


def test_very_long_texts(spark):
    small = [f"{'7 ' * 400} 10.2.33.4 x", "beef1234 " * 400 + " password=e3b3ed3cc8548923d6"]
    frame = spark.createDataFrame(list(enumerate(small * 5)), "doc_id long, text string")
    for module, text in ((pii, "7 " * 400_000), (secrets, "beef12 " * 60_000), (secrets, "0123456789abcdef " * 30_000), (secrets, "a" * 1_000_000 + "=1")):
        tagger = module.train(frame)
        start = time.time()
        module.scan_texts([text], tagger)
        assert time.time() - start < 60
    start = time.time()
    assert len(secrets.labelled([1], ["0123456789abcdef " * 20_000])["x"]) > 2000
    assert time.time() - start < 60


def test_stretches_are_whole_across_windows_and_pieces(spark, monkeypatch):
    rng = np.random.default_rng(0)
    texts = ["1 " * n + "x" * 300 + " 10.2.33.4 " + "@" * 90 for n in (1, 40, 200)]
    monkeypatch.setattr(pii, "LONGEST", 3)
    for text in texts:
        starts = pii.window_starts(text)
        parts = pii.pieces(starts)
        places = [p for part, lo, hi in parts for p in range(max(lo, part[0]), min(hi, part[-1] + pii.WINDOW))]
        assert len(places) == len(set(places)) and set(places) == {p for s in starts for p in range(s, s + pii.WINDOW)}
        assert all(len(part) <= 3 for part, _, _ in parts)
    tagger = pii.Tagger(hidden=4)
    windows = pii.cut(texts[1], pii.window_starts(texts[1])[:4])
    one = pii.reconciled(tagger, windows, [1, 1, 2])
    assert [len(t) for t in one] == [pii.WINDOW, pii.WINDOW, pii.WINDOW + pii.STRIDE]
    assert rng is not None


def test_spans_apart_by_one_sweep():
    rng = np.random.default_rng(7)
    for _ in range(50):
        spans = [("k", int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 24), rng.integers(1, 9, 24))]
        base, extra = spans[:10], spans[10:]
        assert apart(extra, base) == [s for s in extra if not any(s[1] < b and a < s[2] for _, a, b in base)]
        base.sort(key=lambda s: s[1:])
        run = [(i, i + 3) for i in range(0, 48, 3)]
        tags = secrets.truth(run, secrets.united(base))
        assert [bool(t) for t in tags] == [any(a < e and s < b for _, s, e in base) for a, b in run]


def test_every_token_is_tagged():
    """Also in texts without a digit or sign; tokens' shared parts give the scores of their features."""
    rng = np.random.default_rng(8)
    tagger = secrets.Tagger()
    tagger.p = {"weights": rng.normal(size=(secrets.WEIGHTS, 3)), "moves": rng.normal(size=(3, 3))}
    tagger.p["weights"][:, 0] -= 0.3
    words = [*WORDS, "Password", "hunter", "qWz", "naïve", "key=ab1", "x-9", "é\x1fé"]
    for text in (" ".join(rng.choice(WORDS, 40)), *(" ".join(rng.choice(words, n)) for n in (1, 15, 16, 17, 70))):
        runs = secrets.segments(text)
        assert [t for r in runs for t in r] == [m.span() for m in secrets._TOKEN.finditer(text)]
        found, of_tokens = [], [[text[a:b] for a, b in r] for r in runs]
        for i, run in enumerate(runs):
            before, after = of_tokens[i - 1][-1] if i else "", of_tokens[i + 1][0] if i + 1 < len(runs) else ""
            x = secrets.features(text, run, secrets.file_marks(text), before, after)
            found += secrets.model_spans(run, tagger.decode(tagger.emissions(x[None]))[0])
        base, everything = (x[0] for x in secrets.scan_texts([text], tagger))
        assert found and everything == base + secrets.apart(found, base)
