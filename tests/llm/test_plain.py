"""Components, features, axes and scores against plain forms of the same rules."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard

from gridlark.llm import quality, simhash, toxicity
from gridlark.llm.queries import QUERIES

WORDS = "alpha beta gamma delta épsilon Zeta eta theta iota Kappa".split()


def made(seed, n):
    """Texts, near copies of them with a word changed, and odd ones."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(rng.choice([1, 2, 6, 60, 300]))) for _ in range(n)]
    for text in texts[: n // 2]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return [*texts, texts[0], texts[3], None, "", " \n", None]


def plain_fingerprint(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_all_pairs(spark, tmp_path, seed):
    texts = made(seed, 60)
    ids = random.Random(seed).sample(range(1000), len(texts))
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    prints = [plain_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    lowest = {}
    for i, doc_id in enumerate(ids):
        lowest[root(i)] = min(doc_id, lowest.get(root(i), doc_id))
    wanted = Counter((d, f"{p:016x}", lowest[root(i)]) for i, (d, p) in enumerate(zip(ids, prints)))
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, str(tmp_path)).collect())
    assert got == wanted and 1 < len(set(lowest.values())) < len(texts)


def test_term_counts():
    texts = [t for t in made(3, 40) if t] + ["Well, well, WELL!! 12 a-b", "x " * 50]
    counts = quality.Terms().matrix(texts)
    for text, row in zip(texts, counts):
        tokens = text.split()
        words, marks = np.zeros(quality.WORDS), np.zeros(160)
        for token in tokens:
            word, mark = quality._token_terms(token)
            words[word] += 1
            marks[mark - quality.WORDS] += 1
        np.testing.assert_allclose(row[: quality.WORDS], words)
        np.testing.assert_allclose(row[quality.WORDS : quality.WORDS + 160], marks)
        assert row[quality.WORDS + 160] == sum(a == b for a, b in zip(tokens, tokens[1:]))


def test_axes_and_scores_by_plain_decomposition():
    rng = np.random.default_rng(1)
    # Longer texts, each once: equal ones tie at the last neighbour.
    texts = list(dict.fromkeys(t for t in made(5, 150) if t and len(t.split()) > 5))
    counts = quality.Terms().matrix(texts)
    labels = rng.integers(0, 2, len(texts)).astype(np.float32)
    model = quality.fit(counts, labels)
    x = quality.weighted(counts, model["idf"]).astype(np.float64)
    _, values, rows = np.linalg.svd(x, full_matrices=False)
    taken = ((x @ model["axes"]) ** 2).sum(axis=0)
    np.testing.assert_allclose(taken[:10], values[:10] ** 2, rtol=1e-3)
    np.testing.assert_allclose(np.abs(rows[0] @ model["axes"][:, 0]), 1, atol=1e-3)
    new = quality.Terms().matrix([t for t in made(6, 20) if t and t.strip()])
    latent = quality.weighted(new, model["idf"]) @ model["axes"]
    for row, score in zip(latent, quality.score_counts(new, model)):
        cosine = np.maximum(model["vectors"] @ (row / np.linalg.norm(row)), 0)
        near = np.sort(cosine)[::-1][quality.NEIGHBOURS - 1]
        votes = np.where(cosine >= near, cosine**quality.SHARPNESS, 0)
        assert score == pytest.approx((votes * labels).sum() / votes.sum(), abs=2e-3)


def test_toxicity_score_from_compressed_lengths():
    ordinary, toxic = b" the usual words of the usual text " * 30, b" vile rotten nasty awful "
    weights = np.array([0.3, 0.5, -0.2, 0.4, 0.1, 0.2, 0.05, -2.0])
    model = {"prior": 0.1, "ordinary": ordinary, "toxic": toxic, "weights": weights}
    texts = ["the usual words", "so vile and ROTTEN, nasty!", "", None, "x" * 500, "vile " * 80]

    def length(content, window):
        return len(zstandard.ZstdCompressor(
            level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        ).compress(window))

    for text, score in zip(texts, toxicity.score_texts(texts, model)):
        words = (text or "").lower().encode().split()
        data = b" " + b" ".join(words) + b" " if words else b""
        saved = [length(ordinary, data[i : i + 48]) - length(toxic + ordinary, data[i : i + 48]) for i in range(0, max(1, len(data) - 24), 24)] if data else [0]
        hits, near, root = sum(s >= 3 for s in saved), sum(s >= 2 for s in saved), len(saved) ** 0.5
        features = [max(saved), np.log1p(hits), hits / root, near / root, sum(saved) / root, sum(saved) / len(saved), sum(sorted(saved)[-4:])]
        assert score == pytest.approx(1 / (1 + np.exp(-(np.dot(features, weights[:-1]) + weights[-1]))), rel=1e-9)


def test_near_copies_share_a_name():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(400)) for _ in range(40)]
    same = sum(toxicity.copy_name(t) == toxicity.copy_name(t.replace(t.split()[200], "other", 1)) for t in texts)
    assert same > 25 and len({toxicity.copy_name(t) for t in texts}) > 30 and toxicity.copy_name(None) == toxicity.copy_name("")
