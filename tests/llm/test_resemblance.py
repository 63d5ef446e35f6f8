"""Near copies of the pipeline stage against plain loops over all pairs."""

import random

import corpus_pipeline
from basketry.llm import resemblance
from tests.llm.test_simhash import plain_fingerprint


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_groups(rows):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets, prints, wide = [plain_shingles(t) for _, t in rows], [plain_fingerprint(t) for _, t in rows], 0
    for i in range(len(rows)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= 2
            alike = bool(sets[i] & sets[j]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
            wide += alike and not near
            if near or alike:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i])
    return list(groups.values()), wide


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = []
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randrange(60, 200))
        rows.append(base)
        for changes in (1, 1, 2, 3, 5):
            copy = list(rng.choice(rows[-2:]))
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy)
    texts = [" ".join(r) for r in rows] + ["A b", "a  B", "a b c d e", "a b c d f", "", None, "", rows and " ".join(rows[0])]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def test_near_copies_beyond_two_bits_go(spark, monkeypatch):
    rows = corpus()
    groups, wide = plain_groups(rows)
    assert wide > 50  # pairs that the fingerprints alone do not link
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for salted in (resemblance.SALTED, 2):
        monkeypatch.setattr(resemblance, "SALTED", salted)
        kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "", similar=True).collect())
        assert kept == sorted(min(i for i, _ in g) for g in groups)


def test_keys_meet_at_the_least_similarity():
    rng = random.Random(5)
    met = 0
    for _ in range(400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        copy = list(base)
        for at in (20, 60, 100, 140):
            copy[at] = "x"  # five shingles each: 180 of 220 are common
        a, b = (" ".join(t).encode() for t in (base, copy))
        assert resemblance.resemble(resemblance.shingles(a), resemblance.shingles(b))
        met += bool(set(resemblance.band_keys(a)) & set(resemblance.band_keys(b)))
    assert met >= 398


def test_similarity_bound_is_exact():
    whole = {bytes([i]) for i in range(10)}
    assert resemblance.resemble(whole, set(list(whole)[:8])) and not resemblance.resemble(whole, set(list(whole)[:7]))
    assert not resemblance.resemble(set(), set())
