"""Ball-tree search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from basketry.llm import lexical

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain_search(docs, items, keep=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    full = [(d, c, sum(c.values())) for d, c in counted if c]
    number, total = len(full), sum(n for _, _, n in full)
    holding = Counter(t for _, c, _ in full for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, c, n in full:
            m = 75 + 25 * n * number // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:keep], 1)]
    return sorted(out, key=str)


def found(table):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in table.collect()), key=str)


def make(seed, n, words=300, most=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, most)))) for i in range(n)]
    items = [(f"q{i}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(12)]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")


@pytest.mark.parametrize(("tree", "groups", "part"), [(4096, 2048, 1024), (50, 8, 7), (100, 2, 1024)])
def test_search_equals_scoring_all(spark, monkeypatch, tree, groups, part):
    monkeypatch.setattr(lexical, "TREE", tree)
    monkeypatch.setattr(lexical, "GROUPS", groups)
    monkeypatch.setattr(lexical, "PART", part)
    docs, items = make(1, 700)
    docs += [(10_000 + i, docs[3][1]) for i in range(60)]  # equal scores
    assert found(lexical.search(*frames(spark, docs, items))) == plain_search(docs, items)


def test_queries_in_blocks(spark):
    docs, items = make(2, 200)
    assert found(lexical.search(*frames(spark, docs, items), block=120)) == plain_search(docs, items)


def test_nulls_ties_long_texts_and_clashing_columns(spark):
    docs = [
        (1, None), (2, ""), (3, "..."), (4, "Alpha beta"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (6, "ALPHA\u0085x"),
        (7, "alpha " * 200_000), (8, "gamma " * 100_000 + "épée"), (9, "delta"),
    ]
    items = [("a", "alpha alpha BETA"), ("a", "alpha alpha BETA"), ("b", None), (None, "épée;gamma"), ("c", "!"), ("d", "nowhere"), ("a", "delta")]
    d = spark.createDataFrame([(i, t, 7, 1) for i, t in docs], "doc_id long, text string, score int, rank int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    assert found(lexical.search(d, q)) == plain_search(docs, items)
    assert lexical.search(d.filter("false"), q).count() == 0 and lexical.search(d, q.filter("false")).count() == 0
    assert lexical.search(d, q).schema.simpleString() == "struct<item_id:string,rank:int,doc_id:bigint,score:bigint>"


def test_bounds_hold_and_prune():
    docs, items = make(4, 3000, words=2000, most=80)
    numbers = {f"w{i}": i for i in range(2000)}
    vectors = [Counter(numbers[t] for t in terms(text)) for _, text in docs]
    start = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    of = np.array([t for v in vectors for t in v], np.int64)
    rng = np.random.default_rng(1)
    impacts = rng.integers(1, 10**6, len(of))
    weights = rng.integers(0, 12_000, 2000)
    tree = lexical.BallTree(start, of, impacts, weights, lexical.term_groups(weights, 1024))
    exact, scored = np.zeros(2000, np.int64), 0
    for _, text in items:
        query = Counter(numbers[t] for t in terms(text))
        asked = np.array(list(query)), np.array(list(query.values()))
        dense = np.zeros(2000, np.int64)
        dense[asked[0]] = asked[1] * weights[asked[0]]
        scores = np.add.reduceat(np.append(tree.impacts * dense[tree.terms], 0), tree.start[:-1]) * (np.diff(tree.start) > 0)
        for (low, high), bound in zip(tree.ranges, tree.bounds(*asked), strict=True):
            assert scores[low:high].max() < bound
        best = []
        scored += tree.search(query, best, np.arange(0, -3000, -1), 5, exact)
        assert sorted(s for s, _ in best) == sorted(int(s) for s in np.sort(scores)[-5:] if s > 0)
    assert not exact.any() and scored < 0.5 * len(items) * len(docs)
