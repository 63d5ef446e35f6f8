"""SimHash components against plain loops over all pairs."""

import random
import re

import pytest
import xxhash

from basketry.llm import simhash
from basketry.llm.components import connected_components
from basketry.llm.queries import QUERIES


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{position: smallest id} by flooding over all pairs of (id, fingerprint)."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(least[r], doc)
    return [least[root(i)] for i in range(len(rows))]


TEXTS = [None, "", " \t\n", "a", "A", "one two", "ONE  two", "x\x1cy z\x0bw", "é É", "long " * 70_000, "tail " + "long " * 70_000, "a b c d", "a b c d"]


@pytest.mark.parametrize("text", TEXTS + ["a b c d", "The QUICK brown fox; jumps"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_fingerprint_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    text = " ".join(random.Random(1).choices("abcdefgh", k=100))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    rows = [(i, t, "f", 1) for i, t in enumerate(TEXTS)] + [(3, "a", None, None), (None, "a", None, None), (None, "alone here now", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.document_components(docs).collect())
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    wanted = [(str(d), f"{f:016x}", c) for (d, f), c in zip(prints, plain_components(prints), strict=True)]
    assert got == sorted(wanted, key=lambda r: (r[0], r[1], r[2] or 0)) or sorted(got, key=str) == sorted(wanted, key=str)
    assert simhash.document_components(docs.filter("false")).count() == 0


@pytest.mark.parametrize("crowd", [1024, 4])
def test_links_of_fingerprints_around_centres(spark, crowd):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}) for _ in range(25)]
    prints += [0, 1, 3, (1 << 64) - 1, 1 << 63, (1 << 63) | 1]
    rows = list(enumerate(prints))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in rows]
    table = spark.createDataFrame(signed, "doc_id long, fp long")
    classes = {r["fp"]: r["component_id"] for r in simhash.near_duplicates(table, crowd).collect()}
    assert [classes[f] for _, f in signed] == plain_components(rows)


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(1, 200)]
    rng.shuffle(path)
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = path + star + star[:20] + [(5000, 5000), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 201)} | {i: 1000 for i in range(1000, 1300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_all_pairs(spark, sf):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in QUERIES["op2_simhash_golay"](spark, sf).collect())
    assert got == [(d, f"{f:016x}", c) for (d, f), c in zip(prints, plain_components(prints), strict=True)]
