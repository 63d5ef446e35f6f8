"""Spelling variants against loops over all pairs."""

import itertools
import random
import re
import zlib

import pytest

from basketry.llm import spelling
from basketry.llm.queries import QUERIES


def plain_words(rows):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] = counts.get(low, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    by_gap = {}
    for w in counts:
        for i in range(len(w)):
            for key in ((w[:i] + w[i + 1 :]), w):
                by_gap.setdefault(key, set()).add(w)
    near = {w: set() for w in counts}
    for group in by_gap.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_edit(a, b)}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return out


def found(table):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in table.collect()]


def random_words(seed, letters, least, most, n):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(least, most))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        i, c = rng.randrange(len(w)), rng.choice(letters)
        words |= {w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], c + w, w + c}
    return {w: rng.choice([2, 3, 20, 35, 400, 5000]) for w in words if len(w) >= 7}


@pytest.mark.parametrize("crowd", [512, 1])
@pytest.mark.parametrize(("letters", "least", "most"), [("ab", 7, 10), ("aéÿx", 7, 12), ("abcdefgh", 7, 9), ("ab", 7, 31)])
def test_all_near_pairs(spark, crowd, letters, least, most):
    counts = random_words(5, letters, least, most, 250)
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = found(spelling.group_variants(table, crowd=crowd))
    assert len(got) == len(counts) and set(got) == plain_groups(counts)


def test_crowded_keys_are_cut_again(spark):
    """Thousands of words share a half; every key that is joined brings few pairs."""
    counts = {"commonstart" + "".join(x): 2 for x in itertools.product("abcdef", repeat=4)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = found(spelling.group_variants(table, crowd=64))
    assert set(got) == plain_groups(counts) and {g[4] for g in got} == {20}


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    words = ["straßen", "STRASSEN", "Überall", "überall", "éclairs", "abcdefg", "abcdefgh", "bcdefgh", "short"]
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, None]), " ".join(rng.choices(words, k=40)) + rng.choice([".", " ×7", "Āx"])) for _ in range(30)]
    rows += [(9, None), (9, ""), (None, None), (11, "abcdefg " * 50_000), (12, "xyz" * 400 + " " + "xyz" * 400 + " " + "xyz" * 400 + "x"), (9, "abcdefg"), (9, "abcdefg")]
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    words = spelling.vocabulary(spelling.noisy(spelling.runs(docs)))
    counts = {r["word"]: r["n"] for r in words.collect()}
    assert counts == plain_words(rows)
    assert set(found(spelling.group_variants(words))) == plain_groups(counts)
    assert spelling.group_variants(spelling.vocabulary(spelling.noisy(spelling.runs(docs.filter("false"))))).count() == 0


def test_chains_of_forms(spark):
    counts = {"aaaaaaaa": 10**6, "aaaaaaab": 10**5, "aaaaaabb": 10**4, "aaaaabbb": 10**3, "aaaabbbb": 100, "aaabbbbb": 10, "zzzzzzz": 2}
    got = {w: (form, root) for w, form, root, *_ in found(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert got["aaabbbbb"] == ("aaaabbbb", "aaaaaaaa") and got["aaaaaaaa"] == (None, "aaaaaaaa") and got["zzzzzzz"] == (None, "zzzzzzz")


def test_query_equals_all_pairs(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = found(QUERIES["op12_q_chunks"](spark, sf))
    wanted = plain_groups(plain_words(rows))
    assert len(got) == len(wanted) and set(got) == wanted
