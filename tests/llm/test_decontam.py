"""Winnowing against every window compared with every window."""

import random
import re

import pytest

from basketry.llm import decontam


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, other in items:
        parts = plain_words(other)
        n = min(13, len(parts))
        windows = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "x1"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 6, 12, 13, 14, 30, 60]))) for i in range(30)]
    items += [(None, say(20)), (3, say(25)), (100, None), (101, " .,"), (102, items[8][1]), (103, "zz " * 40)]
    docs = [(None, "alone"), (1, None), (2, ""), (3, "--- !"), (4, "zz " * 500), (4, "zz " * 12), (5, "Zz" * 20_000)]
    for i in range(60):
        text = say(rng.randrange(200))
        if i % 2:
            parts = plain_words(rng.choice(items)[1])
            at = rng.randrange(max(1, len(parts) - 12))
            text += "! " + "; ".join(parts[at : at + rng.randrange(10, 30)]).upper() + " " + say(5)
        docs.append((10 + i, text))
    return docs, items


@pytest.mark.parametrize("small_chars", [decontam.SMALL_CHARS, 0])
def test_every_window_is_found_with_and_without_broadcast(spark, corpus, small_chars):
    docs, items = corpus
    table = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], "doc_id long, text string, items string, n_hit int")
    benchmark = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = decontam.judge(table, benchmark, small_chars=small_chars).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in got) == sorted((str(d), *plain(t, items)) for d, t in docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontam.judge(docs, none).collect()] == [(1, 3, 0, [], False)]
    assert decontam.judge(docs.filter("false"), none).count() == 0


def test_winnowing_keeps_a_gram_of_every_window():
    import numpy as np

    grams = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    picked = decontam.winnow(grams, 9)
    for i in range(len(grams) - 8):
        inside = picked[(picked >= i) & (picked < i + 9)]
        assert (grams[inside] == grams[i : i + 9].min()).any()
    assert len(picked) < 0.35 * len(grams)


def test_items_without_text_and_long_ids_count_in_the_size(spark):
    rows = [("i" * 1000 + str(i), None) for i in range(50)] + [(None, "abc")]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    assert decontam.written_size(benchmark) >= 50_000
    assert decontam.written_size(benchmark.filter("false")) == 0
    docs = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    got = {small: tuple(decontam.judge(docs, benchmark, small_chars=small).first()) for small in (decontam.SMALL_CHARS, 0)}
    assert got[0] == got[decontam.SMALL_CHARS] == (1, 2, 1, ["null"], True)


def test_hot_grams_are_dealt_out(spark):
    ours = spark.range(2000).selectExpr("if(id % 3 = 0, 5, id) AS gram", "id AS _key")
    theirs = spark.range(300).selectExpr("if(id % 2 = 0, 5, id) AS gram", "id AS row")
    wanted = sorted(map(tuple, ours.join(theirs, "gram").select("_key", "row").collect()))
    for share in (0.001, 1.0):
        assert sorted(map(tuple, decontam._shared_grams(ours, theirs, share).collect())) == wanted


def test_a_worker_keeps_one_thing_at_a_time():
    from basketry.llm import held

    made = []
    keep = lambda key: held.held(key, lambda: made.append(key) or [key])
    first = keep("a")
    assert keep("a") is first and made == ["a"]
    keep("b")
    assert list(held._kept) == ["b"] and keep("a") is not first
