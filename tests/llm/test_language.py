"""Code lengths against a plain context tree, whole codes, held-out accuracy and edge cases."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from basketry.llm import language
from basketry.llm.queries import QUERIES

RNG = random.Random(11)
STEMS = {"aa": ["the", "and", "of", "there", "other"], "bb": ["der", "die", "und", "über", "straße"], "cc": ["le", "une", "été", "où"]}


def sentence(lang, n=30):
    return " ".join(RNG.choice(STEMS[lang]) + RNG.choice(["", "", "s", ",", "42"]) for _ in range(n))


def plain_places(text):
    for word in text.lower().split():
        raw = f" {word} ".encode().translate(language.DIGITS)
        for i in range(1, len(raw)):
            yield raw[max(0, i - language.ORDER) : i], raw[i]


def plain_counts(texts):
    counts = defaultdict(lambda: defaultdict(int))
    for text in texts:
        for context, byte in plain_places(text):
            for k in range(len(context) + 1):
                counts[context[len(context) - k :]][byte] += 1
    return counts


def plain_bits(counts, context, byte):
    bits, out = 0.0, set()
    for k in range(len(context), -1, -1):
        after = counts.get(context[len(context) - k :], {})
        rest = {b: n for b, n in after.items() if b not in out}
        total = sum(rest.values())
        if byte in rest:
            return bits + math.log2((total + len(rest)) / rest[byte])
        if rest:
            bits += math.log2((total + len(rest)) / len(rest))
        out |= set(after)
    return bits + math.log2(256 - len(out))


def train(spark, rows, **args):
    return language.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"), **args)


def kept(n):
    """The first ids that train."""
    return [i for i in range(4 * n + 40) if zlib.crc32(str(i).encode()) % 4 != 2][:n]


@pytest.fixture(scope="module")
def learned(spark):
    texts = {lang: [sentence(lang) for _ in range(20)] for lang in STEMS}
    rows = [(i, lang, t) for i, (lang, t) in zip(kept(60), [(g, t) for g, ts in texts.items() for t in ts], strict=True)]
    return texts, train(spark, rows)


def test_code_lengths_equal_a_plain_tree(learned):
    texts, model = learned
    assert model.languages == sorted(STEMS)
    for probe in ["the other and", "über der été", "unseen wörds zz", "THE 17", "日本語 xyz", "a" * 300]:
        got = language.Coder(model).code([probe])[0] / language.UNIT
        for lang, bits in zip(model.languages, got, strict=True):
            counts = plain_counts(texts[lang])
            wanted = sum(plain_bits(counts, c, b) for c, b in plain_places(probe))
            assert bits == pytest.approx(wanted, abs=1e-3)


def test_every_context_has_a_whole_code(learned):
    _, model = learned
    for context in (b"", b" ", b" th", b"the ", b"\xc3", b"zz", b" xa"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        for tree in model.trees:
            bits = language.code_lengths(tree, np.full(256, len(context)), grams)
            assert np.exp2(-bits / language.UNIT).sum() == pytest.approx(1.0, abs=1e-4)


def test_pruned_trees_have_whole_codes(spark):
    model = train(spark, [(i, "aa", sentence("aa")) for i in kept(40)], nodes=60)
    assert all(len(level.grams) <= 60 for level in model.trees[0]) and any(len(level.grams) for level in model.trees[0][1:])
    grams = np.array([int.from_bytes(b" th" + bytes([b]), "big") for b in range(256)])
    bits = language.code_lengths(model.trees[0], np.full(256, 3), grams)
    assert np.exp2(-bits / language.UNIT).sum() == pytest.approx(1.0, abs=1e-4)


def test_small_stores_change_nothing(spark, learned, monkeypatch):
    texts, model = learned
    whole = [tuple(language.Coder(model).code([t])[0]) for ts in texts.values() for t in ts]
    monkeypatch.setattr(language, "HELD_WORDS", 3)
    monkeypatch.setattr(language, "AT_ONCE", 10)
    coder = language.Coder(model)
    assert [tuple(coder.code([t])[0]) for ts in texts.values() for t in ts] == whole


def test_nulls_ties_long_texts_and_clashing_columns(spark, learned):
    _, model = learned
    rows = [
        (1, None, "x", 0.5), (2, "", "x", 0.5), (3, "12 34 !? ²", "x", 0.5), (4, "the other and there", "cc", 0.5),
        (None, "über der straße", "x", 0.5), (4, "the other and there", "cc", 0.5), (7, "une " * 300_000 + "où", "x", 0.5), (8, "q" * 2_000_000, "x", 0.5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()), key=str)
    assert [g[:2] for g in got] == [(0, "bb"), (1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (7, "cc"), (8, got[-1][1])]
    assert all(0.0 <= g[2] <= 1.0 for g in got) and [g[2] for g in got[1:4]] == [0.0] * 3
    assert language.predict(docs.filter("false"), model).count() == 0


def test_equal_languages_and_nothing_learned(spark):
    ids = kept(4)
    same = [(ids[0], "zz", "one two"), (ids[1], "yy", "one two"), (ids[2], None, "uno dos"), (ids[3], "xx", None)]
    model = train(spark, same)
    assert model.languages == ["yy", "zz"]
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    row = language.predict(docs, model).first()
    assert (row["lang_pred"], row["score"]) == ("yy", 0.5)
    nothing = language.predict(docs, train(spark, [])).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_held_out_rows_do_not_train(spark):
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert train(spark, [(i, "aa", "hidden words") for i in out]).languages == []


def test_query_predicts_held_out_documents(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_ppm_language"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held) > 20
