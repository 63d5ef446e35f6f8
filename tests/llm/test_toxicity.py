"""Deobfuscation of known words, search against all paths, and held-out accuracy."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import toxicity
from basketry.llm.queries import QUERIES

RNG = random.Random(3)
CLEAN = ["the", "house", "is", "green", "a", "small", "door", "opens", "to", "garden", "letter", "street", "ist", "grün", "in", "of", "on", "at"]
RUDE = ["idiot", "moron", "trash", "loser", "scum", "worthless"]
CORPUS = [" ".join(RNG.choices(CLEAN + RUDE, [5] * len(CLEAN) + [1] * len(RUDE), k=60)) for _ in range(200)]
LOGP = toxicity.log_model(toxicity.trigram_counts(CORPUS))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("1d10t", "idiot"), ("m0r0n", "moron"), ("tr@sh", "trash"), ("l0$3r", "loser"), ("scuuuuum", "scum"), ("idiooot", "idiot"),
        ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("t-r-a-s-h", "trash"), ("w0rth1ess", "worthless"), ("id*ot", "idiot"),
        ("letter", "letter"), ("grün", "grün"),
    ],
)
def test_disguised_words(written, meant):
    assert toxicity.viterbi(written, LOGP) == meant


def test_plain_words_are_left_alone():
    restorer = toxicity.Restorer(LOGP)
    for word in CLEAN + RUDE:
        assert restorer[word] == (word,)
    assert restorer.words("The HOUSE, is; (green)! 42 http://x.y/z") >= {"the", "house", "is", "green"}
    assert restorer.words("you 1d10t and i d i o t") >= {"idiot"}
    assert restorer.words("") == set() and restorer.words("*** 123 !!!") == set()


@pytest.mark.parametrize(
    "written",
    [
        "an i d i o t, go", "i d i o t.", '"i d i o t"', "(i d i o t)", "[i-d-i-o-t]!", "i d i o t!", "i d i o t !", "«i d i o t»", "i / d / i / o / t",
        "i/d/i/o/t", "i   d   i   o   t", "i\td\ni o t?", "i,d,i,o,t", "! d ! o t;", "so: 1 d 1 0 t…", "i|d|i|o|t", "a house.i d i o t",
    ],
)
def test_spelled_out_runs_beside_punctuation(written):
    assert "idiot" in toxicity.Restorer(LOGP).words(written)


@pytest.mark.parametrize(
    "written",
    [
        "idi" + "o" * 60 + "t", "1d1" + "0" * 3 + "t" * 80, "the.house.is.really.green.a.1d10t.and.opens.the.door", "iidiioott", "iddiot", "idiott",
        "the_house_is_green_the_door_opens_" * 30 + "1d10t_" + "the_garden_" * 90, "street/" * 55 + "id*ot" + "/letter" * 70,
    ],
)
def test_long_tokens_and_doubled_letters(written):
    restorer = toxicity.Restorer(LOGP)
    assert "idiot" in restorer[written]
    assert "idiot" in restorer.words(f"the house, {written}. is green")


def test_words_of_long_addresses_stay():
    found = toxicity.Restorer(LOGP)["https://www.example.com/garden42letter/" + "a1b2c3d4e5f6" * 3]
    assert {"https", "example", "garden", "letter"} <= set(found)
    assert toxicity.Restorer(LOGP)["letter"] == ("letter",) and "zzyyxx" in toxicity.Restorer(LOGP)["zzyyxx"]


def test_letters_outside_the_model_stay():
    restorer = toxicity.Restorer(LOGP)
    for word in ("идиот", "привет", "ηλίθιος", "מטומטם", "zażółć", "şöför", "हिन्दी", "日本語", "сосо"):
        assert word in restorer[word], word
        assert word in restorer[f"{word}!"] + restorer[f"{word}?"] and word in restorer.words(f"({word}), the house"), word
    assert "идиот" in restorer.words("и д и о т!") and "идиот" in restorer["идиот1"] + restorer["идиот-"]
    assert "idiot" in restorer["idiоt"] and "idiot" in restorer["іdіоt"]  # Cyrillic look-alikes among Latin letters


def test_what_is_no_spelled_out_run():
    for text in ("don't", "the house is green", "a b", "!!!! ???? ++++", "it's a t", "*** --- ___"):
        assert not list(toxicity.spelled_runs(text)), text
    long = "the house " + "i d i o t " * 300
    assert "idiot" in {w for run in toxicity.spelled_runs(long) for w in toxicity.viterbi(run, LOGP).split()}
    assert list(toxicity.spelled_runs("!" * 100_000 + " a" + "! " * 50_000)) is not None  # linear in the text


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aido01*. ")), min_size=1, max_size=5))
def test_search_finds_the_best_of_all_paths(text):
    def log_probability(parts):
        x = y = 0
        total = 0.0
        for meant, cost in [*parts, (" ", 0.0)]:
            total -= cost
            for c in meant:
                z = toxicity.CODE.get(c, 0)
                if z or y:
                    total += LOGP[(x * toxicity.SIZE + y) * toxicity.SIZE + z]
                    x, y = y, z
        return total

    paths = list(itertools.product(*[options for options, _ in toxicity._choices(text)]))
    best = max(map(log_probability, paths))
    found = toxicity.viterbi(text, LOGP)
    assert any(abs(log_probability(p) - best) < 1e-9 and " ".join("".join(m for m, _ in p).split()) == found for p in paths)


def test_counts_equal_a_plain_count():
    texts = ["ab, Ba", "", "é日x"]
    got = toxicity.trigram_counts(texts)
    wanted = np.zeros_like(got)
    for t in texts:
        codes = [toxicity.CODE.get(c, 0) for c in f" {t.lower()} "]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            wanted[(a * toxicity.SIZE + b) * toxicity.SIZE + c] += 1
    assert (got == wanted).all()


FEATURES = ["idiot", "idi-", "moro-", "scum", "aardv-", "llam-", "lam-", "ab", "grün-", "éé", "sco-"]


def _every_feature(restorer, text):
    return {f for f in toxicity.features_of(restorer.words(text)) if f in FEATURES}


def test_skipped_words_hold_no_feature():
    finder = toxicity.Finder(toxicity.trigram_counts(CORPUS), set(FEATURES))
    texts = [
        "iiddiioott idiotic morooons scumm sccum llamas llllama laaamas aardvark aaab aabb abb ééé «grünes» GRÜN, ab.",
        "x" * 500 + "idiot " + "ab" * 300 + " lla" * 3 + " i d i o t m.o.r.o.n.s \u200bidiot id\u00adiot (scum)!!! ѕcum 1d10t", "", " ",
    ]
    for text in texts:
        assert finder.found(text) == _every_feature(finder.restorer, text), text
    assert finder.found(None) == set()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabdilmostcué0.!' ")), max_size=40))
def test_skipped_words_of_any_text(text):
    finder = toxicity.Finder(np.zeros(toxicity.SIZE**3, np.int64), set(FEATURES))
    assert finder.found(text) == _every_feature(finder.restorer, text)


def test_words_without_weight_take_no_memory():
    scorer = toxicity.Scorer(toxicity.Model(weights={"idiot": 5.0, "idi-": 1.0}, bias=-3.0))
    rng = random.Random(4)
    for _ in range(50):
        scorer.score(" ".join("".join(rng.sample("abcdefgh", 5)) + rng.choice(["", ".", ", "]) for _ in range(200)))
    assert not scorer.known
    assert scorer.score("you 1d10t") > 0.9 and len(scorer.known) == 1


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        words = rng.choices(CLEAN, k=rng.randrange(5, 40))
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        docs.append((i, " ".join(words), None, 0.0))
        if rng.random() < 0.8:
            labels.append((i, int(toxic), "z"))
    docs += [(None, None, None, None), (1000, "", None, 0.0), (1001, "the 1D10T house", "x", 0.0), (1001, "the 1D10T house", "x", 0.0), (1002, "x" * 300_000, "", 0.0)]
    labels += [(None, 1, ""), (5, None, ""), (5, 0, ""), (9999, 1, "")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_scores(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model, ["text"]).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert (r["score"] >= 0.5) == any(w in (r["text"] or "").lower().replace("1d10t", "idiot") for w in RUDE), r


def test_one_class_no_labels_and_empty_tables(labelled):
    docs, labels = labelled
    small = docs.filter("doc_id is null or doc_id > 998")
    assert {round(r["score"], 3) for r in toxicity.score(small, toxicity.fit(small, labels)).collect()} == {0.5}
    only = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert all(r["score"] < 0.1 for r in toxicity.score(docs, only).collect())
    none = docs.filter("false")
    assert toxicity.score(none, toxicity.fit(none, labels.filter("false"))).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity_channel"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in unseen)
    wrongly = sum(r["predicted"] == 1 and labels[r["doc_id"]] == 0 for r in unseen)
    assert right >= 0.96 * len(unseen) and wrongly <= 0.01 * len(unseen)
