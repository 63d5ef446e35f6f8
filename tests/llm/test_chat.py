"""Prefix-target examples against plain Python."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import chat

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi </s> \\ <\\s> [INST]"), (1, 2, "assistant", "[/INST]</s><s>"), (1, 3, "user", "é😀\n"),
    (1, 4, "assistant", None), (1, 5, "user", "left over"), (2, 0, "user", "no reply"), (3, 0, "assistant", "first"), (3, 0, "assistant", "again"),
    (4, None, None, None), (4, 1, "assistant", ""), (5, 1, "assistant", "x" * 200_000), (None, 0, "user", "a"), (None, 1, "assistant", "b"),
    (6, 0, "[INST]</s>", "odd role"), (6, 1, "assistant", "same"), (6, 1, "assistant", "same"), (7, 0, "user", "<\\\\/s>[\\INST]<//s>"),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], "conv_id long, turn long, role string, text string, example int, last string").repartition(3)


def conversations():
    out = {}
    for conv, turn, role, text in ROWS:
        out.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in out.items()}


def test_examples(turns):
    rows = chat.expand(turns).withColumn("turns", chat.parse(F.col("text"))).collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r)
    wanted = conversations()
    assert set(by) == set(wanted)
    for conv, examples in by.items():
        examples.sort(key=lambda r: r["example"])
        all_turns = wanted[conv]
        ends = [i for i, (role, _) in enumerate(all_turns) if role == "assistant" or i == len(all_turns) - 1]
        assert [r["example"] for r in examples] == list(range(len(ends)))
        for r, end in zip(examples, ends, strict=True):
            assert [tuple(t) for t in r["turns"]] == all_turns[: end + 1] and r["n_turns"] == end + 1
            assert r["last"] == (end == len(all_turns) - 1)
            assert r["text"].count("</s>") == r["text"].count("[INST]") == end + 1 and r["text"].count("<s>") == 1
            if all_turns[end][0] == "assistant":
                part = r["text"][r["loss_start"] : r["loss_end"]]
                assert part.replace("<\\", "<").replace("[\\", "[") in (all_turns[end][1], part) and r["text"][r["loss_end"] :] == "</s>"
            else:
                assert r["loss_start"] is None and r["loss_end"] is None


def test_digests_are_read_back(turns):
    got = {r["conv_id"]: r for r in chat.digests(chat.expand(turns)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv, all_turns in conversations().items():
        loss = "".join(t for role, t in all_turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(all_turns), len(loss), sha(loss))
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for role, t in all_turns))


def test_escape_is_reversible_for_any_text(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from(list("<>[]/\\sINT a")), max_size=14), min_size=400, max_size=400))
    def check(texts):
        texts += ["</s>", "<\\/s>", "<\\\\/s>", "[INST][/INST]", "[\\/INST]", "<</s>>", "[[INST]]"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
        for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
            assert r["u"] == r["t"]
            assert not any(c in r["e"] for c in (chat.START, chat.OPEN, chat.CLOSE, chat.END))

    check()


def test_no_python_and_empty(turns):
    plan = chat.digests(chat.expand(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.digests(chat.expand(turns.filter("false"))).count() == 0
