"""Token ids, packing and grammar-compressed files against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import grammar, packing
from basketry.llm.queries import QUERIES
from basketry.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
ODD = [
    None, "", " ", "\n\t ", "a", "Don't stop, it's FINE!!", "x" * 5000, "é é ﬁ İstanbul ΣΑΣ ß µ ª",
    "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b.", "a\x1cb\x85c\xa0d e", "日本語 テスト 1234 😀😀", "́ ́a",
    "one two three " * 3000, "it 's we'll 're", "...,,,;;;", "A.B.C", "word.", "word.́",
]


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_whole_encoding(text):
    raw = None if text is None else text.encode()
    assert np.frombuffer(ENCODER.ids(raw), "<u4").tolist() == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aBé'sStd.,! \n\t\x1c\x85 ́İσΣ1<|>日")), max_size=30) | st.text(max_size=20))
def test_ids_equal_the_whole_encoding_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(ENCODER.ids(text.encode()), "<u4").tolist() == whole(text)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(3, ODD[3], "x", 0), (None, "null id", None, None), (None, "b", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, start long").repartition(3)


def test_packing_is_gapless_and_whole(docs):
    rows = packing.pack(packing.token_pieces(docs, PATH, length=64, keep_ids=True), 64, group_rows=8).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(whole(r["text"]) + [0])
    wanted = []
    for doc, texts in ids.items():
        for t in texts:
            wanted += [(str(doc), k // 64, k, len(t[k : k + 64]), zlib.crc32(np.array(t[k : k + 64], "<u4").tobytes())) for k in range(0, len(t), 64)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(wanted)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_sequences_hold_the_ids(docs):
    packed = packing.pack(packing.token_pieces(docs, PATH, length=64, keep_ids=True), 64)
    by_id = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = by_id[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


def brute_force(lengths, size):
    """Sum of squares recomputed in full for every choice."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in set(gaps) if g >= n]
        if not fits:
            gaps.append(size - n)
            continue

        def squares(g, n=n):
            after = list(gaps)
            after[after.index(g)] = g - n
            return sum(after.count(x) ** 2 for x in set(after) if x), g

        gaps[gaps.index(min(fits, key=squares))] -= n
    return sorted(gaps)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_placing_minimises_the_sum_of_squares(lengths):
    sequence, offset = packing.place(np.array(lengths, np.int64), 20)
    used = np.bincount(sequence, lengths) if lengths else np.zeros(0)
    assert sorted(20 - used) == brute_force(lengths, 20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(2, 5), max_size=60), max_size=12), st.integers(1, 4))
def test_grammar_round_trip(texts, repeat):
    ids = np.array([x for t in texts * repeat * 4 for x in [*t, 1]], np.uint32)
    symbols, left, right = grammar.compress(ids, 1, 6)
    lengths = grammar.expansion_lengths(left, right, 6)
    assert (grammar.expand(symbols, left, right, lengths, 6) == ids).all()
    assert (symbols == 1).sum() == (ids == 1).sum()


def test_grammar_files_hold_every_document_in_order(docs, tmp_path):
    manifest = grammar.write_corpus(docs, str(tmp_path), PATH, shard_tokens=500)
    assert manifest.count() > 2
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in grammar.read_corpus(manifest, 3).collect())
    assert [g[1] for g in got][:2] == [None, None] and [g[1] for g in got][2:] == sorted(g[1] for g in got[2:])
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    wanted = sorted((str(r["doc_id"]), zlib.crc32(np.array(whole(r["text"]) + [1], "<u4").tobytes())) for r in docs.collect())
    assert sorted((str(g[1]), g[3]) for g in got) == wanted


def test_a_single_document_is_read_by_its_range(docs, tmp_path):
    manifest = grammar.write_corpus(docs.filter("doc_id is not null").coalesce(1), str(tmp_path), PATH)
    shard = grammar.ShardFile(manifest.first()["path"])
    for k, doc in enumerate(shard.doc_ids.tolist()):
        assert shard.ids(k, k + 1).tolist() == whole(ODD[doc]) + [1]


def test_empty_tables(docs, tmp_path):
    none = docs.filter("false")
    assert packing.pack(packing.token_pieces(none, PATH)).count() == 0
    assert grammar.read_corpus(grammar.write_corpus(none, str(tmp_path), PATH)).count() == 0


def test_queries_equal_the_whole_encoding(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op10_repair_ids"](spark, sf).collect()}
    start = 0
    for doc in sorted(texts):
        ids = np.array(whole(texts[doc]) + [1], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    packed = QUERIES["op7_sum_of_squares"](spark, sf).collect()
    assert sum(r["length"] for r in packed) == start
    assert len({r["sequence_id"] for r in packed}) <= -(-start // 2048) + 2
