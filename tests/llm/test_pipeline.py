"""Every stage of the pipeline against plain Python over its own input."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.llm import pii, toxicity
from tests.llm.test_decontam import plain as plain_hits
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs.first()
    odd = [
        (None, None, None, None, None), (-1, "", "en", None, 0), (5_000_000, "a b", None, "", 3), (5_000_001, "a b", None, "", 3),
        (5_000_001, "a b", None, "", 3), (first["doc_id"], first["text"], "xx", "again", 1), (None, "only a null id here", None, None, 1),
        (5_000_002, "write to some.body@mail.example.com or +1 (222) 333-4444 please, soon and often", "en", "z", 1),
        (5_000_003, "long " * 60_000, "en", "z", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns(
        {n: corpus_pipeline.F.lit(1) for n in ("score", "row", "fp", "hash", "_text", "redacted", "items", "component")}
    )
    found = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        found.append((name, stage(spark, found[-1][1], sf).cache()))
    return {name: (df, [tuple(r) for r in df.collect()]) for name, df in found}


def ordered(rows):
    return sorted(rows, key=str)


def test_columns_stay(steps):
    names = steps["input"][0].columns
    assert all(steps[n][0].columns == names for n, _ in corpus_pipeline.STAGES[:-1])
    assert steps["packing"][0].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_toxic_documents_go(spark, sf, steps):
    docs, rows = steps["input"]
    scorer = toxicity.Scorer(toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    assert ordered(steps["toxicity"][1]) == ordered(r for r in rows if scorer.score(r[1]) < 0.5)


def test_one_document_of_a_group_stays(steps):
    rows = steps["toxicity"][1]
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    parent = plain_components([(i, f) for i, (_, f) in enumerate(prints)])
    groups = {}
    for row, group in zip(rows, parent, strict=True):
        groups.setdefault(group, []).append(row)
    kept = steps["near_duplicates"][1]
    assert len(kept) == len(groups)
    for members in groups.values():
        mine = [r for r in kept if r in members]
        least = min((m[0] for m in members if m[0] is not None), default=None)
        assert len(mine) >= 1 and any(r[0] == least for r in mine)


def test_contaminated_documents_go(spark, sf, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = steps["near_duplicates"][1]
    assert ordered(steps["decontamination"][1]) == ordered(r for r in rows if not plain_hits(r[1], items)[3])


def test_personal_data_is_masked(steps):
    before = ordered(steps["decontamination"][1])
    after = {(r[0], r[3]): r for r in steps["personal_data"][1]}
    assert len(after) == len(before) == len(steps["personal_data"][1])
    for row in before:
        new = after[row[0], row[3]]
        if row[1] is None:
            assert new[1] is None
            continue
        masked = pii.mask(row[1], pii.base_spans(row[1]))
        assert new[4] == len(new[1])
        assert new[1] == masked or "[" in new[1]
    assert after[5_000_002, "z"][1] == "write to [EMAIL] or [PHONE] please, soon and often"


def test_everything_kept_is_packed(steps):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for r in steps["personal_data"][1]:
        lengths[r[0]] = lengths.get(r[0], 0) + len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1
    got, bins = {}, {}
    for doc, _, _, length, _, sequence, _ in steps["packing"][1]:
        got[doc] = got.get(doc, 0) + length
        bins[sequence] = bins.get(sequence, 0) + length
    assert got == lengths and max(bins.values()) <= 2048
    assert len(bins) <= np.ceil(sum(lengths.values()) / 2048) + 3


def test_run_and_empty_tables(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 100
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).count() == 0
