"""K-d tree shards: the law of equal bytes, gapless slots, and the tree against plain splitting."""

import zlib

import pytest

from basketry.llm import sharding
from basketry.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text {i % 37} " * (1 + i % 11), "abc"[i % 3], f"src{min(i % 7, 3)}", 0, "s") for i in range(900)]
    rows += [(1000 + i, "the same words in a third of all rows", "a", "src0", 0, "s") for i in range(500)]
    rows += [(2000, None, None, None, None, None), (2001, "", None, None, None, None), (None, "no id", "a", "src0", 1, ""), (7, "again", "b", "x", 2, "")]
    rows += [(2002, "é" * 3000, "a", "src1", 0, "")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int, size string").repartition(5)


def check(rows, texts, shards):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(r["size"] for r in rows)
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= 2 * largest
    return sizes


def test_bytes_are_equal_and_slots_gapless(docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for shards in (1, 2, 7):
        check(sharding.assign_shards(docs, shards).collect(), texts, shards)


def test_target_bytes(docs):
    rows = sharding.assign_shards(docs, target_bytes=20_000).collect()
    total = sum(r["size"] for r in rows)
    assert len({r["shard"] for r in rows}) == -(-total // 20_000)


def test_first_cut_is_the_weighted_median_of_the_widest_dimension(docs):
    rows = [r.asDict() for r in sharding.metadata(docs).collect()]
    tree = sharding.grow_tree(sharding.metadata(docs).cache(), 2)
    node = tree[0, 2]
    key = lambda r: (r["dims"][node.dimension], r["text_crc32"], -(2**63) if r["doc_id"] is None else r["doc_id"])
    half, running, off = sum(r["size"] for r in rows) / 2, 0, {}
    for r in sorted(rows, key=key):
        running += r["size"]
        off[key(r)] = abs(running - half)  # rows equal in all stay together
    # A sample of all rows proposes 63 keys, the middle ones among them.
    assert off[node.at] == min(off.values())


def test_same_result_whatever_the_partitions(docs):
    one = sorted(map(str, sharding.assign_shards(docs.dropDuplicates(["doc_id"]), 5).collect()))
    assert one == sorted(map(str, sharding.assign_shards(docs.dropDuplicates(["doc_id"]).repartition(2), 5).collect()))


def test_written_shards_and_empty_table(spark, docs, tmp_path):
    sharding.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count()
    assert back.select("row.*").columns == docs.columns
    placed = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in sharding.assign_shards(docs, 4).collect()}
    for r in back.selectExpr("shard", "row.doc_id", "crc32(coalesce(row.text, '')) AS crc").collect():
        assert placed[r["doc_id"], r["crc"]] == r["shard"]
    assert sharding.assign_shards(docs.filter("false"), 3).count() == 0


def test_query(spark, sf):
    rows = QUERIES["op9_kd_shards"](spark, sf).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, texts, 40)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_sampled_cuts_are_close_and_many_files_do_no_harm(spark, monkeypatch):
    """With a sample far smaller than the table, and one document of a tenth of all bytes."""
    monkeypatch.setattr(sharding, "SAMPLE", 500)
    rows = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('x', cast(20 + id % 200 + if(id = 77, 300000, 0) AS int)) AS text",
        "cast(id % 5 AS string) AS lang", "cast(id % 3 AS string) AS source",
    )
    placed = sharding.assign_shards(rows.repartition(60), 8)
    sizes = {r["shard"]: (r["s"], r["m"]) for r in placed.groupBy("shard").agg({"size": "sum", "slot": "max"}).toDF("shard", "s", "m").collect()}
    total = sum(s for s, _ in sizes.values())
    assert len(sizes) == 8 and max(s for s, _ in sizes.values()) < 1.1 * total / 8 + 300_000
    assert sum(m + 1 for _, m in sizes.values()) == 20_000
    tree = sharding.grow_tree(sharding.metadata(rows), 8)
    plan = sharding.metadata(rows).select(sharding.shard_of(tree, 8))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 6_000
