"""Links and components against all pairs."""

import math

import numpy as np
import pytest

from basketry.llm import embeddings
from basketry.llm.queries import QUERIES


def plain(rows):
    """(links, smallest reachable id) per row, over all pairs."""
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[top(i)] = min(least.get(top(i), v), v)
    return [(links[i], least.get(top(i))) for i in range(len(rows))]


def cloud(seed=0, n=60, spread=0.05, length=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n, length))
    rows = [c + spread * rng.standard_normal(length) * rng.integers(0, 4) for c in centres for _ in range(rng.integers(1, 8))]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [embeddings.BLOCK, 3])
def test_links_and_components(spark, block):
    rows = cloud()
    rows += [(900, rows[5][1]), (901, rows[5][1]), (-4, [2 * x for x in rows[5][1]]), (902, rows[7][1]), (902, rows[7][1]), (None, rows[9][1])]
    odd = [(903, None), (904, [0.0] * 32), (905, [float("nan")] * 32), (906, [None] + [1.0] * 31), (907, [1.0, 2.0]), (908, []), (909, [float("inf")] * 32), (910, [-0.0] * 32)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, n_links int, kept string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(table, block=block).collect()), key=str)
    wanted = [(i, n, c, i == c) for (i, _), (n, c) in zip(rows, plain(rows), strict=True)] + [(i, 0, i, True) for i, _ in odd]
    assert got == sorted(wanted, key=str)


def test_empty_and_tiny_tables(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(table.filter("false")).count() == 0
    assert {r["vec_id"]: r["component_id"] for r in embeddings.near_duplicates(table).collect()} == {1: 1, 2: 1, 3: 3}
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embeddings.near_duplicates(nulls).collect()] == [(1, 0, 1, True)]


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 to 0.92 share a table with probability above 0.9."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, projections = embeddings.learn_rotations(x, 4)
    cosine = rng.uniform(0.9, 0.92, len(x))[:, None]
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = cosine * x + np.sqrt(1 - cosine**2) * noise
    a, b = (embeddings.substrings(v, mean, projections, embeddings.BITS, embeddings.TABLES) for v in (x, y))
    assert a.shape[1] == embeddings.TABLES
    assert (a == b).any(1).mean() > 0.93
    bits = np.unpackbits(a.astype("<u2").view("u1").reshape(len(a), -1), axis=1, bitorder="little")
    share = bits.mean(0).reshape(-1, 16)[:, : embeddings.BITS]
    assert (abs(share - 0.5) < 0.1).all()  # balanced


@pytest.mark.parametrize("common", [0.0, 0.7, 1.5, 4.0])
def test_recall_beside_a_common_direction(spark, common):
    """Brute force over vectors whose mean is ``common`` times as long as their spread."""
    rng = np.random.default_rng(2)
    length = 64
    centre = rng.standard_normal(length)
    x = rng.standard_normal((700, length)) + common * np.sqrt(length) * centre / np.linalg.norm(centre)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    cosine = rng.uniform(0.9, 0.92, len(x))[:, None]
    y = cosine * x + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    stored = np.concatenate([x, y]).astype(np.float32).astype(float)
    units = stored / np.linalg.norm(stored, axis=1, keepdims=True)
    wanted = (units @ units.T >= 0.9).sum() - len(units)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(stored)], "vec_id long, embedding array<float>")
    found = sum(r["n_links"] for r in embeddings.near_duplicates(table).collect())
    assert 0.95 * wanted <= found <= wanted


def test_query_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = sorted((r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect())
    wanted = plain(rows)
    got = {r["vec_id"]: r for r in QUERIES["op8_itq_embeddings"](spark, sf).collect()}
    found = sum(got[i]["n_links"] for i, _ in rows)
    assert all(got[i]["n_links"] <= n for (i, _), (n, _) in zip(rows, wanted, strict=True))
    assert found >= 0.97 * sum(n for n, _ in wanted)
    assert sum(got[i]["component_id"] == c for (i, _), (_, c) in zip(rows, wanted, strict=True)) >= 0.99 * len(rows)


def test_codes_drop_strangers_and_keep_neighbours():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotations = embeddings.learn_rotations(x, 4)
    farthest = embeddings.farthest_code(x, 0.9, rotations)
    pairs = embeddings.made_pairs(x, 0.9, seed=9)
    for a, b in pairs:
        assert (embeddings.apart(embeddings.codes(a, *rotations), embeddings.codes(b, *rotations)) <= farthest).mean() > 0.985
    assert embeddings.codes(x, *rotations).shape == (1500, 2)
    near = embeddings.near_codes(embeddings.codes(x, *rotations), np.zeros(1500, int), False, farthest)
    assert near.mean() < 0.01  # of strangers
    twice = np.concatenate([x[:50], x[:50]])
    block = np.repeat([0, 1], 50)
    assert embeddings.near_codes(embeddings.codes(twice, *rotations), block, True, farthest).all()
