"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Rotations are learned on at most about ``SAMPLE`` distinct vectors, so that the signs of the rotated,
centred vectors are balanced codes close to the vectors. Every distinct vector is indexed: its codes
are cut into ``BITS``-bit substrings, each the key of a table. Vectors that share a substring in any table
are compared by their cosine in double precision. Where the mean is zero, vectors at cosine 0.9 differ in
about a seventh of the bits, so a table holds both with probability 0.16 and 20 tables together with
0.97; closer pairs are found more surely. Vectors with a common direction are further apart once they are
centred. So pairs at the least cosine are made from the sample, and the substrings get as long as they can
be, up to ``BITS``, for ``FOUND`` of them to meet. A pair counts in the first table only in which it meets.

Buckets hold codes of ``CODE_BITS`` bits only. A vector travels to a bucket if its code lies within a Hamming
distance of another one there, which ``KEPT`` of the made pairs keep; cosines decide among those.

Copies travel as one vector with their number. A bucket is compared in blocks of ``BLOCK`` vectors;
a larger one is split into blocks and every two blocks meet in one group, so no group is
unbounded and no pair is left out. Pairs never leave their task: what does is the number of links of
a vector, and its smallest companion.

Defined results: vectors that are NULL, zero, hold NULL or non-finite numbers, or are of another length
than the most frequent one (the longer on a tie) link with nothing and are a component of their
own; repeated rows link with each other; a NULL vec_id is ignored when the smallest id is
taken; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.operators.scale import attach_by_key, hash_sample
from basketry.session import cut

SAMPLE = 20_000
LEAST_COSINE = 0.9
BITS = 12
TABLES = 20
CODE_BITS = 128  # of the code that is compared before vectors travel
KEPT = 0.995  # share of the pairs made at the least cosine whose codes must be near
FOUND = 0.96  # share of the pairs made at the least cosine that must meet in a table
TRIED = 4_000  # of these pairs of a sort
BLOCK = 2048
ROUNDS = 30


def learn_rotations(sample: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections) by iterative quantisation; projections are (count, length, length)."""
    length = sample.shape[1]
    rng = np.random.default_rng(seed)
    mean = sample.mean(0) if len(sample) else np.zeros(length)
    _, _, axes = np.linalg.svd(sample - mean, full_matrices=True) if 0 < len(sample) < length else (0, 0, None)
    if axes is None:
        axes = np.linalg.eigh(np.cov((sample - mean).T) if len(sample) > 1 else np.eye(length))[1].reshape(length, length).T
    along = (sample - mean) @ axes.T
    found = []
    for _ in range(count):
        rotation = np.linalg.qr(rng.standard_normal((length, length)))[0]
        for _ in range(rounds if len(sample) else 0):
            left, _, right = np.linalg.svd(along.T @ np.where(along @ rotation >= 0, 1.0, -1.0))
            rotation = left @ right
        found.append(axes.T @ rotation)
    return mean, np.array(found)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)  # squares neither overflow nor vanish
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def substrings(vectors: np.ndarray, mean: np.ndarray, projections: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vectors, tables) keys; every rotation gives as many whole substrings as its bits hold."""
    each = vectors.shape[1] // bits
    columns = []
    for projection in projections:
        signs = (vectors - mean) @ projection >= 0
        for k in range(each):
            columns.append(signs[:, k * bits : (k + 1) * bits] @ (1 << np.arange(bits)))
    return np.stack(columns, 1)[:, :tables].astype("<u4")


def made_pairs(sample: np.ndarray, least: float, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at cosine ``least``: sampled ones turned in any direction, or towards the difference
    of two others, as the data vary; and sampled ones at up to 0.02 more, if there are enough."""
    if len(sample) < 2 or sample.shape[1] < 2:
        return []
    rng = np.random.default_rng(seed)
    x = sample[rng.integers(0, len(sample), TRIED)]
    others = sample[rng.integers(0, len(sample), (2, TRIED))]
    found = []
    for aside in (rng.standard_normal(x.shape), others[0] - others[1]):
        aside = aside - (aside * x).sum(1, keepdims=True) * x
        far = np.linalg.norm(aside, axis=1)
        some = far > 1e-9
        turned = least * x[some] + np.sqrt(max(0.0, 1 - least**2)) * aside[some] / far[some, None]
        if some.any():
            found.append((x[some], turned))
    own = sample[:TRIED]
    cosines = np.triu(own @ own.T, 1)
    a, b = np.nonzero((cosines >= least) & (cosines < least + 0.02))
    if len(a) >= 200:
        few = rng.permutation(len(a))[:TRIED]
        found.append((own[a[few]], own[b[few]]))
    return found


def choose_bits(sample: np.ndarray, least: float, bits: int, tables: int) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """The largest length of a substring, ``bits`` at most, at which ``FOUND`` of each sort of made pairs meet
    in one of the tables, and the rotations for it."""
    length = sample.shape[1]
    pairs = made_pairs(sample, least)
    mean, projections = learn_rotations(sample, -(-tables // (length // bits)))
    for fewer in range(bits, 0, -1):  # shorter substrings need no more rotations
        rotations = mean, projections[: -(-tables // (length // fewer))]
        met = [(substrings(a, *rotations, fewer, tables) == substrings(b, *rotations, fewer, tables)).any(1).mean() for a, b in pairs]
        if min(met, default=1.0) >= FOUND:
            break
    return fewer, rotations


def link_group(
    table: int, vectors: np.ndarray, keys: np.ndarray, weights: np.ndarray, block: np.ndarray, across: bool, least: float
):
    """(links, companion) of each vector: linked copies that meet first in this table, and the
    position of the smallest vector reachable through such links. ``across``: only between blocks."""
    n = len(vectors)
    links, root = np.zeros(n, np.int64), np.arange(n)
    if n < 2 or (table and (keys[:, :table] == keys[0, :table]).all(0).any()):
        return links, root  # nothing to compare, or all of them met before
    firsts, seconds = [], []
    for start in range(0, n, 512):
        near = vectors[start : start + 512] @ vectors.T >= least
        a, b = np.nonzero(near)
        a += start
        fits = (a < b) & (block[a] != block[b] if across else True)
        a, b = a[fits], b[fits]
        for earlier in range(table):
            new = keys[a, earlier] != keys[b, earlier]
            a, b = a[new], b[new]
        firsts.append(a)
        seconds.append(b)
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    links += np.bincount(a, weights[b], n).astype(np.int64) + np.bincount(b, weights[a], n).astype(np.int64)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return links, root


def _valid(rows: DataFrame) -> DataFrame:
    """Adds ``vector``: the embedding as doubles if it can link at all, else NULL."""
    doubles = F.col("embedding").cast("array<double>")
    good = (
        ~F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(doubles, lambda x: x != 0)
    )
    lengths = rows.filter("embedding is not null and size(embedding) > 0").groupBy(F.size("embedding").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    fits = F.size("embedding") == (usual["n"] if usual else -1)
    return rows.withColumn("vector", F.when(fits & good, doubles))


def _matrix(values: pa.Array) -> np.ndarray:
    """Rows of an array of lists of one length, as doubles."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(float)


def codes(vectors: np.ndarray, mean: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """``CODE_BITS`` signs of each vector, or as many as the rotations give, in whole 64-bit words."""
    wanted = projections[: -(-CODE_BITS // vectors.shape[1])]
    signs = np.concatenate([(vectors - mean) @ p >= 0 for p in wanted], 1)[:, :CODE_BITS]
    signs = np.pad(signs, ((0, 0), (0, -signs.shape[1] % 64)))
    return np.packbits(signs, axis=1, bitorder="little").view("<u8")


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of codes."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def farthest_code(sample: np.ndarray, least: float, rotations: tuple[np.ndarray, np.ndarray]) -> int:
    """The Hamming distance within which ``KEPT`` of each sort of made pairs at the least cosine lie."""
    pairs = made_pairs(sample, least)
    distances = [np.quantile(apart(codes(a, *rotations), codes(b, *rotations)), KEPT) for a, b in pairs]
    return int(np.ceil(max(distances, default=CODE_BITS)))


def near_codes(code: np.ndarray, block: np.ndarray, across: bool, farthest: int) -> np.ndarray:
    """Which rows have another one (``across``: of another block) within the distance."""
    some = np.zeros(len(code), bool)
    for start in range(0, len(code) if len(code) > 1 else 0, 256):
        part = slice(start, start + 256)
        near = sum(np.bitwise_count(code[part, None, w] ^ code[None, :, w]).astype(np.int16) for w in range(code.shape[1])) <= farthest
        own = np.arange(len(near))
        near[own, own + start] = False
        if across:
            near &= block[part, None] != block[None, :]
        some[part] |= near.any(1)
    return some


def _by_group(rows: DataFrame, group: list[str], compare, schema: str) -> DataFrame:
    """``compare(rows of a group, its name)`` for every group of rows that lie side by side in their task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back: pa.Table | None = None

        def each(table: pa.Table) -> Iterator[pa.RecordBatch]:
            names = np.stack([table[c].to_numpy() for c in group], 1)
            ends = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), len(names)]
            out = [compare(table.slice(a, b - a), names[a]) for a, b in zip(ends, ends[1:], strict=False) if b - a > 1]
            out = [o for o in out if len(o["idx"])]
            if out:
                yield pa.RecordBatch.from_pydict({c: np.concatenate([o[c] for o in out]) for c in out[0]})

        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            if held_back is not None:
                table = pa.concat_tables([held_back, table])
            names = np.stack([table[c].to_numpy() for c in group], 1)
            last = np.flatnonzero((names != names[-1]).any(1))
            done = int(last[-1]) + 1 if len(last) else 0
            if done:
                yield from each(table.slice(0, done))
            held_back = table.slice(done)  # its group may go on: at most two blocks
        if held_back is not None:
            yield from each(held_back)

    return rows.mapInArrow(work, schema)


def near_duplicates(
    embeddings: DataFrame,
    least: float = LEAST_COSINE,
    bits: int = BITS,
    tables: int = TABLES,
    block: int = BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    spark = embeddings.sparkSession
    rows = _valid(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")).select("vec_id", "vector")
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("idx", F.monotonically_increasing_id()))
    some = hash_sample(classes, F.col("idx"), sample, ["vector"]).select("vector").collect()  # about ``sample`` rows
    learned = np.array([r["vector"] for r in some], float)
    if len(learned):
        learned /= np.linalg.norm(learned, axis=1, keepdims=True)
    length = learned.shape[1] if len(learned) else classes.select(F.max(F.size("vector"))).first()[0] or 1
    bits, rotations = choose_bits(learned.reshape(-1, length), least, min(bits, length), tables)
    held = spark.sparkContext.broadcast((rotations, farthest_code(learned.reshape(-1, length), least, rotations)))
    # Vectors travel as they are stored; four bytes hold a float exactly.
    stored = "array<float>" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "array<double>"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = unit(_matrix(batch["vector"]))
            keys = substrings(vectors, *held.value[0], bits, tables)
            code = pa.array([c.tobytes() for c in codes(vectors, *held.value[0])], pa.binary())
            for t in range(keys.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, t].astype(np.int64) | (t << 32)), batch["idx"], code], ["bucket", "idx", "code"])

    keyed = classes.select("idx", "vector").mapInArrow(index, "bucket long, idx long, code binary")
    # Few buckets are larger than a block, so this join seldom has to move the codes.
    large = keyed.groupBy("bucket").count().filter(F.col("count") > block)
    large = large.select("bucket", F.ceil(F.col("count") / block).alias("blocks"))
    met = keyed.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    met = met.withColumn("mine", F.pmod(F.xxhash64("idx"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")}).drop("blocks", "other")
    group = ["bucket", "lo", "hi"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions, *group).sortWithinPartitions(*group, "mine", "idx")

    def close(part: pa.Table, names: np.ndarray) -> dict[str, np.ndarray]:
        """Rows whose code is near another one's in their group."""
        own, code = part["mine"].to_numpy(), np.frombuffer(b"".join(part["code"].to_pylist()), "<u8").reshape(len(part), -1)
        some = np.flatnonzero(near_codes(code, own, names[1] != names[2], held.value[1]))
        return {c: part[c].to_numpy()[some] for c in (*group, "mine", "idx")}

    def verify(part: pa.Table, names: np.ndarray) -> dict[str, np.ndarray]:
        """Links of a group's vectors, by their cosine."""
        idx, copies, own = (part[c].to_numpy() for c in ("idx", "copies", "mine"))
        vectors = unit(_matrix(part["vector"].combine_chunks()))
        keys = substrings(vectors, *held.value[0], bits, tables)
        links, root = link_group(int(names[0]) >> 32, vectors, keys, copies, own, bool(names[1] != names[2]), least)
        linked = np.flatnonzero(links)
        return {"idx": idx[linked], "links": links[linked], "root": idx[root[linked]]}

    near = _by_group(dealt(met), group, close, "bucket long, lo long, hi long, mine long, idx long")
    # Only vectors with a near code travel.
    fetched = near.join(classes.select("idx", "copies", F.col("vector").cast(stored).alias("vector")), "idx")
    found = cut(_by_group(dealt(fetched), group, verify, "idx long, links long, root long"))
    links = found.groupBy("idx").agg(F.sum("links").alias("links"))
    classed = connected_components(found.select(F.col("idx").alias("a"), F.col("root").alias("b")))
    placed = (
        classes.join(links, "idx", "left")
        .join(classed.withColumnRenamed("node", "idx"), "idx", "left")
        .withColumns({"links": F.coalesce("links", F.lit(0)) + F.col("copies") - 1, "component": F.coalesce("component", "idx")})
    )
    placed = cut(placed)
    least_id = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = attach_by_key(placed.drop("least", "idx"), least_id, "component", "n").drop("component")
    linked = attach_by_key(rows.filter("vector is not null"), named.select("vector", "copies", "links", "component_id"), "vector", "copies")
    alone = rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component_id"))
    whole = linked.select("vec_id", "links", "component_id").unionByName(alone)
    return whole.select("vec_id", F.col("links").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
