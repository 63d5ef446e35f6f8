"""Near copies by the Jaccard similarity of 5-word shingles.

Two texts of similarity 0.8 or more share at least one of ``BANDS`` keys with probability 0.9998: a key
is ``ROWS`` minima of the shingles' hashes under random multiplications, each of which both share with
the probability of their similarity. Candidates are verified exactly on the shingles themselves.

What is asked for are components, so a pair whose ends are linked already needs no look. First every
member of a key is compared with the key's smallest one; where that leaves a key with several
components, all its pairs across components are compared. Keys with many members are dealt out by salts.

Words are those of ``simhash`` (ASCII lower case, ASCII white space). Defined results: a text of one to
four words has one shingle; NULL and empty texts have none and resemble nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.llm.simhash import AT_ONCE, LOWER, SEED
from basketry.operators.scale import attach_by_key
from basketry.session import cut

WORDS = 5
LEAST = (4, 5)  # similarity 0.8 as a fraction
BANDS, ROWS = 16, 4
SALTED = 512  # members of a key that one task compares with the others
_RNG = np.random.default_rng(11)
_TIMES = _RNG.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingles(raw: bytes | None, words: int = WORDS) -> set[bytes]:
    tokens = (raw or b"").translate(LOWER).split()
    if len(tokens) < words:
        return {b" ".join(tokens)} if tokens else set()
    return set(map(b" ".join, zip(*[tokens[k:] for k in range(words)], strict=False)))


def resemble(a: set[bytes], b: set[bytes]) -> bool:
    common = len(a & b)
    return common > 0 and LEAST[1] * common >= LEAST[0] * (len(a) + len(b) - common)


def band_keys(raw: bytes | None) -> np.ndarray:
    """The ``BANDS`` keys of a text, none if it has no words."""
    found = shingles(raw)
    if not found:
        return np.empty(0, np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found))
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    step = AT_ONCE // len(least)
    for first in range(0, len(hashes), step):
        mixed = hashes[None, first : first + step] * _TIMES[:, None] + _PLUS[:, None]
        least = np.minimum(least, mixed.min(1))
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], np.uint64).view(np.int64)


def keys_of(texts: DataFrame) -> DataFrame:
    """(key, hash) of every text of (hash, text)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(t.as_py()) for t in batch[1]]
            hashes = np.repeat(batch[0].to_numpy(), [len(k) for k in keys])
            flat = np.concatenate([np.empty(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(hashes)], ["key", "hash"])

    return texts.select("hash", F.col("text").cast("binary")).mapInArrow(compute, "key long, hash long")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of (a, b, ca, cb) whose texts resemble each other; a and b are hashes."""
    ends = pairs.select(F.col("a").alias("hash")).unionByName(pairs.select(F.col("b").alias("hash"))).distinct()
    wanted = attach_by_key(texts, cut(nodes.join(ends, "hash", "left_semi").select("hash", "n")), "hash", "n")
    wanted = cut(wanted.groupBy("hash").agg(F.min(F.col("text").cast("binary")).alias("text")))
    rows = pairs
    for end in "ba":
        counts = pairs.groupBy(end).agg(F.count("*").alias("_n"))
        rows = attach_by_key(rows, wanted.select(F.col("hash").alias(end), F.col("text").alias(f"t{end}")).join(counts, end), end, "_n")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(64)(shingles)  # a key's smallest member comes again and again
        for batch in batches:
            fits = [resemble(known(a.as_py()), known(b.as_py())) for a, b in zip(batch["ta"], batch["tb"], strict=True)]
            yield batch.drop_columns(["ta", "tb"]).filter(pa.array(fits, pa.bool_()))

    return cut(rows.select("a", "b", "ca", "cb", "ta", "tb").mapInArrow(compute, "a long, b long, ca long, cb long"))


def _mixed(members: DataFrame) -> DataFrame:
    """The rows of (key, hash, component) whose key has several components, with their number, the
    smallest member (first) and the most frequent component (usual) of the key."""
    per = members.groupBy("key", "component").agg(F.min("hash").alias("hash"), F.count("*").alias("n"))
    one = per.groupBy("key").agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds"),
        F.max_by(F.struct("component", "hash"), F.struct("n", "component")).alias("usual"),
    )
    some = cut(one.filter("kinds > 1").select("key", "n", F.col("n").alias("members"), "usual"))
    return cut(attach_by_key(members, some, "key", "n"))


def component_links(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links that join the components of ``nodes`` (hash, component, n) where texts of (hash, text)
    resemble each other. ``n`` is the number of rows of ``texts`` with the hash."""
    held = cut(keys_of(texts).distinct().join(nodes.select("hash", "component"), "hash"))
    mixed = _mixed(held)
    first = mixed.filter("component <> usual.component").select(
        F.col("hash").alias("a"), F.col("usual.hash").alias("b"), F.col("component").alias("ca"), F.col("usual.component").alias("cb")
    )
    first = cut(first.distinct())
    linked = _verified(first, texts, nodes)
    joined = connected_components(linked.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    sizes = mixed.groupBy("component").agg(F.count("*").alias("n"))
    renamed = sizes.join(joined.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    renamed = cut(renamed.withColumn("now", F.coalesce("now", "component")))
    members = attach_by_key(mixed.select("key", "hash", "component"), renamed, "component", "n")
    rest = _mixed(members.select("key", "hash", F.col("now").alias("component")))
    salts = F.ceil(F.col("members") / SALTED)
    minor = rest.filter("component <> usual.component").select(
        "key", F.col("hash").alias("a"), F.col("component").alias("ca"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    )
    others = rest.select("key", F.col("hash").alias("b"), F.col("component").alias("cb"), F.pmod(F.xxhash64("hash"), salts).alias("salt"))
    # A pair is named by its smaller hash first and looked at once.
    across = minor.join(others, ["key", "salt"]).filter("ca <> cb")
    swap = lambda x, y: F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y))
    pairs = across.select(swap("a", "b").alias("a"), swap("b", "a").alias("b"), swap("ca", "cb").alias("ca"), swap("cb", "ca").alias("cb"))
    seen = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verified(cut(pairs.distinct().join(seen, ["a", "b"], "left_anti")), texts, nodes)
    return linked.unionByName(more).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
