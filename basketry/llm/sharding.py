"""K-d tree partitioning of documents into shards of nearly equal bytes (DataFrame functions only).

The tree splits the node with ``k`` leaves at the weighted median of its widest metadata dimension:
``k // 2`` leaves' share of the bytes goes left. A level of the tree takes one aggregate over narrow rows (no
text): sums of bytes between the keys that a size-weighted sample proposes near the median of every
node; the proposed key nearest to the median by the sums over all rows is the cut. Tables of fewer rows
than the sample are cut exactly. The whole tree is at most ``shards - 1`` cuts in literal arrays, so that it
is applied to any table as one projection without a shuffle.

Defined results: a NULL text weighs the overhead only; NULL metadata sorts first; ties on the split
dimension are cut by (text checksum, doc_id), so that equal texts part only where a cut falls
inside their group; rows equal in all of these share a shard; an empty table gives no rows. Only
the named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.scale import running_totals
from basketry.session import cut

OVERHEAD = 16  # bytes a document takes besides its text
CODES = float(2**32)


@dataclass(frozen=True)
class Cut:
    """An inner node: documents whose (value, checksum, id) is at most ``at`` go left."""

    first: int  # smallest shard below this node
    leaves: int
    dimension: int
    at: tuple[float, int, int] | None  # None: nothing goes left


Tree = dict[tuple[int, int], Cut]  # by (first, leaves)


def _code(column: str) -> Column:
    """A category as a number in [0, 1]; NULL before all others."""
    return F.coalesce(F.crc32(F.col(column)) / CODES, F.lit(-0.1))


def metadata(docs: DataFrame, *more: str) -> DataFrame:
    """Narrow rows: id, size, text checksum and the split dimensions (and ``more`` columns)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + OVERHEAD
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.array(_code("source"), _code("lang"), F.log2(size.cast("double"))).alias("dims"),
        *more,
    )


DIMENSIONS = 3  # length of dims
SAMPLE = 16_384  # rows, about, that say where to look for cuts; chances are in proportion to sizes
CUTS = 63  # keys of a node whose sums are taken over all rows
FIRST = -(2**63)  # stands for a NULL id


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(FIRST))


def _numbers(values, kind: str) -> Column:
    """A literal array in one expression."""
    written = ["double('Infinity')" if v == float("inf") else "double('-Infinity')" if v == -float("inf") else f"{v!r}{kind}" for v in values]
    return F.expr(f"array({', '.join(written)})")


def _keys(keys: list[tuple[float, int, int]]) -> Callable[[Column], Column]:
    """The key at a place of a fixed list."""
    value, crc, doc = (_numbers([k[i] for k in keys], kind) for i, kind in enumerate("DLL"))
    return lambda at: F.struct(F.get(value, at).alias("v"), F.get(crc, at).alias("text_crc32"), F.get(doc, at).alias("i"))


def _key(dimension: Column) -> Column:
    return F.struct(F.get("dims", dimension).alias("v"), F.col("text_crc32"), _id().alias("i"))


def _nodes(tree: Tree, shards: int) -> list[tuple[int, int]]:
    """All nodes from the root down, each before those below it."""
    nodes = [(0, shards)]
    for first, leaves in nodes:
        if (first, leaves) in tree:
            half = leaves // 2
            nodes += [(first, half), (first + half, leaves - half)]
    return nodes


def node_of(tree: Tree, shards: int) -> Column:
    """The place in ``_nodes`` of the node a row reaches: arrays are looked up, one step a level."""
    nodes = _nodes(tree, shards)
    place = {n: i for i, n in enumerate(nodes)}
    below = [(first, leaves // 2) if (first, leaves) in tree else (first, leaves) for first, leaves in nodes]
    beside = [(first + leaves // 2, leaves - leaves // 2) if (first, leaves) in tree else (first, leaves) for first, leaves in nodes]
    left, right = (_numbers([place[n] for n in side], "") for side in (below, beside))
    cuts = [tree[n].at if n in tree else None for n in nodes]
    at = _keys([c or (-float("inf"), 0, 0) for c in cuts])
    dimension = _numbers([tree[n].dimension if n in tree else 0 for n in nodes], "")
    levels, depth = shards, 0
    while levels > 1:
        levels, depth = levels - levels // 2, depth + 1
    here = lambda node: _key(F.get(dimension, node)) <= at(node)
    step = lambda node, _: F.when(here(node), F.get(left, node)).otherwise(F.get(right, node))
    return F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), step)


def shard_of(tree: Tree, shards: int) -> Column:
    return F.get(_numbers([first for first, _ in _nodes(tree, shards)], ""), node_of(tree, shards))


def _ends() -> list[Column]:
    return [f(F.get("dims", F.lit(i))).alias(f"{n}{i}") for i in range(DIMENSIONS) for n, f in (("lo", F.min), ("hi", F.max))]


def _candidates(sample: list[tuple], dimension: int, share: float) -> list[tuple[float, int, int]]:
    """Up to ``CUTS`` sampled keys around the sample's weighted median, dense near it and sparse far off."""
    ordered = sorted(((dims[dimension], crc, doc), weight) for dims, crc, doc, weight in sample)
    target, running, middle = share * sum(w for _, w in ordered), 0.0, 0
    for middle, (_, weight) in enumerate(ordered):
        running += weight
        if running >= target:
            break
    half = CUTS // 2
    reach = max(half, 5 * math.isqrt(len(ordered)) + 1)
    steps = {max(j, round(reach * (j / half) ** 2)) for j in range(1, half + 1)}
    places = sorted({middle, *(middle + s for s in steps), *(middle - s for s in steps)})
    return [ordered[i][0] for i in places if 0 <= i < len(ordered)]


def grow_tree(rows: DataFrame, shards: int) -> Tree:
    """The cuts of all levels. ``rows``: as from ``metadata``, cheap to read several times.

    A level is one aggregate of all rows by (node, range between candidate keys); it gives the cut with
    the exact bytes on both sides and how far the parts spread. A sample only says which keys to try. The
    driver holds the sample and at most ``CUTS`` + 1 rows a node.
    """
    tree: Tree = {}
    whole = rows.agg(F.sum("size").alias("size"), *_ends()).first()
    if not whole["size"]:
        return tree
    unit = whole["size"] / SAMPLE
    chosen = F.pmod(F.xxhash64("text_crc32", "doc_id", "size"), F.lit(2**31)) < F.col("size") * (2**31 / unit)
    weight = F.sum(F.greatest(F.col("size").cast("double"), F.lit(unit))).alias("weight")
    drawn = rows.filter(chosen).groupBy("dims", "text_crc32", _id().alias("i")).agg(weight).collect()
    sample = [(tuple(r["dims"]), r["text_crc32"], r["i"], r["weight"]) for r in drawn]
    spans = [(whole[f"hi{i}"] - whole[f"lo{i}"]) or 1.0 for i in range(DIMENSIONS)]
    open_ = {(0, shards): (sample, [whole])} if shards > 1 else {}
    while open_:
        nodes = _nodes(tree, shards)
        widest, cuts, shares = {}, {}, {}
        for (first, leaves), (own, parts) in open_.items():
            widths = [(max(p[f"hi{i}"] for p in parts) - min(p[f"lo{i}"] for p in parts)) / spans[i] if parts else 0.0 for i in range(DIMENSIONS)]
            widest[first] = max(range(DIMENSIONS), key=lambda i: (widths[i], -i))
            shares[first] = (leaves // 2) / leaves
            cuts[first] = _candidates(own, widest[first], shares[first])
        places = {n: i for i, n in enumerate(open_)}
        open_at = F.get(_numbers([places.get(n, -1) for n in nodes], ""), node_of(tree, shards))
        dimension = F.get(_numbers([widest[first] for first, _ in open_], ""), F.col("node"))
        padded = [k for first, _ in open_ for k in cuts[first] + [(float("inf"), 0, 0)] * (CUTS - len(cuts[first]))]
        key_at = _keys(padded)
        key = _key(dimension)
        below = lambda at, step: key_at(F.col("node") * CUTS + at + step - 1) < key  # noqa: E731, B023
        halving = F.expr(f"array({', '.join(str(2**i) for i in reversed(range(CUTS.bit_length())))})")
        place = F.aggregate(halving, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))
        placed = rows.withColumn("node", open_at).filter("node >= 0").withColumn("range", place)
        found: dict[int, list] = {}
        for r in placed.groupBy("node", "range").agg(F.sum("size").alias("size"), *_ends()).collect():
            found.setdefault(r["node"], []).append(r)
        following = {}
        for (first, leaves), (own, _) in open_.items():
            ranges = sorted(found.get(places[first, leaves], []), key=lambda r: r["range"])
            target = shares[first] * sum(r["size"] for r in ranges)
            best, running, at = target, 0, None  # nothing to the left
            sums = {r["range"]: r["size"] for r in ranges}
            for i, cut_key in enumerate(cuts[first]):
                running += sums.get(i, 0)
                if running and abs(running - target) <= best:
                    best, at = abs(running - target), (i, cut_key)
            d = widest[first]
            tree[first, leaves] = Cut(first, leaves, d, at and at[1])
            half = leaves // 2
            goes_left = [at is not None and (s[0][d], s[1], s[2]) <= at[1] for s in own]
            for child, side in (((first, half), True), ((first + half, leaves - half), False)):
                if child[1] > 1:
                    rest = [s for s, g in zip(own, goes_left, strict=True) if g is side]
                    following[child] = (rest, [r for r in ranges if (at is not None and r["range"] <= at[0]) is side])
        open_ = following
    return tree


def assign_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in its shard).

    Give the number of shards, or the bytes a shard should hold.
    """
    rows = cut(metadata(docs))
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = rows.select("doc_id", "size", "text_crc32", shard_of(grow_tree(rows, shards), shards).alias("shard"))
    numbered = running_totals(
        placed, {"id": F.coalesce("doc_id", F.lit(-(2**63))), "crc": F.col("text_crc32"), "size": F.col("size")}, {"n": F.lit(1)}, group=["shard"]
    )
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("n_running") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int) -> None:
    """Write the documents themselves, one folder per shard; the tree is applied in the scan."""
    tree = grow_tree(cut(metadata(docs)), shards)
    whole = docs.select(F.struct("*").alias("row"))
    narrow = metadata(whole.select("row", "row.doc_id", "row.text", "row.source", "row.lang"), "row")
    narrow.select(shard_of(tree, shards).alias("shard"), "row").write.partitionBy("shard").parquet(path)
