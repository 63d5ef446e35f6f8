"""Exact ranked lexical search by sparse ball trees.

A document is the sparse vector of its integer term impacts, a query the vector of its term weights;
the score is their inner product. Every task arranges the documents it reads into ball trees of about
``TREE`` documents. A node knows its documents' centroid c and the largest distance r to it, so no document
below it can score more than q.c + r |q| against the query q. One ball over thousands of terms would be far
too wide for a query of forty, so terms are dealt into ``GROUPS`` groups, the commonest into one of their
own, and a node has a radius per group: a query pays for the groups it has terms in. Subtrees are searched
best first until none can reach the query's k-th best score; documents at the leaves are scored with 64-bit
integers. A task carries its best documents from tree to tree, and the best of all tasks are merged.

Bounds are doubles and err upwards: the squared radius is enlarged by ``SAFE`` of the squared norms it
is the difference of, the bound by ``SAFE`` of itself and by one. Rounding stays below that, so no document is
lost; bounds equal to the k-th score are searched, since a smaller doc_id may win the tie. Vectors are
scaled by the square roots of the weights, which leaves the products as they are and the balls small.

Only terms of queries count in a product, so documents carry no others. Queries are taken in blocks of
about ``BLOCK`` characters, chosen by hash, and every block reads the documents once; what a task holds for the
queries is bounded by the block.

Defined results: NULL and empty texts have no terms and are not found; queries without terms, or whose
terms no document holds, give no rows; repeated rows of documents are ranked one by one, NULL ids after
all others; repeated rows of queries count once, and queries that share an id but not the text are ranked
apart; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.session import stage

BEST = 20
BLOCK = 2_000_000  # characters of queries, about, that are searched at a time
TREE, TREE_ENTRIES = 4096, 1 << 20  # documents and vector entries from which a tree is closed
LEAF = 8  # documents at a leaf at most
PART = 1024  # documents taken up at a time
GROUPS = 2048  # groups of terms that have a radius of their own
SAFE = 1e-9
MERGED = 64  # parts a query's candidates are merged in before they meet
# Letters and digits of ASCII in lower case and all bytes of other characters; anything else parts terms.
TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TERM).split()


@dataclass
class Block:
    """Queries of one pass: the terms' numbers, and per query (item number, {term: repeats})."""

    numbers: dict[bytes, int]
    queries: list[tuple[int, dict[int, int]]]


def term_vectors(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, length, terms, counts): all terms of a document counted, and its query terms by number."""
    held = docs.sparkSession.sparkContext.broadcast(block.numbers)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = held.value
        for batch in batches:
            lengths, terms, counts = [], [], []
            for raw in batch[1]:
                words = terms_of(raw.as_py())
                found = Counter(map(numbers.get, words))
                found.pop(None, None)
                lengths.append(len(words))
                terms.append(list(found))
                counts.append(list(found.values()))
            arrays = [pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch[0], *arrays], ["doc_id", "length", "terms", "counts"])

    rows = docs.select("doc_id", F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, length long, terms array<int>, counts array<long>")


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def term_groups(weights: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The group of every term: half of the groups hold one of the lightest (commonest) terms each."""
    rank = np.argsort(np.argsort(weights, kind="stable"), kind="stable")
    alone = groups // 2
    return np.where(rank < alone, rank, alone + (rank - alone) % (groups - alone))


def _entries(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows of a sparse matrix, and how many each has."""
    first, sizes = start[rows], start[rows + 1] - start[rows]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes), sizes


def _by_column(rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (columns, values) turned: start of every column, row numbers, values."""
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    column = np.concatenate([r[0] for r in rows] or [np.zeros(0, np.int64)])
    by = np.argsort(column, kind="stable")
    values = np.concatenate([r[1] for r in rows] or [np.zeros(0)])
    return np.searchsorted(column[by], np.arange(width + 1)), row[by], values[by]


class BallTree:
    """Documents (``start``, ``terms``, ``impacts``: rows of a sparse matrix) in a binary tree of balls.

    ``groups`` gives every term its group. Documents are kept in the order of the tree, so that a
    node is a range of them.
    """

    def __init__(self, start: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray, groups: np.ndarray, leaf: int = LEAF):
        self.weights, self.groups, self.leaf = weights, groups, leaf
        self.scale = np.sqrt(weights.astype(float))
        self.width = int(groups.max(initial=0)) + 1
        self.order = np.arange(len(start) - 1)
        row = np.repeat(self.order, np.diff(start))
        by = np.argsort(row * self.width + groups[terms], kind="stable")  # a row's entries of one group side by side
        terms, impacts = terms[by], impacts[by]
        self.ranges: list[tuple[int, int]] = []  # documents of a node, from and to
        self.below: list[list[int]] = []  # its two parts, or none
        centres: list[tuple[np.ndarray, np.ndarray]] = []  # (terms, values) of a node
        radii: list[tuple[np.ndarray, np.ndarray]] = []  # (groups, values) of a node
        if len(self.order):
            self._grow(start, terms, impacts * self.scale[terms], centres, radii)
        at, sizes = _entries(start, self.order)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.impacts = terms[at], impacts[at]
        self.centres, self.radii = _by_column(centres, len(weights)), _by_column(radii, self.width)

    def _grow(self, start: np.ndarray, terms: np.ndarray, scaled: np.ndarray, centres: list, radii: list):
        open_ = [(0, len(self.order), -1)]
        while open_:
            low, high, above = open_.pop()
            number = len(self.ranges)
            if above >= 0:
                self.below[above].append(number)
            rows = self.order[low:high]
            n = len(rows)
            at, sizes = _entries(start, rows)
            values, row = scaled[at], np.repeat(np.arange(n), sizes)
            own, place = np.unique(terms[at], return_inverse=True)
            centre = np.bincount(place, values, len(own)) / n
            here, group = centre[place], self.groups[terms[at]]
            # Cells: a document's entries of one group. Elsewhere it is as far off as the centroid is long.
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (group[1:] != group[:-1]))[: len(row)])
            cell_row, cell_group = row[first], group[first]
            norm, close, shared = (np.add.reduceat(v, first) for v in (values * values, (values - here) ** 2, here * here))
            long = np.bincount(self.groups[own], centre * centre, self.width)
            away = close + np.maximum(long[cell_group] - shared, 0.0) + SAFE * (norm + long[cell_group])
            widest = np.zeros(self.width)
            np.maximum.at(widest, cell_group, away)
            absent = np.bincount(cell_group, minlength=self.width) < n
            widest[absent] = np.maximum(widest, long * (1 + SAFE))[absent]
            some = np.flatnonzero(widest)
            self.ranges.append((low, high))
            self.below.append([])
            centres.append((own, centre))
            radii.append((some, np.sqrt(widest[some])))
            if n <= self.leaf:
                continue
            # The document farthest from the centroid, and the one farthest from that, part the others.
            far = np.bincount(cell_row, away - long[cell_group], n)
            norm, products = np.bincount(row, values * values, n), []
            for _ in range(2):
                end = int(far.argmax())
                pivot = np.bincount(place[row == end], values[row == end], len(own))
                products.append(np.bincount(row, values * pivot[place], n))
                far = norm + norm[end] - 2 * products[-1]
            self.order[low:high] = rows[np.argsort(products[1] - products[0], kind="stable")]
            middle = (low + high) // 2
            open_ += [(middle, high, number), (low, middle, number)]

    def bounds(self, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What no document below a node can exceed: q.c and, group by group, r |q|."""
        asked = times * self.scale[terms]
        norms = np.sqrt(np.bincount(self.groups[terms], asked * asked, self.width))
        used = np.flatnonzero(norms)
        total = np.zeros(len(self.ranges))
        for (first, nodes, values), columns, factors in ((self.centres, terms, asked), (self.radii, used, norms[used])):
            at, sizes = _entries(first, columns)
            total += np.bincount(nodes[at], values[at] * np.repeat(factors, sizes), len(total))
        return total * (1 + SAFE) + 1

    def search(self, query: dict[int, int], best: list[tuple[int, float]], ids: np.ndarray, keep: int, exact: np.ndarray) -> int:
        """Adds the query's best documents to the heap ``best`` of (score, -id); how many were scored.

        ``exact`` holds a zero per term, and is left that way.
        """
        if not len(self.order):
            return 0
        terms = np.fromiter(query, np.int64, len(query))
        times = np.fromiter(query.values(), np.int64, len(query))
        bounds = self.bounds(terms, times).tolist()
        exact[terms] = times * self.weights[terms]
        scored, open_ = 0, [(-bounds[0], 0)]
        while open_:
            most, node = heapq.heappop(open_)
            if len(best) == keep and -most < best[0][0]:
                break
            if self.below[node]:
                for child in self.below[node]:
                    if len(best) < keep or bounds[child] >= best[0][0]:
                        heapq.heappush(open_, (-bounds[child], child))
                continue
            low, high = self.ranges[node]
            first, last = self.start[low], self.start[high]
            sums = np.concatenate([[0], np.cumsum(self.impacts[first:last] * exact[self.terms[first:last]])])
            ends = sums[self.start[low : high + 1] - first]
            scores = ends[1:] - ends[:-1]
            scored += high - low
            for i in np.flatnonzero(scores >= (max(best[0][0], 1) if len(best) == keep else 1)):
                found = (int(scores[i]), ids[self.order[low + i]])
                if len(best) < keep:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        exact[terms] = 0
        return scored


class Shelf:
    """A task's documents: collects vectors until a tree is full, searches it, and goes on with the best so far."""

    def __init__(self, block: Block, weights: np.ndarray, documents: int, total: int, keep: int):
        self.block, self.weights, self.documents, self.total, self.keep = block, weights, documents, total, keep
        self.groups = term_groups(weights)
        self.best: list[list] = [[] for _ in block.queries]
        self.exact = np.zeros(len(weights), np.int64)
        self.scored = 0
        self._forget()

    def _forget(self):
        self.ids, self.lengths, self.sizes, self.terms, self.counts, self.held, self.entries = [], [], [], [], [], 0, 0

    def add(self, batch: pa.RecordBatch):
        sizes = np.diff(batch["terms"].offsets.to_numpy())  # of the slice
        self.ids.append(np.array([-math.inf if d is None else -d for d in batch["doc_id"].to_pylist()], object))
        self.lengths.append(batch["length"].to_numpy())
        self.sizes.append(sizes)
        self.terms.append(batch["terms"].flatten().to_numpy())
        self.counts.append(batch["counts"].flatten().to_numpy())
        self.entries += int(sizes.sum())
        self.held += len(sizes)
        if self.held >= TREE or self.entries >= TREE_ENTRIES:
            self.search()

    def search(self):
        if not self.ids:
            return
        lengths, sizes, counts = (np.concatenate(x).astype(np.int64) for x in (self.lengths, self.sizes, self.counts))
        level = 75 + 25 * lengths * self.documents // self.total
        impacts = 1_000_000_000 * counts // (1000 * counts + 12 * np.repeat(level, sizes))
        ids = np.concatenate(self.ids)
        tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(self.terms).astype(np.int64), impacts, self.weights, self.groups)
        self._forget()
        for (_, query), best in zip(self.block.queries, self.best, strict=True):
            self.scored += tree.search(query, best, ids, self.keep, self.exact)


def _search_block(docs: DataFrame, block: Block, keep: int) -> DataFrame:
    """(number, doc_id, score): the best documents of every query, at least ``keep`` over all tasks."""
    spark = docs.sparkSession
    vectors = stage(term_vectors(docs, block), "terms")
    sums = vectors.agg(F.count_if(F.col("length") > 0).alias("documents"), F.sum("length").alias("total")).first()
    documents, total = sums["documents"], sums["total"] or 0
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(block.numbers), np.int64)
    for r in holding.collect():  # one row per query term of the block
        weights[r["term"]] = term_weight(documents, r["count"])
    held = spark.sparkContext.broadcast((block, weights))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = Shelf(*held.value, documents, total, keep)
        for batch in batches:
            for first in range(0, len(batch), PART):
                shelf.add(batch.slice(first, PART))
        shelf.search()
        found = [(q, i, score) for (q, _), best in zip(shelf.block.queries, shelf.best, strict=True) for score, i in best]
        arrays = [
            pa.array([f[0] for f in found], pa.int64()),
            pa.array([None if f[1] == -math.inf else -f[1] for f in found], pa.int64()),
            pa.array([f[2] for f in found], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["number", "doc_id", "score"])

    rows = vectors.filter(F.size("terms") > 0).select(F.col("doc_id").cast("long"), "length", "terms", "counts")
    return rows.mapInArrow(compute, "number long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, keep: int = BEST, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``keep`` best of (doc_id, text) for every (item_id, text)."""
    spark = docs.sparkSession
    asked = items.select("item_id", "text").distinct().filter("text is not null")
    number = F.xxhash64("item_id", "text")
    size = asked.agg(F.sum(F.length("text") + F.coalesce(F.length(F.col("item_id").cast("string")), F.lit(4)) + 16).alias("size")).first()["size"]
    parts = -(-(size or 0) // block)
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in range(parts):
        rows = asked.filter(F.pmod(number, F.lit(parts)) == part).collect()  # about ``block`` characters
        numbers: dict[bytes, int] = {}
        queries = []
        for i, row in enumerate(rows):
            words = Counter(terms_of(row["text"].encode()))
            if words:
                queries.append((i, {numbers.setdefault(w, len(numbers)): n for w, n in words.items()}))
        if not queries:
            continue
        found = _search_block(docs, Block(numbers, queries), keep)
        first = [F.desc("score"), F.asc_nulls_last("doc_id")]
        merged = W.partitionBy("number", "part").orderBy(*first)
        ranked = W.partitionBy("number").orderBy(*first)
        some = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGED)))
        some = some.withColumn("rank", F.row_number().over(merged)).filter(F.col("rank") <= keep).drop("rank", "part")
        best = some.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= keep)
        names = spark.createDataFrame([(i, rows[i]["item_id"]) for i, _ in queries], f"number long, item_id {kind}")
        out = out.unionByName(best.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    return out
