"""Density clustering (DBSCAN) without comparing all pairs of points.

Space is cut into cells whose diagonal is just below ``eps``. A cell with ``min_samples`` points is
*dense*: all its points are core points of one cluster, and no pair inside it is ever formed. Only
points of sparse cells (fewer than ``min_samples`` per cell) look for neighbours one by one. A dense
cell is searched through its bounding boxes: boxes fully inside or outside the radius are decided
at once and only boxes that straddle it are halved again, until every box is decided, at the latest
when it holds a single point. The result is exact. Clusters are the connected cells.
"""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.scale import running_totals
from basketry.operators.segmentation import NOISE, as_vectors
from basketry.session import cut


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _squared(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def _gap(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """Smallest squared distance between two boxes."""
    apart = F.zip_with(
        F.zip_with(lo_b, hi_a, lambda lo, hi: lo - hi),
        F.zip_with(lo_a, hi_b, lambda lo, hi: lo - hi),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return _sum(F.transform(apart, lambda v: v * v))


def _reach(lo: Column, hi: Column, point: Column) -> Column:
    """Largest squared distance between a point and a box."""
    far = F.zip_with(
        F.zip_with(point, lo, lambda p, b: F.abs(p - b)),
        F.zip_with(point, hi, lambda p, b: F.abs(p - b)),
        lambda x, y: F.greatest(x, y),
    )
    return _sum(F.transform(far, lambda v: v * v))


class _Grid:
    """Cells of one (points, eps, min_samples) problem."""

    def __init__(self, points: DataFrame, id_col: str, columns: tuple[str, ...], eps: float, min_samples: int):
        self.d, self.eps2, self.min_samples = len(columns), eps * eps, min_samples
        self.side = eps / math.sqrt(self.d) * (1 - 1e-9)
        distinct = (
            points.groupBy(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
            .agg(F.count("*").alias("w"), F.min(id_col).alias("first_id"))
            .withColumn("cell", self.key(F.col("x"), 0))
        )
        distinct = cut(distinct)
        sizes = distinct.groupBy("cell").agg(F.sum("w").alias("cell_w"))
        tagged = cut(distinct.join(sizes, "cell"))
        self.sparse = tagged.filter(F.col("cell_w") < min_samples)
        self.dense = tagged.filter(F.col("cell_w") >= min_samples)

    def key(self, x: Column, level: int) -> Column:
        return F.transform(x, lambda v: F.floor(v * (2.0**level / self.side)))

    def boxes(self, level: int) -> DataFrame:
        """Bounding boxes of the dense points; children of one parent share its key."""
        key = self.key(F.col("x"), level)
        at = [F.get("x", F.lit(i)) for i in range(self.d)]
        return (
            self.dense.groupBy(key.alias("box"))
            .agg(
                F.array(*[F.min(v) for v in at]).alias("lo"),
                F.array(*[F.max(v) for v in at]).alias("hi"),
                F.min("x").alias("member"),
                F.sum("w").alias("box_w"),
            )
            .withColumn("parent", F.transform("box", lambda v: F.floor(v / 2)))
        )

    def around(self, cell: Column, half: bool = False) -> Column:
        """Other cells that can hold a point within eps; ``half`` names every pair once."""
        zero = (0,) * self.d
        reach = math.ceil(math.sqrt(self.d))
        offsets = [
            o
            for o in itertools.product(range(-reach, reach + 1), repeat=self.d)
            if o != zero and (not half or o > zero) and sum(max(abs(v) - 1, 0) ** 2 for v in o) <= self.d
        ]
        table = F.expr(f"array({', '.join(f'array{o}' for o in offsets)})")
        return F.explode(F.transform(table, lambda o: F.zip_with(cell, o, lambda c, v: c + v)))


def _points_to_cells(grid: _Grid) -> DataFrame:
    """(x, cell, root, w): weight of the points of dense cell ``root`` near a sparse point."""
    frontier = (
        grid.sparse.select("x", "cell", grid.around(F.col("cell")).alias("root"))
        .withColumn("box", F.col("root"))
        .join(grid.boxes(0).drop("parent"), "box")
    )
    found, level = [], 0
    while True:
        near = frontier.withColumn("far2", _reach(F.col("lo"), F.col("hi"), F.col("x"))).filter(
            _gap(F.col("lo"), F.col("hi"), F.col("x"), F.col("x")) <= grid.eps2
        )
        near = cut(near.select("x", "cell", "root", "box", "box_w", "far2"))
        inside = near.filter(F.col("far2") <= grid.eps2)
        found.append(inside.groupBy("x", "cell", "root").agg(F.sum("box_w").alias("w")))
        open_ = near.filter(F.col("far2") > grid.eps2)
        # A point that already sees min_samples points of a cell needs no more of that cell.
        settled = found[-1].filter(F.col("w") >= grid.min_samples).select("x", "root")
        open_ = open_.join(settled, ["x", "root"], "left_anti")
        if open_.isEmpty():
            break
        level += 1
        frontier = open_.select("x", "cell", "root", F.col("box").alias("parent")).join(
            grid.boxes(level), "parent"
        )
    return reduce(DataFrame.unionByName, found).groupBy("x", "cell", "root").agg(F.sum("w").alias("w"))


def _dense_pairs(grid: _Grid) -> DataFrame:
    """(a, b): neighbouring dense cells with two points within eps."""

    def side(boxes: DataFrame, suffix: str) -> DataFrame:
        return boxes.select(*[F.col(c).alias(c + suffix) for c in ("box", "lo", "hi", "member", "parent")])

    level = 0
    roots = grid.boxes(0)
    frontier = (
        side(roots, "_a")
        .withColumn("box_b", grid.around(F.col("box_a"), half=True))
        .join(side(roots, "_b").drop("parent_b"), "box_b")
        .withColumns({"a": F.col("box_a"), "b": F.col("box_b")})
    )
    found = []
    while True:
        close = _gap(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b")) <= grid.eps2
        near = frontier.filter(close).withColumn(
            "linked", _squared(F.col("member_a"), F.col("member_b")) <= grid.eps2
        )
        near = cut(near.select("a", "b", "box_a", "box_b", "linked"))
        found.append(near.filter("linked").select("a", "b").distinct())
        open_ = near.filter("NOT linked").join(found[-1], ["a", "b"], "left_anti")
        if open_.isEmpty():
            break
        level += 1
        boxes = grid.boxes(level)
        frontier = (
            open_.select("a", "b", F.col("box_a").alias("parent_a"), F.col("box_b").alias("parent_b"))
            .join(side(boxes, "_a"), "parent_a")
            .join(side(boxes, "_b"), "parent_b")
        )
    return reduce(DataFrame.unionByName, found)


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id of every component: (id, label).

    Labels hook onto smaller neighbouring labels and then jump to the label of their label.
    """
    both = cut(edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut(nodes.select("id", F.col("id").alias("label")))
    total = None
    while True:
        seen = both.join(labels.select(F.col("id").alias("src"), F.col("label").alias("own")), "src").join(
            labels.select(F.col("id").alias("dst"), F.col("label").alias("other")), "dst"
        )
        offers = F.explode(F.array("src", "own")).alias("id")
        best = seen.select(offers, "other").groupBy("id").agg(F.min("other").alias("offer"))
        hooked = labels.join(best, "id", "left").select("id", F.least("label", "offer").alias("label"))
        jumped = hooked.join(
            hooked.select(F.col("id").alias("label"), F.col("label").alias("next")), "label"
        )
        labels = cut(jumped.select("id", F.col("next").alias("label")))
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now


def dbscan(
    points: DataFrame, id_col: str, columns: tuple[str, ...], eps: float, min_samples: int = 10
) -> DataFrame:
    """(id, cluster): clusters numbered by their smallest core id, noise is -1.

    A border point joins the lowest-numbered cluster within reach.
    """
    grid = _Grid(points, id_col, columns, eps, min_samples)
    to_cells = cut(_points_to_cells(grid))
    # Sparse cells hold fewer than min_samples points, so a point meets a bounded number of others.
    others = grid.sparse.select(F.col("cell").alias("root"), F.col("x").alias("y"), F.col("w").alias("y_w"))
    to_points = cut(
        grid.sparse.select("x", "cell", grid.around(F.col("cell")).alias("root"))
        .join(others, "root")
        .filter(_squared(F.col("x"), F.col("y")) <= grid.eps2)
    )
    near = (
        to_cells.select("x", "w")
        .unionByName(to_points.select("x", F.col("y_w").alias("w")))
        .groupBy("x")
        .agg(F.sum("w").alias("near_w"))
    )
    enough = F.col("cell_w") + F.coalesce("near_w", F.lit(0)) >= min_samples
    sparse = cut(grid.sparse.join(near, "x", "left").withColumn("is_core", enough))
    sparse_core = sparse.filter("is_core")

    cores = (
        grid.dense.select("cell", "first_id")
        .unionByName(sparse_core.select("cell", "first_id"))
        .groupBy("cell")
        .agg(F.min("first_id").alias("id"))
    )
    cores = cut(cores)
    core_x = sparse_core.select("x")
    core_y = sparse_core.select(F.col("x").alias("y"))
    cell_links = (
        _dense_pairs(grid)
        .unionByName(to_cells.join(core_x, "x", "left_semi").select(F.col("cell").alias("a"), F.col("root").alias("b")))
        .unionByName(
            to_points.join(core_x, "x", "left_semi")
            .join(core_y, "y", "left_semi")
            .select(F.col("cell").alias("a"), F.col("root").alias("b"))
        )
        .distinct()
    )
    edges = cell_links.join(cores.select(F.col("cell").alias("a"), F.col("id").alias("src")), "a").join(
        cores.select(F.col("cell").alias("b"), F.col("id").alias("dst")), "b"
    )
    labels = connected(cores, edges.select("src", "dst"))
    numbered = running_totals(
        labels.select("label").distinct(), {"label": F.col("label")}, {"n": F.lit(1).cast("long")}
    ).select("label", (F.col("n_running") - 1).cast("int").alias("cluster"))
    cell_cluster = cut(
        cores.join(labels, "id").join(numbered, "label").select("cell", "cluster")
    )

    reached = (
        to_cells.select("x", "root")
        .unionByName(to_points.join(core_y, "y", "left_semi").select("x", "root"))
        .unionByName(sparse.filter("NOT is_core").select("x", F.col("cell").alias("root")))
        .distinct()
        .join(cell_cluster.withColumnRenamed("cell", "root"), "root")
        .groupBy("x")
        .agg(F.min("cluster").alias("reached"))
    )
    border = sparse.filter("NOT is_core").join(reached, "x", "left")
    by_x = (
        grid.dense.select("x", "cell")
        .unionByName(sparse_core.select("x", "cell"))
        .join(cell_cluster, "cell")
        .select("x", "cluster")
        .unionByName(border.select("x", F.coalesce("reached", F.lit(NOISE)).alias("cluster")))
    )
    located = points.select(id_col, F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    return cut(located.join(by_x, "x").select(id_col, "cluster"))


def sweep_eps(
    points: DataFrame,
    id_col: str,
    columns: tuple[str, ...],
    eps_values: list[float],
    min_samples: int = 10,
    parallelism: int = 6,
) -> DataFrame:
    """Clusters, noise and silhouette of the non-noise points per eps."""

    def measure(eps: float) -> tuple:
        labelled = dbscan(points, id_col, columns, eps, min_samples)
        n, noise, clusters = labelled.agg(
            F.count("*"),
            F.count_if(F.col("cluster") == NOISE),
            F.countDistinct(F.when(F.col("cluster") != NOISE, F.col("cluster"))),
        ).first()
        silhouette = None
        if clusters >= 2 and n - noise > clusters:
            kept = as_vectors(points.join(labelled.filter(F.col("cluster") != NOISE), id_col), columns)
            silhouette = ClusteringEvaluator(predictionCol="cluster").evaluate(kept)
        return float(eps), clusters, noise, noise / n * 100 if n else None, silhouette

    with ThreadPoolExecutor(parallelism) as pool:  # independent radii share the cluster
        rows = list(pool.map(measure, eps_values))
    schema = "eps double, n_clusters long, n_noise long, noise_pct double, silhouette double"
    return points.sparkSession.createDataFrame(rows, schema)
