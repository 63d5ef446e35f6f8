"""Scaled customer features, k-means sweep and choice, cluster naming, validity and projection."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.expressions import octant_label
from basketry.operators.rfm import METRICS
from basketry.session import cut

SCALED = tuple(f"{c}_scaled" for c in METRICS)
NOISE = -1
MAX_ITER, TOLERANCE = 300, 1e-4  # iterations at most, and the squared movement of a center that counts as rest
SEED_PASSES = 2  # k-means|| passes over all rows before the first iteration
PARALLEL = 4  # starts side by side; each keeps two numbers a row
TASK_ROWS = 200_000  # rows of one task in a fit, about
# Qualifiers for clusters that share a base name, by falling monetary mean.
QUALIFIERS = ("premium", "core", "emerging", "marginal")


def scaled_rfm(rfm: DataFrame) -> DataFrame:
    """log1p, then standardized by the mean and population deviation of the whole table."""
    logged = rfm.withColumns({f"_log_{c}": F.log1p(F.col(c).cast("double")) for c in METRICS})
    moments = logged.agg(
        F.struct(
            *[
                F.struct(F.avg(f"_log_{c}").alias("mean"), F.stddev_pop(f"_log_{c}").alias("std")).alias(c)
                for c in METRICS
            ]
        )
    ).scalar()

    def standard(c: str) -> Column:
        spread = F.when(F.col(f"_m.{c}.std") == 0, 1.0).otherwise(F.col(f"_m.{c}.std"))
        return (F.col(f"_log_{c}") - F.col(f"_m.{c}.mean")) / spread

    return (
        logged.withColumn("_m", moments)
        .withColumns({f"{c}_scaled": standard(c) for c in METRICS})
        .select(*rfm.columns, *SCALED)
    )


def as_vectors(scaled: DataFrame, columns: tuple[str, ...] = SCALED) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(scaled)


@dataclass(frozen=True)
class Centers:
    """A k-means fit: its centers, the sum of squared distances, and the iterations it took."""

    centers: np.ndarray
    cost: float
    iterations: int

    def assign(self, rows: DataFrame, columns: tuple[str, ...] = SCALED, name: str = "cluster") -> DataFrame:
        """The nearest center of every row, the smaller number on a tie."""

        def squared(center) -> Column:
            terms = [(F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(columns, center, strict=True)]
            return sum(terms[1:], terms[0])

        nearest = F.array_min(F.array(*[F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(self.centers)]))
        return rows.withColumn(name, nearest["i"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of rows as one binary block, coordinate by coordinate."""
    for batch in batches:
        if batch.num_rows:
            block = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)
            if np.isnan(block).any():
                raise ValueError("NULL or NaN among the values to cluster")
            yield pa.RecordBatch.from_pydict({"block": pa.array([block.tobytes()], pa.binary())})


def _nearest(block: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The number of the nearest center of every point (a column of ``block``), the smaller one on a tie."""
    far = (-2 * centers) @ block  # squared distances, less what all centers have in common
    far += (centers * centers).sum(1)[:, None]
    label, least = np.zeros(block.shape[1], dtype=np.intp), far[0]
    for j in range(1, len(centers)):
        np.putmask(label, far[j] < least, j)
        np.minimum(least, far[j], out=least)
    return label


def _sums(blocks: Iterator[np.ndarray], fits: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Points and sums of coordinates by nearest center, for the centers of all fits one below the other."""
    out = [np.zeros((len(c), 1 + c.shape[1])) for c in fits]
    for block in blocks:
        for total, centers in zip(out, fits, strict=True):
            label = _nearest(block, centers)
            for column, weights in enumerate([None, *block]):
                total[:, column] += np.bincount(label, weights, len(centers))
    yield np.concatenate(out)


def _costs(blocks: Iterator[np.ndarray], fits: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The sum of squared distances to the nearest center, by fit."""
    out = np.zeros(len(fits))
    for block in blocks:
        for i, centers in enumerate(fits):
            apart = block - centers.T[:, _nearest(block, centers)]
            out[i] += (apart * apart).sum()
    yield out


def fit_starts(
    rows: DataFrame, jobs: list[tuple[int, int]], columns: tuple[str, ...] = SCALED,
    max_iter: int = MAX_ITER, tolerance: float = TOLERANCE, parallelism: int = PARALLEL,
) -> dict[tuple[int, int], Centers]:
    """A fit of every (k, seed) pair.

    First centers come from MLlib's k-means|| passes over all rows: each pass draws rows with a chance that
    grows with their distance to the centers so far, so a small group far from the others is met however
    many rows there are. The iterations of all fits then share their passes: one job moves the centers of every
    fit that is not at rest, over blocks of rows that are packed once. Only sums per center reach the driver.
    Rests, empty clusters and costs are as in MLlib's ``KMeans``. ``rows`` should be cached or checkpointed.
    """
    spark = rows.sparkSession
    points = rows.select([F.col(c).cast("double").alias(c) for c in columns])
    size = points.count()
    if not size:
        raise ValueError("no rows to cluster")
    packed = points.repartition(max(1, -(-size // TASK_ROWS))).mapInArrow(_packed, "block binary")
    n = len(columns)
    blocks = packed.rdd.map(lambda row: np.frombuffer(row["block"]).reshape(n, -1)).persist(StorageLevel.MEMORY_AND_DISK)
    # Deserialized in the JVM once, since each start reads all of them seven times.
    vectors = _py2java(spark.sparkContext, blocks.flatMap(lambda block: map(Vectors.dense, block.T))).rdd()
    vectors.persist(spark._jvm.org.apache.spark.storage.StorageLevel.MEMORY_AND_DISK())

    def first_centers(job: tuple[int, int]) -> np.ndarray:
        k, seed = job
        start = spark._jvm.org.apache.spark.mllib.clustering.KMeans().setK(k).setSeed(seed).setMaxIterations(0)
        model = start.setInitializationMode("k-means||").setInitializationSteps(SEED_PASSES).run(vectors)
        return np.array([list(c.toArray()) for c in model.clusterCenters()])

    with ThreadPoolExecutor(parallelism) as pool:
        centers = dict(zip(jobs, pool.map(first_centers, jobs), strict=True))
    vectors.unpersist(False)

    measured, iterations = dict(centers), dict.fromkeys(centers, 0)
    moving = list(centers) if max_iter else []
    while moving:
        fits = [centers[job] for job in moving]
        parts = blocks.mapPartitions(lambda part, fits=fits: _sums(part, fits)).collect()
        ends = np.cumsum([len(c) for c in fits])
        unrested = []
        for job, sums in zip(moving, np.split(np.sum(parts, axis=0), ends[:-1]), strict=True):
            measured[job], held = centers[job], sums[:, 0] > 0
            moved = centers[job].copy()
            moved[held] = sums[held, 1:] * (1.0 / sums[held, :1])
            rests = (((moved - centers[job]) ** 2).sum(1) <= tolerance).all()
            centers[job] = moved
            iterations[job] += 1
            if not rests and iterations[job] < max_iter:
                unrested.append(job)
        moving = unrested
    fits = [measured[job] for job in centers]
    costs = np.sum(blocks.mapPartitions(lambda part: _costs(part, fits)).collect(), axis=0)
    blocks.unpersist()
    return {job: Centers(centers[job], float(cost), iterations[job]) for job, cost in zip(centers, costs, strict=True)}


def fit_kmeans(rows: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = MAX_ITER) -> Centers:
    """Best of ``n_init`` seeded fits by cost."""
    fits = fit_starts(rows, [(k, seed + i) for i in range(n_init)], max_iter=max_iter)
    return min(fits.values(), key=lambda f: f.cost)


def sweep_kmeans(
    vectors: DataFrame, ks: range = range(2, 13), seed: int = 42, n_init: int = 10, max_iter: int = MAX_ITER
) -> tuple[DataFrame, dict[int, Centers]]:
    """Inertia, silhouette and Davies-Bouldin index per k, and the best fit of every k.

    ``vectors`` should be cached or checkpointed.
    """
    fits = fit_starts(vectors, [(k, seed + i) for k in ks for i in range(n_init)], max_iter=max_iter)
    best: dict[int, Centers] = {}
    for (k, _), fit in fits.items():
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit

    def silhouette(k: int) -> tuple[int, float, float]:
        labelled = best[k].assign(vectors, name="prediction").withColumn("prediction", F.col("prediction").cast("double"))
        return k, best[k].cost, ClusteringEvaluator().evaluate(labelled)

    with ThreadPoolExecutor(8) as pool:
        scores = list(pool.map(silhouette, sorted(best)))
    labels = vectors.select(*SCALED)
    for k, fit in best.items():
        labels = fit.assign(labels, name=f"k{k}")
    long = labels.unpivot(list(SCALED), [f"k{k}" for k in best], "k", "cluster")
    index = davies_bouldin(long.withColumn("k", F.substring("k", 2, 9).cast("int")), SCALED, by=("k",))
    table = vectors.sparkSession.createDataFrame(scores, "k int, inertia double, silhouette double")
    return cut(table.join(index, "k")), best


def inertia(placed: DataFrame, centers: np.ndarray, columns: tuple[str, ...] = SCALED) -> DataFrame:
    """(cluster, n_rows, inertia): rows and summed squared distances to the center each was given."""
    of = F.array(*[F.array(*[F.lit(float(v)) for v in center]) for center in centers])
    own = F.array(*[F.col(c) for c in columns])
    squares = F.zip_with(own, F.get(of, F.col("cluster")), lambda x, y: (x - y) * (x - y))
    squared = F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s)
    return placed.groupBy("cluster").agg(F.count("*").alias("n_rows"), F.sum(squared).alias("inertia"))


def choose_k(sweep: DataFrame, target_range: tuple[int, int] = (6, 8)) -> int:
    """The k inside the range with the highest silhouette, the smallest one on a tie."""
    chosen = (
        sweep.filter(F.col("k").between(*target_range))
        .agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k"))
        .first()["k"]
    )
    if chosen is None:
        raise ValueError(f"no k in {target_range} was tried")
    return int(chosen)


def davies_bouldin(
    labelled: DataFrame, columns: tuple[str, ...], cluster: str = "cluster", by: tuple[str, ...] = ()
) -> DataFrame:
    """Mean over clusters of the worst (scatter + scatter) / centroid distance; noise is left out.

    ``by`` names columns that separate several clusterings. Only the centroids of one clustering
    meet in one row. The centroids go to the members, which are not shuffled.
    """
    members = labelled.filter(F.col(cluster) != NOISE).select(*by, F.col(cluster).alias("c"), *columns)
    centroids = members.groupBy(*by, "c").agg(F.array(*[F.avg(x) for x in columns]).alias("centroid"))
    centroids = F.broadcast(centroids)
    spread = (
        members.join(centroids, [*by, "c"])
        .withColumn("d", _distance(F.array(*[F.col(x) for x in columns]), F.col("centroid")))
        .groupBy(*by, "c")
        .agg(F.avg("d").alias("s"))  # beside an array it would be an aggregate of sorted members
        .join(centroids, [*by, "c"])
    )
    everyone = spread.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("c", "s", "centroid"))).alias("all"))

    def worst(a: Column) -> Column:
        others = F.filter("all", lambda b: b["c"] != a["c"])
        return F.array_max(
            F.transform(
                others, lambda b: F.try_divide(a["s"] + b["s"], _distance(a["centroid"], b["centroid"]))
            )
        )

    ratios = F.transform("all", worst)
    return everyone.select(
        *by,
        F.try_divide(F.aggregate(ratios, F.lit(0.0), lambda acc, r: acc + r), F.size("all")).alias(
            "davies_bouldin"
        ),
    )


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def cluster_names(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, segment_name) from each cluster's mean R, F, M against the median of the means.

    The windows run over one row per cluster.
    """
    profile = (
        labelled.filter(F.col(cluster) != NOISE)
        .groupBy(cluster)
        .agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in METRICS])
    )
    middle = profile.agg(F.struct(*[F.median(c).alias(c) for c in METRICS])).scalar()
    named = profile.withColumn("_mid", middle).withColumn(
        "base",
        octant_label(
            F.col("recency_days") <= F.col("_mid.recency_days"),
            F.col("frequency") >= F.col("_mid.frequency"),
            F.col("monetary") >= F.col("_mid.monetary"),
        ),
    )
    same = W.partitionBy("base")
    rank = F.row_number().over(same.orderBy(F.desc("monetary"), cluster))
    qualifier = F.coalesce(
        F.get(F.array(*[F.lit(q) for q in QUALIFIERS]), rank - 1),
        F.concat(F.lit("tier"), rank.cast("string")),
    )
    alone = F.count(F.lit(1)).over(same) == 1
    return named.select(
        cluster,
        F.when(alone, F.col("base")).otherwise(F.concat_ws("_", "base", qualifier)).alias("segment_name"),
    )


def label_segments(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Adds ``segment_name``; noise points are named ``noise``."""
    return labelled.join(cluster_names(labelled, cluster), cluster, "left").withColumn(
        "segment_name",
        F.when(F.col(cluster) == NOISE, "noise").otherwise(F.col("segment_name")),
    )


def project_2d(vectors: DataFrame, id_col: str = "customer_id") -> tuple[DataFrame, list[float]]:
    """Two principal components per row and the variance each explains."""
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors)
    from pyspark.ml.functions import vector_to_array

    xy = model.transform(vectors).withColumn("pc", vector_to_array("pc"))
    return (
        xy.select(id_col, F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2")),
        [float(v) for v in model.explainedVariance],
    )
