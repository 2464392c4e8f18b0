"""Clusters of vectors in whole numbers, the nearest centroid found by a tournament of bisectors.

For centroids a and b the sign of ``normal . x - threshold`` says on which side
of their bisecting plane x lies; normals and thresholds are whole numbers and
computed once a round. The winner so far meets each later centroid once, so
k - 1 tests of a sign leave the nearest one; on the plane itself the smaller
number stays. Distances are computed only after the last round.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import saved

DIMENSIONS, SCALE = 64, 1024
CENTROIDS, ROUNDS, SEED = 8, 10, 3
#: Whole numbers from here on are left out: their floor is no exact double, their squares are no long.
LARGEST = 1 << 52
#: Rows compared at once.
STEP_ROWS = 4096


def usable(vector: Column, dimensions: int) -> Column:
    """The right number of components, each a finite number within LARGEST when scaled."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE < float(LARGEST)))
    return F.coalesce((F.size(vector) == dimensions) & fits, F.lit(False))


def whole_vectors(vectors: DataFrame, dimensions: int) -> DataFrame:
    """(vec_id, point) with ``point`` an array of longs."""
    floors = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(usable(F.col("embedding"), dimensions)).select(F.col("vec_id").cast("long").alias("vec_id"), floors.alias("point"))


def first_centroids(points: DataFrame, count: int, seed: int) -> list[list[int]]:
    """Points whose ids have the smallest hashes; rows of one id in order of their components, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [row["point"] for row in points.orderBy(digest.asc_nulls_last(), "point").limit(count).collect()]


def matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimensions)


class Bisectors:
    """Normals and thresholds of every pair a < b: b is nearer where ``normal . x > threshold``.

    Their numbers are 64-bit where the points and centroids are so small that no
    sum can leave these, and Python's otherwise.
    """

    def __init__(self, centroids: list[list[int]]) -> None:
        exact = np.array(centroids, object)
        squares = (exact * exact).sum(1)
        self.centroids = exact
        self.normals = 2 * (exact[None, :, :] - exact[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]
        self.reach = max((abs(int(x)) for x in exact.ravel()), default=0)

    def numbers(self, points: np.ndarray) -> np.dtype:
        most = int(np.abs(points).max(initial=0)) + self.reach
        return np.dtype(np.int64) if 4 * points.shape[1] * most * most < 1 << 62 else np.dtype(object)

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each point, the smaller one of two as near."""
        kind = self.numbers(points)
        normals, thresholds, own = self.normals.astype(kind), self.thresholds.astype(kind), points.astype(kind)
        winner = np.zeros(len(points), np.int64)
        for other in range(1, len(self.centroids)):
            side = (own * normals[winner, other]).sum(1) - thresholds[winner, other]
            winner[(side > 0).astype(bool)] = other
        return winner

    def distances(self, points: np.ndarray, winner: np.ndarray) -> np.ndarray:
        kind = self.numbers(points)
        apart = points.astype(kind) - self.centroids.astype(kind)[winner]
        return (apart * apart).sum(1)


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(low, STEP_ROWS)


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid that has points, replaced by the floor of their mean.

    Tasks return a sum per centroid and component for each few thousand points,
    in two halves that no addition can overflow; Spark adds them up as decimals.
    """
    field, dimensions = Bisectors(centroids), len(centroids[0])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, number = (np.zeros((len(centroids), dimensions), np.int64) for _ in range(3))
        for batch in steps(batches):
            own = matrix(batch.column("point"), dimensions)
            winner = field.nearest(own)
            np.add.at(high, winner, own >> 32)
            np.add.at(low, winner, own & 0xFFFFFFFF)
            np.add.at(number, winner, 1)
        some = np.flatnonzero(number.any(1))
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": np.repeat(some, dimensions).astype(np.int32),
                "place": np.tile(np.arange(dimensions, dtype=np.int32), len(some)),
                "high": high[some].ravel(),
                "low": low[some].ravel(),
                "number": number[some].ravel(),
            }
        )

    parts = points.select("point").mapInArrow(add_up, "cluster int, place int, high long, low long, number long")
    whole = F.col("high").cast("decimal(38,0)") * (1 << 32) + F.col("low")
    sums = parts.groupBy("cluster", "place").agg(F.sum(whole.cast("decimal(38,0)")).alias("sum"), F.sum("number").alias("number"))
    out = [list(centroid) for centroid in centroids]
    for row in sums.collect():  # one for each centroid and component
        out[row["cluster"]][row["place"]] = int(row["sum"]) // row["number"]
    return out


def assigned(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance as decimal) of every point."""
    field, dimensions = Bisectors(centroids), len(centroids[0])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            own = matrix(batch.column("point"), dimensions)
            winner = field.nearest(own)
            exact = [str(distance) for distance in field.distances(own, winner).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(winner.astype(np.int32)), pa.array(exact, pa.string())],
                names=["vec_id", "cluster", "distance"],
            )

    found = points.mapInArrow(assign, "vec_id long, cluster int, distance string")
    return found.withColumn("distance", F.col("distance").cast("decimal(38,0)"))


def clustered(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) of every usable row of ``vectors``.

    Rows of (vec_id, embedding) are used that have ``dimensions`` components, none
    of them null or non-finite; others are left out, as are those with a component
    of 2**42 or more, whose distances are beyond any long. Components become
    floor(1024 * x). Distances are squared ones, inertias sums of them; where one
    does not fit a long it is null. ``centroid`` is the final centroid, and its digest is
    that of its components as decimal numbers with commas between.

    Rows repeated, or without an id, are points like others. Fewer points than
    ``count`` give as many centroids; equal centroids leave all their points to the
    smallest number. Extra columns are left out. The driver holds the centroids and
    one sum for each of their components.
    """
    points = saved(whole_vectors(vectors, dimensions), "whole-vectors")
    centroids = first_centroids(points, count, seed)
    kinds = "cluster int, centroid array<long>"
    spark = vectors.sparkSession
    for _ in range(rounds if centroids else 0):
        centroids = moved(points, centroids)
    found = assigned(points, centroids or [[0] * dimensions])
    found = saved(found, "clusters")
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = found.agg(F.try_sum("distance").alias("inertia"))
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    final = spark.createDataFrame(list(enumerate(centroids)), kinds).withColumn("centroid_sha256", F.sha2(digits, 256))
    # one row for each centroid
    known = sums.join(F.broadcast(final), "cluster").join(F.broadcast(total))
    out = found.join(F.broadcast(known), "cluster")
    longs = [F.expr(f"try_cast({name} AS long)").alias(name) for name in ("distance", "cluster_inertia", "inertia")]
    return out.select("vec_id", "cluster", *longs, "centroid", "centroid_sha256")
