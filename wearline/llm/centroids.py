"""Nearest-centroid clustering by the threshold algorithm, exact in whole numbers.

For each dimension the centroids are kept in a list sorted by their value there. A vector walks
each list outward from its own value, nearest centroid first; what it meets is measured exactly,
over all dimensions. The squared distances of the lists' frontiers add up to a bound that no
centroid can undercut which was not met yet, so a vector stops as soon as that sum strictly
exceeds its best exact distance; an equal sum goes on, since ties go to the smaller number.

A round is one pass over the vectors: every task holds the centroids (``k`` x dimensions numbers,
whatever the data) and hands on one row with its counts and sums, which meet in a tree. Nothing is
shuffled by cluster, so a cluster that holds most vectors is no heap.

Vectors take part if they have exactly ``dimensions`` components, none NULL or non-finite; others
have no row in the result. Starts are the ``k`` rows whose ``sha256("<salt>:<key>")`` is smallest,
equal ones in the order of their components; a row with a NULL key never is a start, but gets a
cluster. Rows with a repeated key take part one by one. With fewer rows than ``k`` there are fewer
centroids; without a start there are no rows. Components of any size are compared as whole
numbers; a distance or an inertia beyond a long is NULL.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from .common import tree_merge

BLOCK = 2_048
EXACT = 1 << 53
LONGEST = (1 << 63) - 1


class Lists:
    """The centroids (rows of whole numbers), and per dimension their order by value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(centroids, self.order.T, axis=0).T

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid."""
        count, (k, width) = len(rows), self.centroids.shape
        best = np.full(count, -1, np.int64)
        distance = np.zeros(count, rows.dtype)
        met = np.zeros((count, k), bool)
        dims = np.arange(width)
        right = np.stack([np.searchsorted(self.sorted[d], rows[:, d]) for d in dims], axis=1)
        left = right - 1
        live = np.arange(count)
        while len(live):
            own, low, high = rows[live], left[live], right[live]
            below = own - self.sorted[dims, np.maximum(low, 0)]
            above = self.sorted[dims, np.minimum(high, k - 1)] - own
            # Where a list has ended on one side its other side goes on.
            down = (low >= 0) & ((high >= k) | (below <= above))
            frontier = np.where(down, below, above)
            number = self.order[dims, np.where(down, np.maximum(low, 0), np.minimum(high, k - 1))]
            left[live], right[live] = low - down, high + ~down
            new = np.zeros((len(live), k), bool)
            new[np.arange(len(live))[:, None], number] = True
            new &= ~met[live]
            met[live] |= new
            # One centroid at a time, in their order, so that ties stay with the smaller number.
            for c in np.flatnonzero(new.any(axis=0)):
                at = live[new[:, c]]
                apart = rows[at] - self.centroids[c]
                found = (apart * apart).sum(axis=1)
                better = (best[at] < 0) | (found < distance[at]) | ((found == distance[at]) & (c < best[at]))
                best[at[better]], distance[at[better]] = c, found[better]
            bound = (frontier * frontier).sum(axis=1)
            # Of k steps at most, since by then a list has ended.
            live = live[(bound <= distance[live]) & ~met[live].all(axis=1)]
        return best, distance


def _matrix(column: pa.Array, width: int, exact: bool) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return flat if exact else np.vectorize(int, otypes=[object])(flat)


def _is_exact(largest: float, width: int) -> bool:
    """Whether doubles hold all sums of squared differences."""
    return 4 * largest * largest * width < EXACT


def _add(texts: Iterator[str]) -> str | None:
    """Counts and sums of clusters, as JSON of whole numbers of any size."""
    total = None
    for text in texts:
        part = json.loads(text)
        if total is None:
            total = part
            continue
        for a, b in zip(total, part):
            a[:] = [x + y for x, y in zip(a, b)]
    return None if total is None else json.dumps(total)


def _sums(rows: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """A row a cluster: its count and its sums, as Python's whole numbers."""
    out = np.zeros((k, rows.shape[1] + 1), object)
    if rows.dtype == object:
        np.add.at(out[:, 1:], number, rows)
    else:
        sums = np.zeros((k, rows.shape[1]), np.int64)
        np.add.at(sums, number, rows.astype(np.int64))
        out[:, 1:] = sums
    out[:, 0] = np.bincount(number, minlength=k)
    return out


def _assigned(vectors: DataFrame, lists: Lists, width: int, exact: bool) -> DataFrame:
    """Each vector with its cluster and distance, ``whole`` the distance as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                rows = _matrix(part.column("v"), width, exact)
                number, distance = lists.nearest(rows)
                whole = [int(d) for d in distance]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(number.astype(np.int32)),
                        pa.array([d if d <= LONGEST else None for d in whole], pa.int64()),
                        pa.array([str(d) for d in whole], pa.string()),
                    ],
                    ["key", "cluster", "distance", "whole"],
                )

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(run, f"key {kind}, cluster int, distance long, whole string")


def _summed(vectors: DataFrame, lists: Lists, width: int, exact: bool) -> list[list[int]]:
    """Count and sums of each cluster over all vectors."""
    k = len(lists.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = _matrix(batch.slice(start, BLOCK).column("v"), width, exact)
                number, _ = lists.nearest(rows)
                total += _sums(rows, number, k)
        yield pa.RecordBatch.from_pydict({"part": [json.dumps(total.tolist())]})

    found = tree_merge(vectors.select("v").mapInArrow(run, "part string"), _add)
    return json.loads(found) if found else [[0] * (width + 1)] * k


def cluster(
    df: DataFrame,
    k: int,
    rounds: int,
    salt: str,
    dimensions: int,
    key: str = "vec_id",
    vector: str = "vector",
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` (of the components, in decimal, joined by commas) of every vector that
    takes part. ``vector`` holds whole numbers as doubles. After ``rounds`` moves of the
    centroids to the floor of their vectors' mean, empty ones staying, all are assigned again."""
    spark = df.sparkSession
    vectors = pin(_valid(df, key, vector, dimensions), "vectors")
    largest = vectors.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    exact = _is_exact(largest, dimensions)
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("key").cast("string")).cast("binary"), 256)
    starts = vectors.filter("key IS NOT NULL").withColumn("digest", digest).orderBy("digest", "v").limit(k)
    # At most k rows, whatever the table.
    chosen = [[int(x) for x in row.v] for row in starts.select("v").collect()]
    kind = vectors.schema["key"].dataType.simpleString()
    if not chosen:
        schema = f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    centroids = chosen
    for _ in range(rounds):
        moved = _summed(vectors, _lists(centroids, exact), dimensions, exact)
        centroids = [[s // n for s in sums] if n else old for (n, *sums), old in zip(moved, centroids)]
    found = pin(_assigned(vectors, _lists(centroids, exact), dimensions, exact), "assigned")
    return _with_inertia(found, centroids, key)


def _lists(centroids: list[list[int]], exact: bool) -> Lists:
    return Lists(np.array(centroids, np.float64 if exact else object))


def _with_inertia(found: DataFrame, centroids: list[list[int]], key: str) -> DataFrame:
    """Joins a row per cluster to the assigned vectors: ``k`` rows, so it is broadcast."""
    spark = found.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0, 0] for _ in centroids]
        for batch in batches:
            for number, whole in zip(batch.column("cluster").to_pylist(), batch.column("whole").to_pylist()):
                total[number][0] += 1
                total[number][1] += int(whole)
        yield pa.RecordBatch.from_pydict({"part": [json.dumps(total)]})

    sums = json.loads(tree_merge(found.select("cluster", "whole").mapInArrow(run, "part string"), _add) or "[]")
    whole = sum(s for _, s in sums)
    fit = lambda n: n if n <= LONGEST else None
    rows = [
        (i, fit(s), fit(whole), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, ((_, s), c) in enumerate(zip(sums, centroids))
    ]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _valid(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    v = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter((F.size(vector) == dimensions) & ~bad).select(F.col(key).alias("key"), v.alias("v"))
