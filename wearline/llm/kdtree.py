"""Exact nearest vectors by inner product, with a KD-tree per shard.

Every shard builds its tree once, by median splits that halve the widest side, and writes it to the
shared folder; each node has the tight box of its vectors. Queries are dealt out in blocks; a task
maps one tree after the other and takes its queries through it. A query visits nodes best first, by
the largest inner product any point of the box can reach, and stops when that bound is below its kth
score so far, which goes on from shard to shard. A bound equal to the kth score is still visited,
since ties go to the smaller id. Vectors are moved once, queries once, and nothing else.

Shards hold about ``SHARD_ROWS`` vectors and blocks at most ``QUERY_ROWS`` queries, fewer where
there are tasks for more blocks; hot values do not matter, as rows are dealt out by a hash of the whole
row. Vectors that are NULL, hold NULL or non-finite components or whose length is not that of the
query take no part, nor do rows without a key. Rows that share the query's key are its own row and
never its match. Each row that is a query gets its own ranks, also where keys are repeated; stored rows
with a repeated key are found one by one. Components may be of any size: scores are exact, and NULL
where they need more than 38 digits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from . import files
from .common import partitions_for

SHARD_ROWS = 32_768
QUERY_ROWS = 4_096
BLOCK_ROWS = 64
LEAF = 512
EXACT = 1 << 53
DIGITS = 10**38


@dataclass
class Tree:
    """Nodes in heap order: node i has the children 2i+1 and 2i+2; leaves are row ranges."""

    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bounds: np.ndarray
    leaves_from: int

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Tree:
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / leaf))))
        count = 2 ** (depth + 1) - 1
        bounds = np.zeros((count, 2), np.int64)
        bounds[0] = 0, len(ids)
        place = np.arange(len(ids))
        for node in range(2**depth - 1):
            a, b = bounds[node]
            own = rows[place[a:b]]
            middle = (a + b) // 2
            if b - a > 1:
                side = int(np.argmax(own.max(0) - own.min(0)))
                place[a:b] = place[a:b][np.argpartition(own[:, side], middle - a)]
            bounds[2 * node + 1] = a, middle
            bounds[2 * node + 2] = middle, b
        ids, rows = ids[place], rows[place]
        low = np.array([rows[a:b].min(0) if b > a else np.zeros(rows.shape[1], rows.dtype) for a, b in bounds])
        high = np.array([rows[a:b].max(0) if b > a else np.zeros(rows.shape[1], rows.dtype) for a, b in bounds])
        return cls(ids, rows, low, high, bounds, 2**depth - 1)

    def search(self, own: int, query: np.ndarray, reach: list, found: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``found`` (ids and scores of the best rows so far, the best first) after this tree."""
        ids, scores = found
        full = len(ids) == k
        kth = scores[-1] if full else None
        heap = [(-reach[0], 0)]
        while heap and (not full or -heap[0][0] >= kth):
            _, node = heapq.heappop(heap)
            a, b = self.bounds[node]
            if a == b:
                continue
            if node < self.leaves_from:
                for child in (2 * node + 1, 2 * node + 2):
                    if not full or reach[child] >= kth:
                        heapq.heappush(heap, (-reach[child], child))
                continue
            near = self.rows[a:b] @ query
            take = self.ids[a:b] != own
            if full:
                take &= (near >= kth).astype(bool)
            if take.any():
                ids = np.concatenate([ids, self.ids[a:b][take]])
                scores = np.concatenate([scores, near[take]])
                keep = np.lexsort((ids, -scores))[:k] if scores.dtype != object else _order(ids, scores)[:k]
                ids, scores = ids[keep], scores[keep]
                full = len(ids) == k
                kth = scores[-1] if full else None
        return ids, scores

    def reach(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query with any point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def pack(self) -> bytes:
        return files.pack(
            {
                "ids": self.ids,
                "rows": self.rows.ravel(),
                "low": self.low.ravel(),
                "high": self.high.ravel(),
                "bounds": self.bounds.ravel(),
            }
        )

    @classmethod
    def unpack(cls, body, width: int, exact: bool) -> Tree:
        found = files.unpack(body)
        rows, low, high = (_whole(found[n].reshape(-1, width), exact) for n in ("rows", "low", "high"))
        bounds = found["bounds"].reshape(-1, 2)
        return cls(found["ids"], rows, low, high, bounds, len(bounds) // 2)


def _order(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])))


def _whole(values: np.ndarray, exact: bool) -> np.ndarray:
    """Python's whole numbers where doubles would round."""
    return values if exact else np.vectorize(int, otypes=[object])(values)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "vector", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf: int = LEAF) -> DataFrame:
    """``query_id``, ``rank``, ``key``, ``score``: the ``k`` rows of ``vectors`` with the largest
    inner product with each row of ``queries``; ties go to the smaller key.

    Both have ``key`` (long) and ``vector``, an array of whole numbers as doubles.
    """
    vectors = pin(_valid(vectors, key, vector), "vectors")
    queries = pin(_valid(queries, key, vector), "queries")
    stats = vectors.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs))), F.max(F.size("v"))).first()
    rows, largest, width = stats[0] or 0, stats[1] or 0.0, stats[2] or 0
    asked, largest_q = queries.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    # Sums of products are whole numbers; doubles hold them exactly up to 2^53.
    exact = max(largest, 1) * max(largest_q or 0, 1) * max(width, 1) < EXACT
    uri = files.folder(vectors.sparkSession, "trees")
    shard = F.pmod(F.xxhash64("id", "v"), F.lit(max(1, -(-rows // shard_rows)))).alias("shard")
    trees = vectors.groupBy("size", shard).applyInArrow(lambda t: _build(t, uri, leaf), "line string")
    listed = files.listed(pin(trees, "trees"), uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, query_rows):
                part = batch.slice(start, query_rows)
                if count + part.num_rows > query_rows:
                    yield from _search(held, listed, k, exact, key)
                    held, count = [], 0
                held.append(part)
                count += part.num_rows
        if held:
            yield from _search(held, listed, k, exact, key)

    # Enough blocks for all tasks, so that none waits for the others.
    blocks = max(-(-asked // query_rows), min(2 * partitions_for(queries), asked // BLOCK_ROWS), 1)
    return queries.repartition(blocks).mapInArrow(run, f"query_id long, rank int, `{key}` long, score decimal(38,0)")


def _valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    rows = rows.filter(~bad & (F.size(vector) > 0))
    return rows.select(F.col(key).cast("long").alias("id"), v.alias("v"), F.size(vector).alias("size"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
    return flat.reshape(rows, -1)


def _build(stored: pa.Table, uri: str, leaf: int) -> pa.Table:
    """Write the tree of a shard; its row holds the vectors' length and the file."""
    tree = Tree.build(stored["id"].to_numpy(), _matrix(stored["v"], stored.num_rows), leaf)
    return pa.table({"line": [f"{stored['size'][0].as_py()} {files.write(uri, tree.pack(), '.tree')}"]})


def _search(held: list[pa.RecordBatch], listed: str, k: int, exact: bool, key: str) -> Iterator[pa.RecordBatch]:
    """Rows of the result for a block of queries, which go through all trees together."""
    asked = pa.Table.from_batches(held)
    sizes = asked["size"].to_numpy()
    trees = [line.split(" ", 1) for line in files.lines(listed)]
    for size in np.unique(sizes).tolist():
        mine = asked.filter(pa.array(sizes == size))
        own, queries = mine["id"].to_numpy(), _whole(_matrix(mine["v"], mine.num_rows), exact)
        found = [(np.empty(0, np.int64), np.empty(0, queries.dtype))] * len(own)
        for length, uri in trees:
            if int(length) != size:
                continue
            tree = Tree.unpack(files.mapped(uri), size, exact)
            for part in range(0, len(own), 512):
                reach = tree.reach(queries[part : part + 512])
                for i, row in enumerate(reach, part):
                    found[i] = tree.search(int(own[i]), queries[i], row.tolist(), found[i], k)
        counts = [len(ids) for ids, _ in found]
        if not sum(counts):
            continue
        scores = [int(s) for _, part in found for s in part]
        columns = {
            "query_id": pa.array(np.repeat(own, counts)),
            "rank": pa.array(np.concatenate([np.arange(1, n + 1, dtype=np.int32) for n in counts])),
            key: pa.array(np.concatenate([ids for ids, _ in found])),
            "score": pa.array([s if abs(s) < DIGITS else None for s in scores], pa.decimal128(38, 0)),
        }
        yield pa.RecordBatch.from_pydict(columns)
