"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.session import pin

PIECE_BYTES = 4 << 20
HOT = 4_096
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text of each row, a NULL text as the empty one."""
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def pieces(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def segments(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Cut a text at blanks into parts of about ``size`` bytes."""
    start = 0
    while len(text) - start > size:
        blank = _BLANK.search(text, start + size)
        if blank is None:
            break
        yield text[start : blank.start()]
        start = blank.end()
    yield text[start:] if start else text


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without NULLs, and the row offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class WordHashes(dict):
    """XXH64 of words (bytes), computed once per word while it stays in the table."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tree_merge(parts: DataFrame, merge: Callable[[Iterator], str | None]) -> str | None:
    """One value from the texts of a one-column frame, merged by tasks level by level; the
    driver gets one text. ``merge`` gives the text of an iterator of texts, None for none."""
    name = parts.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = merge(v for batch in batches for v in batch.column(0).to_pylist())
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.string())], [name])

    tasks = partitions_for(parts)
    while tasks > 1:
        tasks = -(-tasks // 8)
        parts = parts.repartition(tasks).mapInArrow(run, f"`{name}` string")
    return merge(row[0] for row in parts.collect())


def spread_join(rows: DataFrame, classes: DataFrame, on: str | list[str], count: str = "n", how: str = "inner") -> DataFrame:
    """Join (inner or left) of many rows to one row per ``on``, whose ``count`` is the number of its rows.

    Classes with more than one of ``HOT`` of all rows, so less than ``HOT`` classes, are
    broadcast, and their rows stay where they are. Only the rows of the others are moved.
    """
    total = classes.agg(F.sum(count)).scalar()
    hot = F.col(count) * HOT > total
    large = classes.filter(hot).drop(count)
    small = classes.filter(~hot).drop(count)
    few = rows.join(F.broadcast(large.select(on)), on, "left_anti").join(small, on, how)
    return rows.join(F.broadcast(large), on).unionByName(few)


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that ``edges`` (``a``, ``b``) link.

    Alternates two steps until nothing moves: each node hands the smallest node around it to
    its larger neighbours, then to its smaller ones. Every step is a window-free aggregate
    and a join on the node, written to the shared folder, so that neither the lineage nor
    the driver grows. Returns (``node``, ``component``); nodes without an edge do not occur.
    """
    pairs = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = pin(pairs.distinct(), "links")
    previous = None
    while True:
        pairs = pin(_small_star(_large_star(pairs)), "links")
        # A star forest is the fixed point: sums over it change while any step moves a link.
        state = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == previous:
            break
        previous = state
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    linked = pairs.join(least, "a")
    to_least = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return to_least.unionByName(own).distinct()
