"""Resampling towards a target: documents drawn by how much their n-grams look like the target's.

Features are the runs of 1 to ``GRAMS`` words of a text, dealt into ``BUCKETS`` buckets by the
CRC-32 of their bytes. One pass each counts the buckets of all documents and of the target; the
gain of a bucket is the log ratio of its smoothed shares. A last pass scores all documents by
arrays: words are looked up once, the checksum of a longer run comes from those of its parts by
look-up tables (a checksum is linear), and a text's weight is the sum of its buckets' gains.
Gumbel noise from the document's key turns the largest scores into a sample without replacement.

The cut is found by weighted medians of medians. Every task gives the median of its remaining keys
and their number; the median of these, weighted by the numbers, has at least a fourth of the
remaining keys on each side, so each round leaves a fixed share behind, down to the exact key.
Tasks hold a batch at a time, and medians are merged in a tree; beyond ``KEPT`` of them, neighbours
are drawn together. The keys that remain are written anew once few are left of those last written.
Only the winners are sorted.

Keys are whole numbers. NULL texts count as empty and have weight 0; a NULL key comes after all others
at a tie, and its noise is that of an empty key. Rows with equal score and key are ranked one after
the other, in no stated order. Without rows there is nothing to rank.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import pin

from .common import pieces, segments, texts, tree_merge

GRAMS = 3
BUCKETS = 10_000
KEPT = 256
SHRUNK = 8
#: Lengths up to this have a table of their own, longer ones are put together.
SHORT = 64

# Words are digits, letters a-z and all beyond ASCII; A-Z count as a-z.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a segment at a time."""
    for part in segments(text.translate(_PLAIN)):
        yield part.split()


class _Checksums(dict):
    """Of a word: its CRC-32, and above it that of a blank and the word."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = zlib.crc32(word) | zlib.crc32(b" " + word) << 32
        return value


def _zero_byte(values: np.ndarray) -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = step >> np.uint32(1) ^ np.uint32(0xEDB88320) * (step & np.uint32(1))
    return values >> np.uint32(8) ^ step[values & np.uint32(255)]


def _applied(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``table`` holds what becomes of each byte of a checksum, by place and value."""
    return np.bitwise_xor.reduce([table[i, values >> np.uint32(8 * i) & np.uint32(255)] for i in range(4)])


class _Joined:
    """Checksums of joined strings from those of the parts."""

    def __init__(self):
        own = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        tables = [own]
        for _ in range(SHORT):
            tables.append(_zero_byte(tables[-1]))
        self.short = np.concatenate([t.ravel() for t in tables])
        self.doubled = list(accumulate(range(40), lambda t, _: _applied(t, t), initial=tables[SHORT]))

    def __call__(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The checksums of ``first`` and then ``second``, which has ``length`` bytes."""
        base, long = (length % SHORT) * 1024, length // SHORT
        out = self.short.take(base + (first & np.uint32(255)))
        for i in range(1, 4):
            out ^= self.short.take(base + (256 * i) + (first >> np.uint32(8 * i) & np.uint32(255)))
        for level in range(int(long.max(initial=0)).bit_length()):
            at = np.flatnonzero(long >> level & 1)
            out[at] = _applied(self.doubled[level], out[at])
        return out ^ second


class Features:
    """Buckets of texts."""

    def __init__(self, grams: int = GRAMS, buckets: int = BUCKETS):
        self.grams, self.buckets = grams, buckets
        self.checksums, self.joined = _Checksums(), _Joined()

    def of(self, column: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For each length of a run its buckets and the first of each text, with the end; and
        the texts' numbers of words."""
        codes, lengths, sizes = [], [], []
        for text in column:
            size = 0
            for words in words_of(text):
                codes.append(np.fromiter(map(self.checksums.__getitem__, words), np.uint64, len(words)))
                lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
                size += len(words)
            sizes.append(size)
        sizes = np.array(sizes, np.int64)
        codes = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        lengths = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        own, after = codes.astype(np.uint32), (codes >> np.uint64(32)).astype(np.uint32)
        ends = np.repeat(np.cumsum(sizes), sizes)
        found, at, value = [], np.arange(len(codes)), own
        for run in range(self.grams):
            if run:
                inside = at + run < ends[at]
                at, value = at[inside], value[inside]
                value = self.joined(value, after[at + run], lengths[at + run] + 1)
            starts = np.concatenate([[0], np.cumsum(np.maximum(sizes - run, 0))])
            found.append(((value % np.uint32(self.buckets)).astype(np.int64), starts))
        return found, sizes


def bucket_counts(df: DataFrame, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    source = df.select(F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(grams, buckets), np.zeros(buckets, np.int64)
        for piece in pieces(batches, "t"):
            for found, _ in features.of(piece.column("t").cast(pa.large_binary()).to_pylist())[0]:
                total += np.bincount(found, minlength=buckets)
        yield pa.RecordBatch.from_pydict({"part": [json.dumps(total.tolist())]})

    def add(parts: Iterator[str]) -> str | None:
        total = None
        for part in parts:
            own = np.array(json.loads(part), np.int64)
            total = own if total is None else total + own
        return None if total is None else json.dumps(total.tolist())

    found = tree_merge(source.mapInArrow(run, "part string"), add)
    return np.array(json.loads(found), np.int64) if found else np.zeros(buckets, np.int64)


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of a bucket's shares, each count raised by one."""
    n = len(documents)
    all_target, all_documents = int(target.sum()) + n, int(documents.sum()) + n
    ratio = lambda t, s: float(t + 1) * float(all_documents) / (float(s + 1) * float(all_target))
    return np.array(
        [math.floor(1000 * math.log(ratio(t, s))) for t, s in zip(target.tolist(), documents.tolist())], np.int64
    )


def scores(docs: DataFrame, gain: np.ndarray, salt: str, key: str = "doc_id", text: str = "text", grams: int = GRAMS) -> DataFrame:
    """``key``, ``n_features``, ``n_words``, ``weight`` and ``score`` of every row."""
    seed = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")
    drawn = F.conv(F.substring(F.sha2(seed, 256), 1, 8), 16, 10).cast("long").alias("h")
    source = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"), drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(grams, len(gain))
        for piece in pieces(batches, "t"):
            found, sizes = features.of(piece.column("t").cast(pa.large_binary()).to_pylist())
            weight, count = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for bucket, starts in found:
                summed = np.concatenate([[0], np.cumsum(gain[bucket])])
                weight += summed[starts[1:]] - summed[starts[:-1]]
                count += np.diff(starts)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in piece.column("h").to_pylist()]
            columns = [count, sizes, weight, weight + np.array(noise, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("k"), *map(pa.array, columns)], ["k", "n_features", "n_words", "weight", "score"]
            )

    found = source.mapInArrow(run, "k long, n_features long, n_words long, weight long, score long")
    return found.withColumnRenamed("k", key)


Key = tuple[int, ...]


def _below(columns: list[np.ndarray], key: Key) -> np.ndarray:
    """Rows whose columns come before ``key``, compared one after the other."""
    out = np.zeros(len(columns[0]), bool)
    for column, value in zip(reversed(columns), reversed(key)):
        out = (column < value) | (column == value) & out
    return out


def _median(columns: list[np.ndarray]) -> Key:
    order = np.lexsort(columns[::-1])
    middle = order[(len(order) - 1) // 2]
    return tuple(int(c[middle]) for c in columns)


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first median up to which half of the weight lies."""
    total, reached = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        reached += n
        if 2 * reached >= total:
            return key
    raise ValueError("no medians")


def _drawn_together(medians: list[tuple[Key, int]]) -> list[tuple[Key, int]]:
    """At most ``KEPT`` medians: neighbours of about an equal share of the weight become one."""
    if len(medians) <= KEPT:
        return medians
    total, reached, groups = sum(n for _, n in medians), 0, {}
    for key, n in sorted(medians):
        groups.setdefault(reached * KEPT // total, []).append((key, n))
        reached += n
    return [(weighted_median(g), sum(n for _, n in g)) for g in groups.values()]


def _round(keys: DataFrame, names: list[str], low: Key | None, high: Key | None, pivot: Key | None) -> list:
    """[number and medians of the keys before the pivot, and behind it] of the keys between
    ``low`` and ``high``; without a pivot all are behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: list = [[0, []], [0, []]]
        for batch in batches:
            columns = [batch.column(n).to_numpy() for n in names]
            inside = np.ones(batch.num_rows, bool)
            if high is not None:
                inside &= _below(columns, high)
            if low is not None:
                inside &= ~_below(columns, (*low[:-1], low[-1] + 1))
            columns = [c[inside] for c in columns]
            before = np.zeros(len(columns[0]), bool)
            behind = ~before
            if pivot is not None:
                before = _below(columns, pivot)
                behind = ~_below(columns, (*pivot[:-1], pivot[-1] + 1))
            for side, mask in zip(sides, (before, behind)):
                count = int(mask.sum())
                if count:
                    side[0] += count
                    side[1] = _drawn_together([*side[1], (_median([c[mask] for c in columns]), count)])
        # One median a task.
        sides = [[n, [(weighted_median(m), n)] if m else []] for n, m in sides]
        yield pa.RecordBatch.from_pydict({"part": [json.dumps(sides)]})

    def add(parts: Iterator[str]) -> str | None:
        total: list = [[0, []], [0, []]]
        for part in parts:
            for side, (n, medians) in zip(total, json.loads(part)):
                side[0] += n
                side[1] = _drawn_together([*side[1], *[(tuple(k), n) for k, n in medians]])
        return json.dumps(total)

    found = json.loads(tree_merge(keys.mapInArrow(run, "part string"), add))
    return [(n, [(tuple(k), w) for k, w in medians]) for n, medians in found]


def _tuple(names: list[str]) -> Column:
    return F.struct(*names)


def _literal(key: Key, names: list[str]) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(key, names)])


def cutoff(keys: DataFrame, names: list[str], rank: int) -> Key | None:
    """The key of the given rank (from 1) in ascending order, None if there are fewer rows.

    ``names`` are columns of whole numbers without NULLs, which together differ in every row.
    """
    _, (remaining, medians) = _round(keys, names, None, None, None)
    low = high = None
    if rank > remaining or rank < 1:
        return None
    stored = remaining
    while True:
        pivot = weighted_median(medians)
        before, behind = _round(keys, names, low, high, pivot)
        if rank == before[0] + 1:
            return pivot
        if rank <= before[0]:
            high, (remaining, medians) = pivot, before
        else:
            rank -= before[0] + 1
            low, (remaining, medians) = pivot, behind
        if remaining * SHRUNK <= stored:
            keys = keys.filter(F.lit(True) if low is None else _tuple(names) > _literal(low, names))
            keys = pin(keys.filter(F.lit(True) if high is None else _tuple(names) < _literal(high, names)), "keys")
            stored = remaining


def draw(scored: DataFrame, percent: int, least_words: int, key: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank`` (from 1) for the ``percent`` of the rows with ``least_words`` words
    whose scores are the highest, ties to the smaller key; NULL for all others."""
    names = ["down", "none", "own", "row"]
    rows = pin(
        scored.withColumns(
            {
                "down": -F.col("score"),
                "none": F.col(key).isNull().cast("long"),
                "own": F.coalesce(F.col(key).cast("long"), F.lit(0)),
                "row": F.monotonically_increasing_id(),
            }
        ),
        "scored",
    )
    able = F.col("n_words") >= least_words
    number = rows.filter(able).count() * percent // 100
    last = cutoff(rows.filter(able).select(*names), names, number) if number else None
    columns = scored.columns
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    wins = able & (_tuple(names) <= _literal(last, names))
    rest = rows.filter(~wins).select(*columns, F.lit(None).cast("long").alias("rank"))
    return _ranked(rows.filter(wins), names, columns).unionByName(rest)


def _ranked(rows: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """Rows numbered in the order of ``names``: sorted in ranges, each counted on from the ones
    before it."""
    ordered = rows.repartitionByRange(*names).sortWithinPartitions(*names)
    # The number of the partition, above 33 bits with that of the row in it.
    ordered = pin(ordered.withColumn("at", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # A row for each range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return numbered.select(*columns, (F.col("before") + inside).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int, least_words: int, salt: str, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """``key``, ``n_features``, ``n_words``, ``weight``, ``score`` and ``rank`` of every row."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    return draw(scores(docs, gain, salt, key, text), percent, least_words, key)
