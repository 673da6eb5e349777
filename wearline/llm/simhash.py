"""SimHash fingerprints and links between near copies by bit-sliced comparison.

Fingerprint: ASCII letters in lower case, words between ASCII blanks, shingles of ``width``
words with repeats (all words if there are fewer), XXH64 with seed 42 of each; a bit is set if
it is set in more than half of the shingles. No words give the fingerprint 0.

Links: two fingerprints within ``radius`` bits agree in all but ``radius`` of ``radius + 2``
parts of the 64 bits, so in two parts at least. Distinct fingerprints are dealt out by each
pair of parts. What falls on one key is compared in blocks of ``BLOCK`` fingerprints: those of
a block are stored as bit planes, one machine word for 64 of them, and the distances of one
fingerprint to all of them are kept in carry-save counters that are updated plane by plane; a
block is left as soon as all its distances exceed the radius. A key with more than one block
is dealt out again by pairs of blocks, so that no task holds more than two blocks, and only
links are written. Copies share a fingerprint and are not expanded.

NULL texts count as empty. A NULL key is no candidate for a component's smallest key; a
component of such rows only has a NULL id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.session import pin

from .common import components, pieces, spread_join, texts

BLOCK = 4096
RADIUS = 2
WIDTH = 3
SEED = 42

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = (np.arange(8) * 256)[None, :]


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(whole[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    # Counts of each byte value at each of the eight places, then of each bit.
    places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits((counts * 2 > len(hashes)).ravel(), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    hashes = shingle_hashes(text, width)
    return majority(hashes) if len(hashes) else 0


def fingerprints(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``print``, the fingerprint as a signed 64-bit number."""
    source = texts(docs, key, text)
    kind = source.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            column = piece.column(text).cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in column], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(key), pa.array(found.view(np.int64))], [key, "print"]
            )

    return source.mapInArrow(run, f"{key} {kind}, print long")


def planes(values: np.ndarray) -> np.ndarray:
    """(bits, words): bit b of row i is bit i % 64 of word i // 64 of plane b."""
    rows, width = values.shape
    padded = np.zeros((-(-rows // 64) * 64, width * 8), np.uint8)
    padded[:rows] = np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(rows, -1)
    bits = np.unpackbits(padded, axis=1, bitorder="little").T
    return np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def within(queries: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (query, value) of all pairs of rows at most ``radius`` bits apart.

    Rows are words of 64 bits. The queries go through the planes together; a query leaves when
    its block is abandoned.
    """
    found_q, found_v = [], []
    stored = planes(values)
    outside = np.zeros(stored.shape[1], np.uint64)
    if len(values) % 64:
        outside[-1] = ~np.uint64((1 << (len(values) % 64)) - 1)
    levels = max(1, int(radius).bit_length())
    full = ~np.uint64(0)
    for part in range(0, len(queries), 512):
        live = np.arange(part, min(part + 512, len(queries)))
        # Counters of the distances, one bit level each; `over` holds those past the radius.
        counts = np.zeros((levels, len(live), stored.shape[1]), np.uint64)
        over = np.broadcast_to(outside, counts.shape[1:]).copy()
        for bit in range(len(stored)):
            word = queries[live, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)
            carry = stored[bit][None, :] ^ np.where(word, full, np.uint64(0))[:, None]
            for level in range(levels):
                carry, counts[level] = counts[level] & carry, counts[level] ^ carry
                if not carry.any():
                    break
            over |= carry
            if bit >= radius and (bit % 8 == 7 or bit + 1 == len(stored)):
                over |= _above(counts, radius)
                stay = ~(over == full).all(axis=1)
                if not stay.all():
                    live, counts, over = live[stay], counts[:, stay], over[stay]
                    if not len(live):
                        break
        if len(live):
            hit = np.unpackbits((~over).astype("<u8").view(np.uint8), axis=1, bitorder="little")
            q, v = np.nonzero(hit)
            found_q.append(live[q])
            found_v.append(v)
    if not found_q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_v)


def _above(counts: np.ndarray, radius: int) -> np.ndarray:
    """Where the counters hold more than ``radius``, compared from the highest level down."""
    more = np.zeros(counts.shape[1:], np.uint64)
    same = np.full(counts.shape[1:], ~np.uint64(0))
    for level in reversed(range(len(counts))):
        if radius >> level & 1:
            same &= counts[level]
        else:
            more |= same & counts[level]
            same &= ~counts[level]
    return more


def _part_keys(radius: int) -> list[Column]:
    """A key for each pair of parts of the fingerprint."""
    count = radius + 2
    bounds = [round(64 * i / count) for i in range(count + 1)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(bounds, bounds[1:])]
    keys = []
    for n, (i, j) in enumerate(combinations(range(count), 2)):
        mask = masks[i] | masks[j]
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("table"), F.col("print").bitwiseAND(F.lit(signed)).alias("bits")))
    return keys


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct pairs (``a`` < ``b``) of the distinct ``print`` values within ``radius`` bits."""
    dealt = prints.select("print").distinct().select("print", F.explode(F.array(*_part_keys(radius))).alias("k"))
    sizes = dealt.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.hash("print"), F.col("blocks"))
    units = (
        dealt.join(sizes, "k")
        .withColumn("own", own)
        # Block i meets every block j: the unit is the pair, the smaller one first.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "print",
            F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by unit: units are gathered until they fill a block.
        for values, cuts in _units(batches):
            a, b = _compare(values, cuts, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    parts = units.repartition("unit").sortWithinPartitions("unit")
    return parts.mapInArrow(run, "a long, b long").distinct()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole units in arrival order, ``BLOCK`` fingerprints or more at a time: these, and the
    units' starts with the end."""
    held, units = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        held = np.concatenate([held, batch.column("print").to_numpy()])
        units = np.concatenate([units, batch.column("unit").to_numpy()])
        done = int(np.searchsorted(units, units[-1], side="left"))
        if done >= BLOCK:
            yield held[:done], _starts(units[:done])
            held, units = held[done:], units[done:]
    if len(units):
        yield held, _starts(units)


def _starts(units: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.append(True, units[1:] != units[:-1])), len(units))


def _compare(values: np.ndarray, cuts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    sizes = np.diff(cuts)
    # Two fingerprints on a key need no planes.
    two = cuts[:-1][sizes == 2]
    x, y = values[two], values[two + 1]
    near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
    found.append((x[near], y[near]))
    for start, size in zip(cuts[:-1][sizes > 2], sizes[sizes > 2]):
        own = np.unique(values[start : start + size])
        for first in range(0, len(own), BLOCK):
            block = own[first : first + BLOCK]
            q, v = within(own[: first + len(block), None].view(np.uint64), block[:, None].view(np.uint64), radius)
            found.append((own[q], block[v]))
    a = np.concatenate([f[0] for f in found])
    b = np.concatenate([f[1] for f in found])
    keep = a != b
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep]


def near_copies(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key reachable."""
    prints = pin(fingerprints(docs, width, key, text), "prints")
    first = prints.groupBy("print").agg(F.min(key).alias("first"), F.count("*").alias("n"))
    linked = components(links(prints, radius)).select(F.col("node").alias("print"), "component")
    reach = first.join(linked, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = reach.groupBy("component").agg(F.min("first").alias("component_id"))
    # One row per distinct fingerprint.
    classes = reach.join(least, "component").select("print", "component_id", "n")
    return spread_join(prints, classes, "print").select(
        key, F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_copies(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of the rows whose fingerprints links connect, one
    stays, that with the smallest key, NULL last; of rows that share the key any one."""
    place = docs.columns.index(text)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces([_with_text(batch, place)], "t"):
                column = part.column("t").cast(pa.large_binary()).to_pylist()
                found = np.array([fingerprint(t, width) for t in column], np.uint64)
                row = pa.StructArray.from_arrays(part.columns[:-1], fields=list(batch.schema))
                yield pa.RecordBatch.from_arrays([row, pa.array(found.view(np.int64))], ["row", "print"])

    # Numbered as written, so that a row keeps its number.
    rows = pin(docs.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id()), "prints")
    own = F.col("row")[key]
    first = rows.groupBy("print").agg(F.min(F.struct(own.isNull().alias("none"), own.alias("key"), "at")).alias("first"))
    linked = components(links(rows, radius)).select(F.col("node").alias("print"), "component")
    reach = first.join(linked, "print", "left").withColumn("component", F.coalesce("component", "print"))
    stay = reach.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.at").alias("at"))
    return rows.join(stay, "at", "left_semi").select("row.*")


def _with_text(batch: pa.RecordBatch, place: int) -> pa.RecordBatch:
    """The columns under their places, and ``t``, the text without NULLs."""
    names = [*map(str, range(batch.num_columns)), "t"]
    return pa.RecordBatch.from_arrays([*batch.columns, pc.fill_null(batch.column(place), "")], names)
