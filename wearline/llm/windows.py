"""Where runs of symbols in a document also start in an earlier document.

Both substring operators use this: their symbols are bytes or words, their windows 50 or 13 of
them. It brings the places where two documents may share a window together in one task; whether
they do is found there by the operator's own index (``Finder.first``).

1. Anchors. A window's anchor is its gram of ``gram`` symbols with the least hash (the first of
   equal ones). Equal windows have equal anchors at equal places, so only anchors have to meet.
   The windows of an anchor follow one another; their span is the anchor's context.
2. Filter. Every task sends each gram's hash, with the order of its number there, once for each
   block of documents to the hash's bucket; grams that occur in two documents come back to the
   blocks. Grams that a task itself sees in two documents come back at once, so that a gram found
   everywhere sends one entry per task. The filter only leaves out grams of one document. Grams
   with more than ``MANY`` anchors are listed: their windows are dealt out one by one, by a hash of
   the whole window, over as many parts as they need, so that a phrase found everywhere with
   different surroundings is no heap; equal windows meet as before.
3. Contexts. A block sends its distinct contexts around shared grams, with the least key, to
   the gram's bucket. There the index finds, for every window of every context, the least key
   that has it, and sends it back where it is smaller than the block's own.
4. Removal. A block removes what the windows with a smaller key cover.

Whole copies are found first, by their digests, and take part with their smallest key only.
Documents travel twice, dealt out by a hash of key and text into blocks of about ``BLOCK_BYTES``;
blocks and buckets grow in number, not in size. Of rows that share key and text and are more than
one of ``HOT`` of all, one takes part and its result counts for all of them. The index of a bucket
takes ``ROOM`` contexts at a time. Nothing is collected by the driver but two sums.

NULL texts count as empty; a NULL key counts as smaller than any other and comes back as NULL.
Rows that share a key do not remove from each other. A text is read whole by one task, which holds
some 40 bytes for each byte (or 100 for each word) of its longest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from . import files
from .common import HOT as HOT_ROWS
from .common import partitions_for, pieces, spread_join, texts

BLOCK_BYTES = 6 << 20
CHUNK_BYTES = 12 << 20
PIECE = 1 << 19
#: Symbols whose places are packed with a hash, 2^24 at most; longer pieces are cut into slices.
PLACES = 1 << 22
NO_KEY = -(1 << 63)
#: Anchors of one gram that stay together, and contexts that an index holds.
MANY, ROOM = 16_384, 32_768

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Finder:
    """What differs between the operators.

    ``symbols`` gives a hash per symbol of joined texts, the texts' starts in symbols, and the
    symbols themselves. ``rows`` lays the contexts of anchors out, one a row of ``width`` places
    with the anchor at place ``reach - 1``; ``folded`` gives such rows as columns of 64-bit
    numbers, ``pack`` and ``unpack`` turn them into bytes and back. ``first`` is the index:
    (rows, first and last offset, keys) to (row, offset, least key) of every window, an offset
    being the distance from a window's start to its anchor. ``kept`` gives the result columns
    of a piece: (symbols themselves, starts, covered).
    """

    window: int
    gram: int
    symbols: Callable
    rows: Callable
    folded: Callable
    pack: Callable
    unpack: Callable
    first: Callable
    kept: Callable
    schema: str

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1

    @property
    def width(self) -> int:
        return self.window + self.reach - 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    return x ^ (x >> np.uint64(29))


def grams(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` symbols from each place on; the last places are not filled."""
    n = len(symbols)
    out, done, power, step = np.zeros(n, np.uint64), 0, symbols, 1
    while True:
        if size & step:
            # What is done covers `done` symbols; the next `step` follow behind it.
            tail = np.zeros(n, np.uint64)
            tail[: n - done] = power[done:]
            out = out * _odd(step) + tail
            done += step
        if step * 2 > size:
            return mixed(out)
        longer = power * _odd(step)
        longer[: n - step] += power[step:]
        power, step = longer, step * 2


def _odd(step: int) -> np.uint64:
    return np.uint64(pow(int(_MIX), step, 1 << 64))


@dataclass
class Anchors:
    """Place, row, gram hash and first and last window of each anchor."""

    at: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def of(self, mask: np.ndarray) -> Anchors:
        return Anchors(self.at[mask], self.row[mask], self.hash[mask], self.first[mask], self.last[mask])


def anchors(symbols: np.ndarray, starts: np.ndarray, window: int, gram: int) -> Anchors:
    """The anchors of all windows, in slices that overlap by a window less one symbol; a run of
    windows that goes on behind a slice's edge is one anchor again."""
    n, step = len(symbols), PLACES - window + 1
    if n <= PLACES:
        return _anchors(symbols, starts, window, gram)
    parts = []
    for base in range(0, n - window + 1, step):
        inner = np.clip(starts - base, 0, min(PLACES, n - base))
        found = _anchors(symbols[base : base + PLACES], inner, window, gram)
        row = np.searchsorted(starts, found.first + base, side="right") - 1
        parts.append(Anchors(found.at + base, row, found.hash, found.first + base, found.last + base))
    at, row, hashes, first, last = (np.concatenate([getattr(p, f) for p in parts]) for f in ("at", "row", "hash", "first", "last"))
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
    ends = np.append(new[1:], len(at)) - 1 if len(at) else new
    return Anchors(at[new], row[new], hashes[new], first[new], last[ends])


def _anchors(symbols: np.ndarray, starts: np.ndarray, window: int, gram: int) -> Anchors:
    n, reach = len(symbols), window - gram + 1
    if n < window:
        empty = np.empty(0, np.int64)
        return Anchors(empty, empty, empty.astype(np.uint64), empty, empty)
    hashes = grams(symbols, gram)
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= reach:
        least[:-span] = np.minimum(least[:-span], least[span:])
        span *= 2
    if reach > span:
        rest = reach - span
        least[:-rest] = np.minimum(least[:-rest], least[rest:])
    ends = np.repeat(starts[1:], np.diff(starts))
    places = np.flatnonzero(ends - np.arange(n) >= window)
    at = (least[places] & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
    first = places[new]
    last = places[np.append(new[1:], len(at)) - 1] if len(at) else first
    at = at[new]
    row = np.searchsorted(starts, first, side="right") - 1
    return Anchors(at, row, hashes[at], first, last)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _ident(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and the low half of the hash: what the filter tells grams apart by."""
    return (_bucket(hashes, buckets).astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _cuts(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values))


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


# Replies to a block, by kind: a copy's key and digest; grams of a bucket (low halves); grams;
# runs of windows in contexts of a bucket. Beside them frequent grams, with their number of parts.
REPLY = "block long, kind int, number long, body binary"
COPY, GRAMS, GRAM_IDS, FIRSTS, HOT = 0, 1, 2, 3, 4


CONTEXTS = "bucket long, block long, hashes binary, grams binary, spans binary, keys binary, rows binary"
CONTEXT_FIELDS = [("bucket", pa.int64()), ("block", pa.int64())] + [
    (name, pa.binary()) for name in ("hashes", "grams", "spans", "keys", "rows")
]
RUN = np.dtype([("place", "<u4"), ("low", "u1"), ("high", "u1"), ("key", "<i8")])


def _replies(block, kind: int, number, body) -> pa.Table:
    columns = {
        "block": (block, pa.int64()),
        "kind": ([kind] * len(body), pa.int32()),
        "number": (number, pa.int64()),
        "body": (body, pa.binary()),
    }
    return pa.Table.from_batches([_batch(columns)])


def remove_repeats(docs: DataFrame, finder: Finder, key: str = "doc_id", text: str = "text", many: int = MANY) -> DataFrame:
    """``key`` and the columns of ``finder.schema`` for every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()
    own = F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY))
    same = F.md5(F.col(text).cast("binary"))
    rows = texts(docs, key, text).select(F.col(key).alias("k"), F.col(text).alias("text"), own.alias("id"), same.alias("same"))
    pairs = rows.groupBy("id", "same", F.octet_length("text").alias("n")).agg(F.count("*").alias("times"))
    pairs = pin(pairs, "digests")
    total, count = (x or 0 for x in pairs.agg(F.sum(F.col("n") * F.col("times")), F.sum("times")).first())
    blocks = int(max(partitions_for(docs), -(-total // BLOCK_BYTES)))
    block = F.pmod(F.xxhash64("id", "same"), F.lit(blocks)).alias("block")
    shared = pairs.groupBy("same", "n").agg(F.min("id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    copies = (
        spread_join(pairs, shared, ["same", "n"], "rows")
        .filter("id > first")
        .select(block, F.lit(COPY).alias("kind"), F.col("id").alias("number"), F.unhex("same").alias("body"))
    )
    # Less than HOT_ROWS pairs of key and text are so frequent.
    often = pin(pairs.filter(F.col("times") * HOT_ROWS > count + HOT_ROWS).select("id", "same", "times"), "often")
    alone = often.isEmpty()
    if not alone:
        one = rows.join(F.broadcast(often), ["id", "same"]).groupBy("id", "same").agg(*[F.first(c).alias(c) for c in ("k", "text")])
        rest = rows.join(F.broadcast(often.drop("times")), ["id", "same"], "left_anti")
        rows = rest.unionByName(pin(one, "once").select(*rest.columns))

    sent = rows.select("id", "text", block).mapInArrow(
        lambda batches: _send_grams(batches, finder, "text", blocks), "bucket long, body binary"
    )
    known = pin(copies.unionByName(sent.groupBy("bucket").applyInArrow(lambda t: _shared_grams(t, many), REPLY)), "known")
    hot = known.filter(F.col("kind") == HOT).select(F.concat_ws(" ", F.col("number"), F.col("body").cast("string")))
    hot = files.listed(hot, files.folder(docs.sparkSession, "hot"))
    known = known.filter(F.col("kind") != HOT)

    placed = rows.select("k", "id", "same", "text", block)
    contexts = (
        placed.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(lambda a, b: _send_contexts(a, b, finder, blocks, hot), CONTEXTS)
    )
    firsts = contexts.groupBy("bucket").applyInArrow(lambda t: _first_keys(t, finder), REPLY)
    found = (
        placed.groupBy("block")
        .cogroup(known.unionByName(pin(firsts, "firsts")).groupBy("block"))
        .applyInArrow(lambda a, b: _remove(a, b, finder, blocks, hot), f"k {kind}, id long, same string, {finder.schema}")
    )
    if not alone:
        every = found.join(F.broadcast(often), ["id", "same"], "left")
        found = every.withColumn("times", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1))))).drop("times")
    return found.drop("id", "same").withColumnRenamed("k", key)


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.Table]:
    held, size = [], 0
    for piece in pieces(batches, text):
        held.append(piece)
        size += piece.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _send_grams(batches: Iterator[pa.RecordBatch], finder: Finder, text: str, blocks: int) -> Iterator[pa.RecordBatch]:
    """Entries (gram, block) of each bucket, and under -1 - block the grams known as shared."""
    for chunk in _chunks(batches, text):
        ids, of_block = chunk["id"].to_numpy(), chunk["block"].to_numpy()
        gram, row, base = [], [], 0
        for piece in pieces(chunk.to_batches(), text, PIECE):
            symbols, starts, _ = finder.symbols(piece.column(text))
            a = anchors(symbols, starts, finder.window, finder.gram)
            gram.append(_ident(a.hash, blocks))
            row.append(a.row + base)
            base += piece.num_rows
        gram, row = np.concatenate(gram), np.concatenate(row)
        if not len(gram):
            continue
        order = np.argsort(gram, kind="stable")
        gram, row = gram[order], row[order]
        cuts = _cuts(gram)
        # One entry a gram, be it in one document or in many.
        entry, where = gram[cuts[:-1]], of_block[row[cuts[:-1]]].astype(np.uint32)
        bucket = (entry >> np.uint64(32)).astype(np.int64)
        low = entry.astype(np.uint32)
        # The least power of two that is not below the number of anchors.
        order = np.ceil(np.log2(np.diff(cuts))).astype(np.uint8)
        parts = _cuts(bucket)
        bodies = [low[a:b].tobytes() + where[a:b].tobytes() + order[a:b].tobytes() for a, b in zip(parts, parts[1:])]
        yield _batch({"bucket": (bucket[parts[:-1]], pa.int64()), "body": (bodies, pa.binary())})
        own = ids[row]
        several = np.minimum.reduceat(own, cuts[:-1]) < np.maximum.reduceat(own, cuts[:-1])
        here = np.repeat(several, np.diff(cuts))
        target, gram = of_block[row[here]], gram[here]
        order = np.argsort(target, kind="stable")
        target, gram = target[order], gram[order]
        parts = _cuts(target)
        bodies = [np.unique(gram[a:b]).tobytes() for a, b in zip(parts, parts[1:])]
        yield _batch({"bucket": (-1 - target[parts[:-1]], pa.int64()), "body": (bodies, pa.binary())})


def _shared_grams(table: pa.Table, many: int) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    bodies = table["body"].to_pylist()
    if bucket < 0:
        known = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in bodies]))
        return _replies([-1 - bucket], GRAM_IDS, [0], [known.tobytes()])
    sizes = [len(b) // 9 for b in bodies]
    gram = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(bodies, sizes)])
    block = np.concatenate([np.frombuffer(b, np.uint32, n, 4 * n) for b, n in zip(bodies, sizes)])
    number = np.int64(1) << np.concatenate([np.frombuffer(b, np.uint8, n, 8 * n) for b, n in zip(bodies, sizes)]).astype(np.int64)
    order = np.argsort(gram, kind="stable")
    gram, block = gram[order], block[order].astype(np.int64)
    cuts = _cuts(gram)
    number = np.add.reduceat(number[order], cuts[:-1])
    hot = np.flatnonzero(number > many)
    # An anchor has half of the reach of windows on average; more parts do no harm.
    listed = [((bucket << 32) | int(g), str(-(-int(n) * 16 // many))) for g, n in zip(gram[cuts[hot]], number[hot])]
    shared = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    gram, block = gram[shared], block[shared]
    order = np.argsort(block, kind="stable")
    gram, block = gram[order], block[order]
    cuts = _cuts(block)
    bodies = [gram[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    replies = _replies(block[cuts[:-1]], GRAMS, np.full(len(bodies), bucket), bodies)
    frequent = _replies([-1] * len(listed), HOT, [x for x, _ in listed], [n.encode() for _, n in listed])
    return pa.concat_tables([replies, frequent])


@dataclass
class Block:
    """A block's documents by pieces, and its distinct contexts by bucket and hash."""

    pieces: list[tuple]
    copies: list[np.ndarray]
    anchors: list[Anchors]
    context: list[np.ndarray]
    bucket: np.ndarray
    hash: np.ndarray
    gram: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    rows: np.ndarray


@lru_cache(4)
def _frequent(listed: str) -> tuple[np.ndarray, np.ndarray]:
    """Frequent grams in ascending order, and their numbers of parts."""
    found = np.array([line.split() for line in files.lines(listed)], np.int64).reshape(-1, 2)
    return tuple(found[np.argsort(found[:, 0])].T)


def _parted(a: Anchors, symbols: np.ndarray, finder: Finder, blocks: int, listed: str) -> Anchors:
    """Anchors of frequent grams with one window each, under a hash of the gram and its part."""
    grams_, parts = _frequent(listed)
    if not len(grams_) or not len(a.at):
        return a
    ident = _ident(a.hash, blocks).astype(np.int64)
    at = np.minimum(np.searchsorted(grams_, ident), len(grams_) - 1)
    hot = grams_[at] == ident
    if not hot.any():
        return a
    whole = grams(symbols, finder.window)
    size = np.where(hot, a.last - a.first + 1, 1)
    of = np.repeat(np.arange(len(size)), size)
    window = a.first[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    hashes = a.hash[of]
    own = hot[of]
    part = mixed(whole[window[own]] + _MIX) % parts[at[of[own]]].astype(np.uint64)
    hashes[own] = mixed(hashes[own] + (part + np.uint64(1)) * _MIX)
    return Anchors(a.at[of], a.row[of], hashes, np.where(own, window, a.first[of]), np.where(own, window, a.last[of]))


def _read_block(docs: pa.Table, replies: pa.Table, finder: Finder, blocks: int, listed: str) -> Block:
    kinds, numbers, bodies = (replies[c].to_pylist() for c in ("kind", "number", "body"))
    copies = {(n, b) for k, n, b in zip(kinds, numbers, bodies) if k == COPY}
    copied = {n for n, _ in copies}
    known = [np.frombuffer(b, np.uint64) for k, b in zip(kinds, bodies) if k == GRAM_IDS]
    known += [
        np.frombuffer(b, np.uint32).astype(np.uint64) | np.uint64(n << 32)
        for k, n, b in zip(kinds, numbers, bodies)
        if k == GRAMS
    ]
    known = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
    found = Block([], [], [], [], *[np.empty(0)] * 7)
    parts = []
    for piece in pieces(docs.to_batches(), "text", PIECE):
        symbols, starts, own = finder.symbols(piece.column("text"))
        ids = piece.column("id").to_numpy()
        copy = np.zeros(len(ids), bool)
        for i in np.flatnonzero([x in copied for x in ids.tolist()]):
            body = hashlib.md5(piece.column("text")[int(i)].as_py().encode()).digest()
            copy[i] = (int(ids[i]), body) in copies
        a = anchors(symbols, starts, finder.window, finder.gram)
        ident = _ident(a.hash, blocks)
        at = np.searchsorted(known, ident)
        hit = at < len(known)
        hit[hit] = known[at[hit]] == ident[hit]
        a = _parted(a.of(hit & ~copy[a.row]), symbols, finder, blocks, listed)
        rows = finder.rows(own, a)
        low, high = a.at - a.last, a.at - a.first
        fold = mixed(a.hash + low.astype(np.uint64) * np.uint64(257) + high.astype(np.uint64))
        for column in finder.folded(rows).T:
            fold = mixed(fold * _MIX + column)
        found.pieces.append((piece, ids, starts, own))
        found.copies.append(copy)
        found.anchors.append(a)
        parts.append((fold, a.hash, low, high, ids[a.row], rows))
    if not parts:
        return found
    sizes = [len(p[0]) for p in parts]
    fold, gram, low, high, ids, rows = (np.concatenate(x) for x in zip(*parts))
    bucket = _bucket(gram, blocks)
    order = np.lexsort((fold, bucket))
    new = np.append(True, fold[order][1:] != fold[order][:-1]) if len(order) else np.empty(0, bool)
    cuts = np.flatnonzero(new)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[cuts]
    found.bucket, found.hash, found.gram, found.rows = bucket[one], fold[one], gram[one], rows[one]
    found.low, found.high = low[one], high[one]
    found.least = np.minimum.reduceat(ids[order], cuts) if len(cuts) else ids
    found.context = np.split(number, np.cumsum(sizes)[:-1])
    return found


def _send_contexts(docs: pa.Table, replies: pa.Table, finder: Finder, blocks: int, listed: str) -> pa.Table:
    if not docs.num_rows:
        return pa.schema(CONTEXT_FIELDS).empty_table()
    block = docs["block"][0].as_py()
    b = _read_block(docs, replies, finder, blocks, listed)
    cuts = _cuts(b.bucket)
    spans = list(zip(cuts, cuts[1:]))
    columns = [
        b.bucket[cuts[:-1]],
        np.full(len(spans), block),
        [b.hash[x:y].tobytes() for x, y in spans],
        [b.gram[x:y].tobytes() for x, y in spans],
        [(b.low[x:y] | b.high[x:y] << 8).astype(np.uint16).tobytes() for x, y in spans],
        [b.least[x:y].tobytes() for x, y in spans],
        [finder.pack(b.rows[x:y]) for x, y in spans],
    ]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, CONTEXT_FIELDS)], schema=pa.schema(CONTEXT_FIELDS)
    )


def _groups(values: np.ndarray) -> Iterator[slice]:
    """Slices of whole runs of equal neighbours, of up to ``ROOM`` values or one run."""
    cuts = _cuts(values)
    start = 0
    while start < len(values):
        fit = int(np.searchsorted(cuts, start + ROOM, side="right")) - 1
        stop = int(max(cuts[fit], cuts[np.searchsorted(cuts, start, side="right")]))
        yield slice(start, stop)
        start = stop


def _first_keys(table: pa.Table, finder: Finder) -> pa.Table:
    """Where contexts of a bucket hold windows that a smaller key has: per block, runs of
    (context, from offset, to offset, key)."""
    joined = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])
    hashes, gram, span, own = joined("hashes", np.uint64), joined("grams", np.uint64), joined("spans", np.uint16), joined("keys", np.int64)
    sizes = [len(x) // 8 for x in table["hashes"].to_pylist()]
    block = np.repeat(table["block"].to_numpy(), sizes)
    place = np.concatenate([np.arange(n) for n in sizes])
    rows = np.concatenate([finder.unpack(x) for x in table["rows"].to_pylist()])
    low, high = (span & 255).astype(np.int64), (span >> 8).astype(np.int64)

    order = np.lexsort((hashes, gram))
    new = np.append(True, hashes[order][1:] != hashes[order][:-1])
    cuts = np.flatnonzero(new)
    one = order[cuts]
    context = np.empty(len(order), np.int64)
    context[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(own[order], cuts)
    # A gram with one context needs no index: all its windows are those of the context.
    per_gram = np.diff(_cuts(gram[one]))
    several = np.flatnonzero(np.repeat(per_gram > 1, per_gram))
    first = np.repeat(least[:, None], finder.reach, axis=1)
    for own_ in _groups(gram[one][several]):
        part = several[own_]
        c, offset, key = finder.first(rows[one][part], low[one][part], high[one][part], least[part])
        first[part[c], offset] = key

    offsets = np.arange(finder.reach)
    bodies, blocks = [], []
    order = np.argsort(block, kind="stable")
    edges = _cuts(block[order])
    for x, y in zip(edges, edges[1:]):
        e = order[x:y]
        found = first[context[e]]
        smaller = (found < own[e][:, None]) & (offsets >= low[e][:, None]) & (offsets <= high[e][:, None])
        i, offset = np.nonzero(smaller)
        if not len(i):
            continue
        key, at = found[i, offset], place[e][i]
        new = np.append(True, (at[1:] != at[:-1]) | (offset[1:] != offset[:-1] + 1) | (key[1:] != key[:-1]))
        starts = np.flatnonzero(new)
        runs = np.zeros(len(starts), RUN)
        runs["place"], runs["low"], runs["key"] = at[starts], offset[starts], key[starts]
        runs["high"] = offset[np.append(starts[1:], len(i)) - 1]
        bodies.append(runs.tobytes())
        blocks.append(block[e[0]])
    return _replies(blocks, FIRSTS, [table["bucket"][0].as_py()] * len(blocks), bodies)


def _remove(docs: pa.Table, replies: pa.Table, finder: Finder, blocks: int, listed: str) -> pa.Table:
    out = []
    b = _read_block(docs, replies, finder, blocks, listed)
    first = np.repeat(b.least[:, None].astype(np.int64), finder.reach, axis=1)
    kinds, numbers, bodies = (replies[c].to_pylist() for c in ("kind", "number", "body"))
    for kind, bucket, body in zip(kinds, numbers, bodies):
        if kind == FIRSTS:
            base = int(np.searchsorted(b.bucket, bucket))
            runs = np.frombuffer(body, RUN)
            size = runs["high"].astype(np.int64) - runs["low"] + 1
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            first[np.repeat(runs["place"] + base, size), np.repeat(runs["low"], size) + inside] = np.repeat(runs["key"], size)
    for (piece, ids, starts, own), copy, a, context in zip(b.pieces, b.copies, b.anchors, b.context):
        edges = np.zeros(starts[-1] + 1, np.int32)
        size = a.last - a.first + 1
        window = np.repeat(a.first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        earlier = first[np.repeat(context, size), np.repeat(a.at, size) - window]
        gone = window[earlier < ids[np.repeat(a.row, size)]]
        np.add.at(edges, gone, 1)
        np.add.at(edges, gone + finder.window, -1)
        covered = np.cumsum(edges[:-1]) > 0
        lengths = np.diff(starts)
        covered |= np.repeat(copy & (lengths >= finder.window), lengths)
        columns = {"k": piece.column("k"), "id": piece.column("id"), "same": piece.column("same")} | finder.kept(own, starts, covered)
        out.append(pa.RecordBatch.from_pydict(columns))
    if not out:
        columns = finder.kept(*finder.symbols(pa.array([""]))[:0:-1], np.empty(0, bool))
        none = {c: pa.nulls(1, docs.schema.field(c).type) for c in ("k", "id", "same")}
        return pa.Table.from_pydict(none | columns).slice(0, 0)
    return pa.Table.from_batches(out)
