"""The model of ``kneser_ney`` learned from some rows and put to all of them in one shuffle.

``kneser_ney.learn`` keeps a model for texts to come: files with a hash for each distinct gram. Here
the texts are known beforehand, so each token is sent once, with the words before it, to where all
that its probability needs meets, and only what the discounts are put to afterwards is written.

1. Words of the learned texts are counted and numbered, the frequent ones first; files hold their
   hashes. Words without a number were not learned.
2. A token's grams of all sizes have contexts that end in the word before it. So tokens go to the bucket of
   that word, and all counts but those of single words are whole there. A context with more than
   a bucket's share of tokens is split: its tokens go to the buckets of the contexts that are
   longer by a word, of the longest ones anywhere. Single words follow the empty context, which is always split.
3. A bucket sorts its tokens by their words from the last one to the left, so that the grams of each size are
   runs, and counts them. Counts of grams behind split contexts are parts; they are added up by
   the last word, from the longest gram down, and lie in mapped files.
4. When the discounts are known, each bucket's runs are gone through from single words to whole grams, and
   the logarithms are added up by row.

A task holds a bucket, whose size has a bound. Words are known by 64-bit hashes. The driver holds the 65,536
most frequent words, the split contexts and the sums.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from . import files
from .common import partitions_for, pieces, raw_bytes
from .kneser_ney import BEGIN, END, OPEN, ORDER, discounts, joined, narrow
from .windows import mixed

# Of text for a bucket; tokens at a time; words or rows of sums that a task holds; tasks that add up rows at most.
BUCKET_BYTES = 4 << 20
CHUNK = 1 << 19
HELD = 1 << 20
SUMS = 16 << 20
SUM_TASKS = 8
#: Numbers of words: the begin, the end, one that was not learned, the frequent ones, the others.
BEGIN_ID, END_ID, UNKNOWN, FIRST = range(4)
FREQUENT = 1 << 16

# Words up to LONG bytes are hashed as polynomials, block by block; longer ones by XXH64.
BLOCK, LONG = 1 << 17, 64
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]
_POWERS, _BACK = (np.multiply.accumulate(np.array([1] + [x] * (BLOCK + LONG), np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z in lower case, and the number of words of each text."""
    data, offsets = raw_bytes(column)
    word = ~_BLANK[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    some = np.diff(offsets) > 0
    at = offsets[:-1][some]
    first[at] = word[at]
    at = offsets[1:][some] - 1
    last[at] = word[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = np.searchsorted(starts, base + BLOCK)
        own = data[base : base + BLOCK + LONG]
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_LETTERS[own] * _POWERS[: len(own)], out=sums[1:])
        a, b = starts[i:j] - base, np.minimum(ends[i:j], starts[i:j] + LONG) - base
        out[i:j] = (sums[b] - sums[a]) * _BACK[a]
        i = j
    out = mixed(out)
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes().lower())
    return out, np.diff(np.searchsorted(starts, offsets))


def _padded(words: np.ndarray, counts: np.ndarray, pads: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each behind ``pads`` begins and with an end; the places of no begins."""
    base = np.cumsum(counts + pads + 1) - counts - 1
    out = np.full(int((counts + pads + 1).sum()), BEGIN)
    places = np.repeat(base - (np.cumsum(counts + 1) - counts - 1), counts + 1) + np.arange(len(words) + len(counts))
    out[places] = END
    out[np.repeat(base - (np.cumsum(counts) - counts), counts) + np.arange(len(words))] = words
    return out, places


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Rows, the hashes of their words and how many each has, about ``CHUNK`` tokens at a time."""
    held, words, counts, size = [], [], [], 0
    for piece in pieces(batches, "text"):
        own, count = word_hashes(piece.column("text"))
        held.append(piece.drop_columns(["text"]))
        words.append(own)
        counts.append(count)
        size += len(own) + len(count)
        if size >= CHUNK:
            yield held, np.concatenate(words), np.concatenate(counts)
            held, words, counts, size = [], [], [], 0
    if held:
        yield held, np.concatenate(words), np.concatenate(counts)


def small(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the smallest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))), copy=False)


def squeezed(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays of whole numbers from 0 in the smallest types: the lowest bytes of all their numbers,
    then the next ones, each compressed by itself."""
    listed, planes = [], [[] for _ in range(8)]
    for name, a in arrays.items():
        a = np.ascontiguousarray(small(a))
        listed.append([name, a.itemsize, len(a)])
        for plane, own in zip(planes, a.view(np.uint8).reshape(len(a), a.itemsize).T):
            plane.append(own)
    planes = [np.concatenate(p) for p in planes if p]
    bodies = [pa.compress(p.tobytes(), "zstd", asbytes=True) for p in planes]
    head = json.dumps([listed, [[len(p), len(b)] for p, b in zip(planes, bodies)]]).encode()
    return b"".join([len(head).to_bytes(8, "little"), head, *bodies])


def loosened(body: bytes) -> dict[str, np.ndarray]:
    """What ``squeezed`` was given."""
    at = 8 + int.from_bytes(body[:8], "little")
    listed, sizes = json.loads(body[8:at])
    planes = []
    for whole, size in sizes:
        planes.append(np.frombuffer(pa.decompress(body[at : at + size], whole, "zstd", asbytes=True), np.uint8))
        at += size
    out, places = {}, [0] * len(planes)
    for name, width, count in listed:
        own = np.empty((count, width), np.uint8)
        for k in range(width):
            own[:, k] = planes[k][places[k] : places[k] + count]
            places[k] += count
        out[name] = own.view(f"<u{width}").ravel()
    return out


def _added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in ascending order, and the sums of the values of each."""
    order = np.argsort(keys)
    keys = keys[order]
    cuts = _starts(keys)
    return keys[cuts], *(np.add.reduceat(v[order].astype(np.int64), cuts) if len(cuts) else v[:0].astype(np.int64) for v in values)


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def _share(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash; parts are ranges of hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


# -- words -------------------------------------------------------------------------

COUNTED = "bucket long, body binary"


def _contexts(tokens: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words before the places."""
    return joined(np.stack([tokens[places - back] for back in range(size, 0, -1)], axis=1)) + np.uint64(size)


def _ranges(keys: np.ndarray, counts: np.ndarray, parts: int, mark) -> pa.RecordBatch:
    """A row for each part of ascending keys."""
    share = _share(keys, parts)
    cuts = [*_starts(share), len(keys)]
    bodies = [squeezed({"keys": np.diff(keys[a:b], prepend=np.uint64(0)), "counts": counts[a:b]}) for a, b in zip(cuts, cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(mark(share[cuts[:-1]]), pa.int64()), pa.array(bodies, pa.binary())], ["bucket", "body"])


def _count_words(batches: Iterator[pa.RecordBatch], order: int, buckets: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Words with their counts, and under negative buckets the contexts that are frequent in a chunk."""
    held, size = [], 0
    for _, words, counts in _chunks(batches):
        tokens, places = _padded(words, counts, order - 1)
        held.append(np.unique(tokens[places], return_counts=True))
        size += len(held[-1][0])
        if size >= HELD:
            held = [_added(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
            if size >= HELD // 2:
                yield _ranges(*held.pop(), parts, lambda b: b)
                size = 0
        least = len(places) // (4 * buckets)
        for length in range(1, order):
            hashes = _contexts(tokens, places, length)
            keys, back, many = np.unique(hashes, return_inverse=True, return_counts=True)
            kept = many > least
            places = places[kept[back]]
            if not len(places):
                break
            yield _ranges(keys[kept], many[kept], parts, lambda b: -1 - b)
    if held:
        yield _ranges(*_added(*map(np.concatenate, zip(*held))), parts, lambda b: b)


MADE = "bucket long, uri string, words long, tokens long, keys array<bigint>, counts array<bigint>"


def _add_words(table: pa.Table, uri: str, top: int, least: int) -> pa.Table:
    """The file of a part of the words and its frequent words; or the split ones of a part of the contexts."""
    bucket = table["bucket"][0].as_py()
    found = [loosened(body) for body in table["body"].to_pylist()]
    keys, counts = _added(np.concatenate([np.cumsum(x["keys"], dtype=np.uint64) for x in found]), np.concatenate([x["counts"] for x in found]))
    row = {"bucket": [bucket], "uri": [None], "words": [None], "tokens": [None]}
    if bucket < 0:
        kept = np.flatnonzero(counts > least)
    else:
        name = files.write(uri, files.pack({"words": keys, "raw": narrow(counts)}), ".words")
        row |= {"uri": [name], "words": [len(keys)], "tokens": [int(counts.sum())]}
        kept = np.lexsort((keys, -counts))[:top]
    row |= {"keys": [keys[kept].view(np.int64)], "counts": [counts[kept]]}
    kinds = [("bucket", pa.int64()), ("uri", pa.string()), ("words", pa.int64()), ("tokens", pa.int64())]
    return pa.table(row, pa.schema([*kinds, ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]))


@lru_cache(OPEN)
def _opened(uri: str) -> dict[str, np.ndarray]:
    return files.unpack(files.mapped(uri))


@dataclass(frozen=True)
class Words:
    """Numbers and counts of words: the frequent ones, and a file and the first number for each part."""

    parts: int
    keys: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    uris: dict[int, tuple[str, int]]
    words: int
    tokens: int

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of ascending hashes."""
        ids, raw = np.full(len(hashes), UNKNOWN, np.uint32), np.zeros(len(hashes), np.int64)
        share = _share(hashes, self.parts)
        cuts = [*_starts(share), len(hashes)]
        for a, b in zip(cuts, cuts[1:]):
            uri, base = self.uris.get(int(share[a]), (None, 0))
            if uri is None:
                continue
            file = _opened(uri)
            at = np.minimum(np.searchsorted(file["words"], hashes[a:b]), len(file["words"]) - 1)
            hit = np.flatnonzero(file["words"][at] == hashes[a:b])
            ids[a + hit] = base + at[hit]
            raw[a + hit] = file["raw"][at[hit]]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            ids[hit] = self.ids[at[hit]]
        ids[hashes == END] = END_ID
        ids[hashes == BEGIN] = BEGIN_ID
        return ids, raw


# -- tokens ------------------------------------------------------------------------

INFO = ["n_tokens", "n_known", "base_score"]


def _depths(tokens: np.ndarray, places: np.ndarray, ids: np.ndarray, order: int, split: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The size of the shortest context of each token that is not split (``order`` if all are),
    and its bucket. Tokens behind words that were not learned go anywhere."""
    depth = np.ones(len(places), np.uint8)
    key = np.zeros(len(places), np.uint64)
    rest = np.arange(len(places))
    for size in range(1, order):
        own = _contexts(tokens, places[rest], size)
        key[rest] = own
        if not len(split):
            break
        at = np.minimum(np.searchsorted(split, own), len(split) - 1)
        rest = rest[split[at] == own]
        if not len(rest):
            break
        depth[rest] = size + 1
    anywhere = (depth == order) | (ids[places - 1] == UNKNOWN)
    key[anywhere] = np.flatnonzero(anywhere).astype(np.uint64) * np.uint64(_BASE)
    return depth, (mixed(key) % np.uint64(buckets)).astype(np.int64)


def _send(batches: Iterator[pa.RecordBatch], order: int, buckets: int, words: Words, split: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Tokens by bucket with the words before them, and under negative buckets the rows themselves."""
    number = TaskContext.get().partitionId() << 40
    low = words.tokens + 1 * (words.words + 1)
    for held, hashes, counts in _chunks(batches):
        tokens, places = _padded(hashes, counts, order - 1)
        distinct, back = np.unique(tokens, return_inverse=True)
        ids, raw = words.find(distinct)
        ids, raw = ids[back], raw[back[places]]
        depth, bucket = _depths(tokens, places, ids, order, split, buckets)
        del distinct, back, tokens, hashes
        sizes = counts + 1
        rows = pa.Table.from_batches(held).combine_chunks()
        learned = ~rows["f"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        kind = np.min_scalar_type(buckets)
        by = np.argsort(bucket.astype(kind), kind="stable")
        cuts = [*_starts(bucket[by]), len(by)]
        bodies = []
        for a, b in zip(cuts, cuts[1:]):
            at = by[a:b]
            own_rows = row[at]
            first = _starts(own_rows)
            arrays = {f"w{back}": ids[places[at] - back] for back in range(order)}
            # Of the words before the last a bucket has few.
            own, arrays["w1"] = np.unique(arrays["w1"], return_inverse=True)
            arrays["own"] = np.diff(own, prepend=np.uint32(0))
            arrays["depth"] = depth[at]
            arrays["rows"] = np.diff(own_rows[first], prepend=np.uint32(0))
            arrays["runs"] = np.diff(np.append(first, len(at)))
            arrays["learned"] = learned[own_rows[first]].astype(np.uint8)
            arrays["number"] = np.array([number], np.int64)
            bodies.append(squeezed(arrays))
        yield _sent(bucket=bucket[by[cuts[:-1]]], body=bodies, length=len(bodies), like=rows)
        starts = np.cumsum(sizes) - sizes
        known, base = (np.add.reduceat(x, starts) for x in ((raw > 0).astype(np.int64), np.log10((raw + 1) / low)))
        numbers = number + np.arange(len(sizes))
        yield _sent(bucket=-1 - numbers % buckets, row=numbers, k=rows["k"], f=rows["f"], n_tokens=sizes, n_known=known, base_score=base, length=len(sizes), like=rows)
        number += len(sizes)


def _sent(length: int, like: pa.Table, **columns) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "body": pa.binary(), "row": pa.int64(), "k": like.schema.field("k").type, "f": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64()}
    own = [columns.get(n) for n in kinds]
    arrays = [pa.nulls(length, t) if c is None else c.combine_chunks().cast(t) if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip(own, kinds.values())]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


# -- buckets -----------------------------------------------------------------------


def sorted_runs(columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of rows by several columns of numbers below 2^32, and for each number of columns where
    a run of equal ones begins. Rows that differ already are not compared on."""
    count = len(columns[0])
    key = columns[0].astype(np.uint64) << np.uint64(32)
    if len(columns) > 1:
        key |= columns[1]
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    top = key >> np.uint64(32)
    runs = [np.append(True, top[1:] != top[:-1]), new]
    for column in columns[2:]:
        new = new.copy()
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if len(tied):
            key = np.cumsum(new, dtype=np.uint64)[tied] << np.uint64(32)
            key |= column[order[tied]]
            by = np.argsort(key)
            order[tied] = order[tied[by]]
            key = key[by]
            new[tied[1:]] |= key[1:] != key[:-1]
        runs.append(new)
    return order, [r[:count] for r in runs[: len(columns)]]


def _stats(counts: np.ndarray) -> list[int]:
    """The numbers of counts of 1, 2, 3, 4, of 3 and more, and the counts' sum."""
    n = np.bincount(np.minimum(counts, 5), minlength=6)
    return [*map(int, n[1:5]), int(n[3:].sum()), int(counts.sum())]


def _sums(counts: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A row for each run of counts: their sum, and how many are 1, 2 and more."""
    return np.stack([np.add.reduceat(x, cuts, dtype=np.int64) for x in (counts, counts == 1, counts == 2, counts >= 3)], axis=1)


def _of_bucket(table: pa.Table, order: int, tables: int) -> pa.Table:
    """What a bucket's tokens need for their probabilities, parts of the counts behind split
    contexts by the last word, and the sums of the others; rows pass by."""
    made = [("table", pa.int64()), ("part", pa.binary()), ("stats", pa.list_(pa.int64()))]
    kinds, bucket = pa.schema([*table.schema, *made]), table["bucket"][0].as_py()
    if bucket < 0:
        for name, own in made:
            table = table.append_column(name, pa.nulls(len(table), own))
        return table
    found = [loosened(body) for body in table["body"].to_pylist()]
    del table
    for x in found:
        x["w1"] = np.cumsum(x["own"], dtype=np.uint32)[x["w1"]]
    words = [np.concatenate([x[f"w{back}"].astype(np.uint32) for x in found]) for back in range(order)]
    depth = np.concatenate([x["depth"] for x in found])
    runs = np.concatenate([x["runs"].astype(np.int64) for x in found])
    learned = np.repeat(np.concatenate([x["learned"] for x in found]), runs)
    row = np.repeat(np.concatenate([x["number"][0].astype(np.int64) + np.cumsum(x["rows"].astype(np.int64)) for x in found]), runs)
    del found

    by, new = sorted_runs(words)
    words, depth, learned = [w[by] for w in words], depth[by], learned[by]
    rows, row = np.unique(row, return_inverse=True)
    arrays = {"rows": np.diff(rows, prepend=0), "row": small(row)[by]}
    del row, by
    first = [np.flatnonzero(n).astype(np.int32) for n in new]
    # Grams of each size by number of words: the place of a run's first token, its count, its context's split.
    counts, split = [None] * order, [depth[at] > size for size, at in enumerate(first)]
    counts[-1] = small(np.add.reduceat(learned, first[-1], dtype=np.int64))
    numbers = [np.cumsum(n, dtype=np.int32) - 1 for n in new]
    for size in range(order - 2, -1, -1):
        alive = (counts[size + 1] > 0) & ~split[size + 1]
        counts[size] = small(np.add.reduceat(alive, numbers[size + 1][first[size]], dtype=np.int64))
    for size in range(order):
        last = size == order - 1
        edges = first[size] if last else numbers[size + 1][first[size]]
        arrays[f"runs{size}"] = small(np.diff(np.append(edges, len(depth) if last else len(first[size + 1]))))
    arrays["words"] = np.diff(words[0][first[0]].astype(np.int64), prepend=0)

    # Contexts: the first tokens of whole grams by the words before the last.
    context, starts = sorted_runs([w[first[-1]] for w in words[1:]])
    context = context.astype(np.int32)
    stats, parts = [], []
    for size in range(order):
        own, count, at = split[size], counts[size], first[size]
        stats += _stats(count[~own])
        sent = np.flatnonzero(own & (count > 0))
        parts.append((sent, at[sent]))
        if not size:
            continue
        arrays[f"count{size}"] = np.where(own, 0, count)
        arrays[f"split{size}"] = own.astype(np.uint8)
        # In the order of contexts, each gram of this size once.
        kept = new[size][first[-1]][context]
        member = numbers[size][first[-1][context[kept]]]
        group = np.cumsum(starts[size - 1], dtype=np.int32)[kept]
        cuts = _starts(group)
        sums = _sums(count[member], cuts)
        # Most contexts are one of the same few sums: 0 for none, 1 for a single count of 1, the others by number.
        code = np.where(sums[:, 0] == 0, 0, 1)
        other = np.flatnonzero((sums[:, 0] > 1) | ((sums[:, 0] == 1) & (sums[:, 1] != 1)))
        if len(other):
            distinct, back, many = np.unique(joined(sums[other].astype(np.uint64)), return_inverse=True, return_counts=True)
            rank = np.argsort(-many, kind="stable")
            place = np.empty(len(rank), np.int64)
            place[rank] = np.arange(len(rank))
            code[other] = place[back] + 2
            listed = np.empty((len(rank), 4), np.int64)
            listed[place[back]] = sums[other]
        else:
            listed = np.empty((0, 4), np.int64)
        for n, column in zip(("total", "n1", "n2", "n3"), listed.T):
            arrays[f"{n}{size}"] = column
        codes = np.empty(len(at), np.int32)
        codes[member] = np.repeat(code, np.diff(np.append(cuts, len(group))))
        codes[own] = 0
        arrays[f"code{size}"] = small(codes)
        marked = at[own]
        _, place, back = np.unique(_gram(words[1:], marked, size), return_index=True, return_inverse=True)
        arrays[f"context{size}"] = small(back)
        for k in range(1, size + 1):
            arrays[f"w{size}_{k}"] = words[k][marked[place]]
    out = [{"bucket": bucket, "body": squeezed(arrays), "stats": stats}]
    del arrays
    for t, part in _parts(words, counts, parts, tables):
        out.append({"table": t, "part": part})
    return pa.Table.from_pylist(out, kinds)


def _gram(words: list[np.ndarray], at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the grams of ``size`` words at places, from the numbers of their words."""
    # Numbers are small, so they are spread first.
    spread = [mixed((words[back][at].astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)) for back in reversed(range(size))]
    return mixed(joined(np.stack(spread, axis=1)) + np.uint64(size))


def _parts(words: list[np.ndarray], counts: list[np.ndarray], parts: list, tables: int) -> Iterator[tuple[int, bytes]]:
    """Counts of grams behind split contexts for each table, by their last word."""
    cut = []
    for size, (sent, at) in enumerate(parts):
        to = (mixed(words[0][at].astype(np.uint64)) % np.uint64(tables)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        cut.append((sent[by], at[by], np.searchsorted(to[by], np.arange(tables + 1))))
    for t in range(tables):
        arrays = {}
        for size, (sent, at, edges) in enumerate(cut):
            own, place = sent[edges[t] : edges[t + 1]], at[edges[t] : edges[t + 1]]
            arrays[f"count{size}"] = counts[size][own]
            for back in range(size + 1):
                arrays[f"w{size}_{back}"] = words[back][place]
            arrays[f"w{size}_0"] = np.diff(arrays[f"w{size}_0"], prepend=np.uint32(0))
        if any(len(a) for a in arrays.values()):
            yield t, squeezed(arrays)


SUMMED = "table long, uri string, stats array<bigint>, context long, sums array<bigint>"


def _of_table(table: pa.Table, order: int, uri: str) -> pa.Table:
    """A file of the counts behind split contexts, their sums, and the sums of each split context."""
    found = [loosened(part) for part in table["part"].to_pylist()]
    for x in found:
        x |= {f"w{size}_0": np.cumsum(x[f"w{size}_0"], dtype=np.uint32) for size in range(order)}
    number = table["table"][0].as_py()
    arrays, stats, rows = {}, [0] * (6 * order), []
    longer = None
    for size in range(order - 1, -1, -1):
        words = [np.concatenate([x[f"w{size}_{back}"].astype(np.uint32) for x in found]) for back in range(size + 1)]
        count = np.concatenate([x[f"count{size}"].astype(np.int64) for x in found])
        if longer is not None:
            words = [np.concatenate([w, x]) for w, x in zip(words, longer)]
            count = np.append(count, np.ones(len(longer[0]), np.int64))
        by, new = sorted_runs(words)
        at = np.flatnonzero(new[-1])
        count = np.add.reduceat(count[by], at) if len(at) else count
        words = [w[by[at]] for w in words]
        longer = words
        stats[6 * size : 6 * size + 6] = _stats(count)
        places = np.arange(len(count))
        keys = _gram(words, places, size + 1) if len(count) else np.empty(0, np.uint64)
        order_of = np.argsort(keys)
        arrays |= {f"gram{size}": keys[order_of], f"count{size}": narrow(count[order_of])}
        if size and len(count):
            contexts = _gram(words[1:], places, size)
            by = np.argsort(contexts)
            cuts = _starts(contexts[by])
            for key, own in zip(contexts[by][cuts].view(np.int64).tolist(), _sums(count[by], cuts).tolist()):
                rows.append({"context": key, "sums": own})
    name = files.write(uri, files.pack(arrays), ".counts")
    kinds = pa.schema([("table", pa.int64()), ("uri", pa.string()), ("stats", pa.list_(pa.int64())), ("context", pa.int64()), ("sums", pa.list_(pa.int64()))])
    return pa.Table.from_pylist([{"table": number, "uri": name, "stats": stats}, *rows], kinds)


# -- probabilities -----------------------------------------------------------------


@dataclass(frozen=True)
class Counts:
    """The sums of a model, its files of counts behind split contexts, and the sums of these contexts."""

    order: int
    words: int
    stats: list[list[int]]
    tables: int
    uris: dict[int, str]
    keys: np.ndarray
    sums: np.ndarray

    @cached_property
    def _discounts(self) -> list[np.ndarray]:
        return [discounts(s) for s in self.stats]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def find(self, size: int, keys: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The counts of grams behind split contexts, 0 for those that were not learned."""
        out = np.zeros(len(keys), np.int64)
        to = (mixed(last.astype(np.uint64)) % np.uint64(self.tables)).astype(np.int64)
        for t, uri in self.uris.items():
            own = np.flatnonzero(to == t)
            file = _opened(uri)
            known = file[f"gram{size}"]
            if not len(known) or not len(own):
                continue
            at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
            hit = known[at] == keys[own]
            out[own[hit]] = file[f"count{size}"][at[hit]]
        return out

    def _contexts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros((len(keys), 4), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.sums[at[hit]]
        return out

    def logs(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the sums of the log10 of the probabilities of their tokens in a bucket."""
        x = loosened(body)
        n1, n2, _, _, n3, total = self.stats[0]
        d = self._discounts[0]
        even = 1 / (self.words + 1)
        last = np.cumsum(x["words"], dtype=np.int64)
        if total:
            count = self.find(0, _gram([last], np.arange(len(last)), 1), last)
            p = (count - d[np.minimum(count, 3)]).clip(0) / total + (d[1] * n1 + d[2] * n2 + d[3] * n3) / total * even
        else:
            p = np.full(len(last), even)
        for size in range(1, self.order):
            d = self._discounts[size]
            runs = x[f"runs{size - 1}"].astype(np.int64)
            p, last = np.repeat(p, runs), np.repeat(last, runs)
            single = np.array([[0, 0, 0, 0], [1, 1, 0, 0]])
            sums = np.concatenate([single, np.stack([x[f"{n}{size}"].astype(np.int64) for n in ("total", "n1", "n2", "n3")], axis=1)])
            lower = (sums[:, 1:] * d[1:]).sum(axis=1) / np.maximum(sums[:, 0], 1)
            lower[sums[:, 0] == 0] = 1.0
            code, count = x[f"code{size}"], x[f"count{size}"].astype(np.int64)
            totals, lower = sums[:, 0][code], lower[code]
            marked = np.flatnonzero(x[f"split{size}"])
            if len(marked):
                context = [x[f"w{size}_{k}"] for k in range(1, size + 1)]
                words = [last[marked], *(w[x[f"context{size}"]] for w in context)]
                count[marked] = self.find(size, _gram(words, np.arange(len(marked)), size + 1), words[0])
                own = self._contexts(_gram(context, np.arange(len(context[0])), size))[x[f"context{size}"]]
                totals[marked] = own[:, 0]
                lower[marked] = np.where(own[:, 0] > 0, (own[:, 1:] * d[1:]).sum(axis=1) / np.maximum(own[:, 0], 1), 1.0)
            p = (count - d[np.minimum(count, 3)]).clip(0) / np.maximum(totals, 1) + lower * p
        logs = np.repeat(np.log10(p), x[f"runs{self.order - 1}"])
        rows = np.cumsum(x["rows"].astype(np.int64))
        return rows, np.bincount(x["row"], logs, len(rows))

    def add_up(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of rows over the buckets of a task, a row once for ``SUMS`` of them."""
        held: dict[int, np.ndarray] = {}

        def added() -> Iterator[pa.RecordBatch]:
            for part, sums in held.items():
                at = np.flatnonzero(~np.isnan(sums))
                yield pa.RecordBatch.from_arrays([pa.array((part << 40) + at), pa.array(sums[at])], ["row", "part"])
            held.clear()

        for batch in batches:
            for body in batch.column("body").to_pylist():
                rows, sums = self.logs(body)
                part = rows >> 40
                cuts = [*_starts(part), len(rows)]
                for a, b in zip(cuts, cuts[1:]):
                    at = rows[a:b] - (part[a] << 40)
                    own = held.get(int(part[a]), np.empty(0))
                    if at[-1] >= len(own):
                        own = np.append(own, np.full(max(int(at[-1]) + 1 - len(own), len(own)), np.nan))
                    own[at] = np.nan_to_num(own[at], nan=0.0) + sums[a:b]
                    held[int(part[a])] = own
                if sum(map(len, held.values())) > SUMS:
                    yield from added()
        yield from added()


def learn_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text", flag: str = "held_out", order: int = ORDER, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The scores of every row by the model of those rows whose ``flag`` is not true: ``key``, ``flag``,
    ``n_tokens``, ``n_known``, ``base_score`` (of single words, each count raised by one), ``score``,
    ``perplexity``, and ``train_tokens``, the number of tokens learned."""
    if order < 2:
        raise ValueError("a model has an order of 2 at least")
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("k"), F.col(flag).alias("f"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["k"].dataType.simpleString()
    learned = source.filter(~F.coalesce("f", F.lit(False))).select("text")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(partitions_for(docs), -(-size // bucket_bytes)))
    parts = -(-buckets // 4)

    uri = files.folder(spark, "grams")
    top, most = -(-FREQUENT // parts), size // (buckets * 8)
    counted = learned.mapInArrow(lambda b: _count_words(b, order, buckets, parts), COUNTED)
    made = pin(counted.groupBy("bucket").applyInArrow(lambda t: _add_words(t, uri, top, most), MADE), "words").collect()
    words = _numbered([r for r in made if r.bucket >= 0], parts)
    split = np.sort(np.array([k for r in made if r.bucket < 0 for k in r["keys"]], np.int64).view(np.uint64))

    info = "row long, k " + kind + ", f boolean, n_tokens long, n_known long, base_score double"
    sent = source.mapInArrow(lambda b: _send(b, order, buckets, words, split), f"bucket long, body binary, {info}")
    schema = f"bucket long, body binary, {info}, table long, part binary, stats array<bigint>"
    tables = int(max(1, min(partitions_for(docs), buckets), buckets // 8))
    pinned = pin(sent.groupBy("bucket").applyInArrow(lambda t: _of_bucket(t, order, tables), schema), "grams")

    behind = pinned.filter("table IS NOT NULL").select("table", "part")
    behind = pin(behind.groupBy("table").applyInArrow(lambda t: _of_table(t, order, uri), SUMMED), "counts")
    both = pinned.select("stats").unionByName(behind.select("stats"))
    sums = [x or 0 for x in both.agg(*[F.sum(F.col("stats")[i]) for i in range(6 * order)]).first()]
    uris = {r[0]: r[1] for r in behind.filter("uri IS NOT NULL").select("table", "uri").collect()}
    contexts = behind.filter("context IS NOT NULL").groupBy("context").agg(*[F.sum(F.col("sums")[i]) for i in range(4)]).collect()
    keys = np.array([r[0] for r in contexts], np.int64).view(np.uint64)
    own = np.array([r[1:] for r in contexts], np.int64).reshape(-1, 4)
    by = np.argsort(keys)
    model = Counts(order, words.words, [sums[6 * i : 6 * i + 6] for i in range(order)], tables, uris, keys[by], own[by])

    tasks = min(partitions_for(docs), SUM_TASKS)
    found = pinned.filter("body IS NOT NULL").select("body").coalesce(tasks).mapInArrow(model.add_up, "row long, part double")
    total = F.aggregate(F.array_sort(F.collect_list("part")), F.lit(0.0), lambda a, x: a + x)
    scores = found.groupBy("row").agg(total.alias("score"))
    rows = pinned.filter("row IS NOT NULL").select("row", "k", "f", *INFO).join(scores, "row")
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return rows.select(
        F.col("k").alias(key), F.col("f").alias(flag), *INFO, "score", perplexity.alias("perplexity"), F.lit(words.tokens).cast("long").alias("train_tokens")
    )


def _numbered(made: list, parts: int) -> Words:
    """Numbers of words: the frequent ones by their counts, then the others part by part."""
    keys = np.array([k for r in made for k in r["keys"]], np.int64).view(np.uint64)
    counts = np.array([c for r in made for c in r.counts], np.int64)
    by = np.lexsort((keys, -counts))
    ids = np.empty(len(keys), np.uint32)
    ids[by] = FIRST + np.arange(len(keys), dtype=np.uint32)
    uris, base = {}, FIRST + len(keys)
    for r in sorted(made, key=lambda r: r.bucket):
        uris[r.bucket] = (r.uri, base)
        base += r.words
    order = np.argsort(keys)
    return Words(parts, keys[order], ids[order], counts[order], uris, sum(r.words for r in made), sum(r.tokens for r in made))
