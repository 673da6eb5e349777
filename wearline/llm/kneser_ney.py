"""Interpolated modified Kneser-Ney language model, counted in Spark and read from mapped files.

Tokens are words between ASCII blanks, A-Z in lower case, and one end for each text; texts are
padded with begins, so that every token has a whole n-gram. Words are known by their XXH64, longer
grams by a hash of these.

1. Words are counted. The frequent ones get a number of buckets in proportion to their count, at
   most two per bucket of an average, so that the hash table of frequent words has a fixed bound.
2. Tasks count the n-grams of their texts, each distinct one once per chunk, and send them to the
   bucket of their context; a frequent word's contexts are spread over its buckets.
3. Level by level, a bucket adds up its grams, writes them as arrays in the order of their hashes,
   and hands two things on to the next lower level: what a gram's context needs (the sum of the counts
   behind it, and how many are 1, 2 and more) and in how many ways a gram's end is continued to the
   left. On lower levels these continuations are the counts.
4. For scoring, workers map the files they meet into memory, look up each distinct gram of a chunk
   once, in the order of the hashes, and put the levels together:
   P(w | context) = max(c - D, 0) / total + (D1 n1 + D2 n2 + D3 n3) / total * P(w | shorter context),
   down to an even share of all words seen and one unseen.

A level's discounts come from its numbers of counts of 1 to 4; where these do not give one (none
of a kind, or a discount that is not above 0), 0.5, 1 and 1.5 are used. All counts cover all texts;
the files grow with the texts in number. Their names lie in one more mapped file, so the driver holds the
sums of the levels and the frequent words only. On a store that cannot be mapped a file is read whole.

NULL texts count as empty: their end is a token. Rows are scored one by one, whatever their keys. A
model of no texts gives every token the probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from . import files
from .common import WordHashes, partitions_for, pieces, segments
from .windows import mixed

#: The customary order of such models.
ORDER = 5
# Of text for a bucket and of tokens at a time with n-grams of two words; of longer ones as many less.
BUCKET_BYTES = 16 << 20
CHUNK = 2 << 20
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\n", b"\n\n"))
#: What is kept of a gram: its count, what a context needs, and of a word its count in the texts.
VALUES = ["count", "total", "n1", "n2", "n3", "raw"]
FALLBACK = (0.0, 0.5, 1.0, 1.5)
OPEN = 256
NAME = 32

_MIX = np.uint64(0x9E3779B97F4A7C15)


def joined(words: np.ndarray) -> np.ndarray:
    """A hash of each row of word hashes; that of a single word is the word's."""
    out = words[:, 0]
    for column in words.T[1:]:
        out = mixed(out * _MIX + column)
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the smallest type that holds them; none if all are 0."""
    most = int(values.max(initial=0))
    if not most:
        return np.empty(0, np.uint8)
    return values.astype(np.min_scalar_type(most))


def _whole(values: np.ndarray, count: int) -> np.ndarray:
    """What ``narrow`` was given."""
    return values.astype(np.int64) if len(values) else np.zeros(count, np.int64)


@dataclass(frozen=True)
class Places:
    """Where grams go: ``buckets``, and the frequent words with how many of them each takes."""

    buckets: int
    words: np.ndarray
    spread: np.ndarray

    def of(self, grams: np.ndarray) -> np.ndarray:
        """The buckets of rows of words: by the context, and the last word if that is frequent."""
        last = grams[:, -1]
        if grams.shape[1] == 1:
            return (mixed(last) % np.uint64(self.buckets)).astype(np.int64)
        context = joined(grams[:, :-1])
        out = mixed(context) % np.uint64(self.buckets)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, grams[:, -2]), len(self.words) - 1)
            spread = np.where(self.words[at] == grams[:, -2], self.spread[at], 1).astype(np.uint64)
            out = out + mixed(last + _MIX) % spread
        return (out % np.uint64(self.buckets)).astype(np.int64)


def _tokens(column: pa.Array, hashes: WordHashes, pads: int) -> tuple[np.ndarray, np.ndarray]:
    """The padded tokens of texts one after the other, and how many each has without pads."""
    begin, out, sizes = np.full(pads, BEGIN), [], []
    for text in column.cast(pa.large_binary()).to_pylist():
        words = [hashes.of(part.split()) for part in segments(text.lower())]
        out += [begin, *words, np.array([END])]
        sizes.append(sum(map(len, words)) + 1)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.array(sizes, np.int64)


def _ends(sizes: np.ndarray, pads: int) -> np.ndarray:
    """The places of the tokens that are no pads."""
    base = np.cumsum(sizes + pads) - sizes
    return np.repeat(base - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _chunks(batches: Iterator[pa.RecordBatch], text: str, pads: int, least: int = CHUNK) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Rows, their padded tokens and sizes, about ``least`` tokens at a time."""
    hashes, held, tokens, sizes, count = WordHashes(), [], [], [], 0
    for piece in pieces(batches, text):
        own, size = _tokens(piece.column(text), hashes, pads)
        held.append(piece)
        tokens.append(own)
        sizes.append(size)
        count += len(own)
        if count >= least:
            yield held, np.concatenate(tokens), np.concatenate(sizes)
            held, tokens, sizes, count = [], [], [], 0
    if held:
        yield held, np.concatenate(tokens), np.concatenate(sizes)


def _grams(tokens: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Rows of the ``size`` tokens that end at the places ``ends``."""
    return np.stack([tokens[ends - back] for back in reversed(range(size))], axis=1)


def _added(grams: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes in ascending order, grams, sums of the rows of ``values``) of distinct grams."""
    hashes = joined(grams)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    cuts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, np.int64)
    sums = np.add.reduceat(values[order], cuts, axis=0) if len(cuts) else values[:0]
    return hashes[cuts], grams[order[cuts]], sums


RECORD = "bucket long, body binary"


def _records(grams: np.ndarray, values: dict[str, np.ndarray], places: Places) -> pa.RecordBatch:
    """A row for each bucket: grams in the order of their contexts, each context once."""
    bucket = places.of(grams)
    order = np.lexsort((*grams.T[:-1], bucket)) if grams.shape[1] > 1 else np.argsort(bucket, kind="stable")
    bucket, grams = bucket[order], grams[order]
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
    bodies = []
    for a, b in zip(edges, edges[1:]):
        own, arrays = grams[a:b], {}
        if own.shape[1] > 1:
            new = np.append(True, (own[1:, :-1] != own[:-1, :-1]).any(axis=1))
            starts = np.flatnonzero(new)
            arrays["contexts"] = own[starts, :-1].ravel()
            arrays["runs"] = narrow(np.diff(np.append(starts, b - a)))
        arrays["words"] = own[:, -1]
        bodies.append(files.pack(arrays | {n: narrow(v[order[a:b]]) for n, v in values.items()}))
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), pa.array(bodies, pa.binary())], ["bucket", "body"])


def _read(bodies: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ``size`` words and their values, as ``_records`` packed them."""
    grams, values = [], []
    for body in bodies:
        arrays = files.unpack(body)
        words = arrays["words"]
        own = np.empty((len(words), size), np.uint64)
        own[:, -1] = words
        if size > 1:
            own[:, :-1] = np.repeat(arrays["contexts"].reshape(-1, size - 1), _whole(arrays["runs"], 0), axis=0)
        grams.append(own)
        values.append(np.stack([_whole(arrays[n], len(words)) if n in arrays else np.zeros(len(words), np.int64) for n in VALUES], axis=1))
    return np.concatenate(grams), np.concatenate(values)


def _count_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    places = Places(buckets, np.empty(0, np.uint64), np.empty(0, np.int64))
    for _, tokens, _ in _chunks(batches, "text", 1):
        words, counts = np.unique(tokens, return_counts=True)
        yield _records(words[:, None], {"raw": counts}, places)


def _add_words(table: pa.Table) -> pa.Table:
    """The words of a bucket with their counts, their number and sum. The begin is left out of both."""
    words, values = _read(table["body"].to_pylist(), 1)
    _, words, values = _added(words, values)
    counts = values[:, VALUES.index("raw")]
    true = words[:, 0] != BEGIN
    body = files.pack({"words": words[:, 0], "raw": narrow(counts)})
    return pa.table(
        {
            "bucket": table["bucket"][:1],
            "body": pa.array([body], pa.binary()),
            "words": pa.array([int(true.sum())], pa.int64()),
            "tokens": pa.array([int(counts[true].sum())], pa.int64()),
        }
    )


def _count_grams(batches: Iterator[pa.RecordBatch], order: int, places: Places) -> Iterator[pa.RecordBatch]:
    for _, tokens, sizes in _chunks(batches, "text", order - 1, CHUNK * 2 // order):
        grams = _grams(tokens, _ends(sizes, order - 1), order)
        _, first, counts = np.unique(joined(grams), return_index=True, return_counts=True)
        yield _records(grams[first], {"count": counts}, places)


LEVEL = f"{RECORD}, level int, uri string, stats array<bigint>"


def _level(table: pa.Table, size: int, order: int, places: Places, uri: str) -> pa.Table:
    """Write a bucket's grams of ``size`` words; what the level below needs, and the file's row.

    ``stats`` are the numbers of counts of 1, 2, 3, 4, of 3 and more, and the counts' sum. Rows
    of files of the levels above pass by under negative buckets.
    """
    bucket = table["bucket"][0].as_py()
    if bucket < 0:
        return table
    grams, values = _read(table["body"].to_pylist(), size)
    hashes, grams, values = _added(grams, values)
    columns = dict(zip(VALUES, values.T))
    count = columns["count"]
    arrays = {"hash": hashes} | {n: narrow(v) for n, v in columns.items()}
    name = files.write(f"{uri}/{size}", files.pack(arrays), ".grams")
    stats = [int((count == k).sum()) for k in (1, 2, 3, 4)] + [int((count >= 3).sum()), int(count.sum())]
    rows = {
        "bucket": [-1 - bucket],
        "body": [None],
        "level": [size],
        "uri": [name],
        "stats": [stats],
    }
    file_row = pa.table(rows, pa.schema([("bucket", pa.int64()), ("body", pa.binary()), ("level", pa.int32()), ("uri", pa.string()), ("stats", pa.list_(pa.int64()))]))
    seen = count > 0
    if size == 1 or not seen.any():
        return file_row
    grams, count = grams[seen], count[seen]
    sent = np.zeros((2 * len(grams), len(VALUES)), np.int64)
    sent[: len(grams), VALUES.index("total")] = count
    for k, test in (("n1", count == 1), ("n2", count == 2), ("n3", count >= 3)):
        sent[: len(grams), VALUES.index(k)] = test
    sent[len(grams) :, VALUES.index("count")] = 1
    _, lower, sums = _added(np.concatenate([grams[:, :-1], grams[:, 1:]]), sent)
    below = pa.Table.from_batches([_records(lower, dict(zip(VALUES[:5], sums.T[:5])), places)])
    for field in file_row.schema.names[2:]:
        below = below.append_column(field, pa.nulls(len(below), file_row.schema.field(field).type))
    return pa.concat_tables([file_row, below.cast(file_row.schema)])


def _write_names(batches: Iterator[pa.RecordBatch], order: int, buckets: int, uri: str) -> Iterator[pa.RecordBatch]:
    """One file of all names, by level and bucket, from rows in that order."""

    def names() -> Iterator[bytes]:
        at = 0
        for batch in batches:
            for level, bucket, name in zip(*(batch.column(c).to_pylist() for c in ("level", "bucket", "uri"))):
                own = (level - 1) * buckets + (-1 - bucket)
                if own < at:
                    continue
                yield b" " * (NAME * (own - at))
                yield name.rsplit("/", 1)[1].removesuffix(".grams").encode()
                at = own + 1
        yield b" " * (NAME * (order * buckets - at))

    found = files.write_parts(uri, names(), ".names")
    yield pa.RecordBatch.from_pydict({"uri": [found]})


def discounts(stats: list[int]) -> np.ndarray:
    """The discounts of counts of 0, 1, 2, and 3 or more."""
    n1, n2, n3, n4 = stats[:4]
    out = list(FALLBACK)
    if n1 and n2:
        share = n1 / (n1 + 2 * n2)
        for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            d = k - (k + 1) * share * b / a if a else 0.0
            out[k] = d if 0 < d <= k else FALLBACK[k]
    return np.array(out)


@dataclass(frozen=True)
class Model:
    """A model in files below ``uri``; ``stats`` holds a list per level, from 1 on."""

    order: int
    places: Places
    uri: str
    names: str
    stats: list[list[int]]
    words: int
    tokens: int

    @cached_property
    def _names(self) -> memoryview:
        return memoryview(files.mapped(self.names) if self.names else b"")

    @cached_property
    def _opened(self):
        @lru_cache(OPEN)
        def opened(level: int, bucket: int) -> dict[str, np.ndarray] | None:
            at = ((level - 1) * self.places.buckets + bucket) * NAME
            name = bytes(self._names[at : at + NAME]).decode().strip()
            return files.unpack(files.mapped(f"{self.uri}/{level}/{name}.grams")) if name else None

        return opened

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def find(self, grams: np.ndarray, names: list[str]) -> np.ndarray:
        """The values ``names`` of rows of words, 0 for those that were not seen."""
        hashes, first, back = np.unique(joined(grams), return_index=True, return_inverse=True)
        out = np.zeros((len(hashes), len(names)), np.int64)
        bucket = self.places.of(grams[first])
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
        for a, b in zip(edges, [*edges[1:], len(order)]):
            own = order[a:b]
            table = self._opened(grams.shape[1], int(bucket[own[0]]))
            if table is None:
                continue
            at = np.searchsorted(table["hash"], hashes[own])
            hit = at < len(table["hash"])
            hit[hit] = table["hash"][at[hit]] == hashes[own[hit]]
            for k, name in enumerate(names):
                if len(table[name]):
                    out[own[hit], k] = table[name][at[hit]]
        return out[back.ravel()]

    @cached_property
    def _discounts(self) -> list[np.ndarray]:
        return [discounts(s) for s in self.stats]

    def logs(self, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 of the model's probability and of the plain one, and the count in the texts,
        of the tokens at the places ``ends``."""
        kept = ["count", "total", "n1", "n2", "n3", "raw"]
        found = self.find(tokens[:, None], kept) if len(tokens) else np.zeros((0, 6), np.int64)
        n1, n2, _, _, n3, total = self.stats[0]
        d = self._discounts[0]
        even = 1 / (self.words + 1)
        if total:
            count = found[ends, 0]
            p = (count - d[np.minimum(count, 3)]).clip(0) / total + (d[1] * n1 + d[2] * n2 + d[3] * n3) / total * even
        else:
            p = np.full(len(ends), even)
        raw = found[ends, 5]
        plain = np.log10((raw + 1) / (self.tokens + 1 * (self.words + 1)))
        context = found[ends - 1, 1:5] if self.order > 1 else None
        for size in range(2, self.order + 1):
            d = self._discounts[size - 1]
            count = self.find(_grams(tokens, ends, size), ["count"])[:, 0]
            total = np.maximum(context[:, 0], 1)
            lower = (context[:, 1:] * d[1:]).sum(axis=1) / total
            p = np.where(context[:, 0] > 0, (count - d[np.minimum(count, 3)]).clip(0) / total + lower * p, p)
            if size < self.order:
                context = self.find(_grams(tokens, ends - 1, size), kept[1:5])
        return np.log10(p), plain, raw

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text", flag: str = "held_out") -> DataFrame:
        """``key``, ``flag`` (a column of ``docs``), ``n_tokens``, ``n_known``, ``base_score``
        (of single words, each count raised by one), ``score`` and ``perplexity`` of every row."""
        source = docs.select(F.col(key).alias("k"), F.col(flag).alias("f"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        kind = source.schema["k"].dataType.simpleString()
        pads = self.order - 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, tokens, sizes in _chunks(batches, "text", pads, CHUNK // self.order):
                logs, plain, raw = self.logs(tokens, _ends(sizes, pads))
                starts = np.cumsum(sizes) - sizes
                model, base, known = (np.add.reduceat(x, starts) for x in (logs, plain, (raw > 0).astype(np.int64)))
                rows = pa.Table.from_batches(held).combine_chunks()
                columns = [sizes, known, base, model, 10.0 ** (-model / sizes)]
                for batch in rows.select(["k", "f"]).to_batches():
                    yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], ["k", "f", *OUT])

        scored = source.mapInArrow(run, f"k {kind}, f {source.schema['f'].dataType.simpleString()}, {OUT_TYPES}")
        return scored.withColumnsRenamed({"k": key, "f": flag})


OUT = ["n_tokens", "n_known", "base_score", "score", "perplexity"]
OUT_TYPES = "n_tokens long, n_known long, base_score double, score double, perplexity double"


def learn(docs: DataFrame, order: int = ORDER, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> Model:
    """The model of all texts of ``docs``; its files lie in the shared folder."""
    if order < 2:
        raise ValueError("a model has an order of 2 at least")
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(partitions_for(docs), -(-size * order // (2 * bucket_bytes))))
    words = source.mapInArrow(lambda b: _count_words(b, buckets), RECORD)
    words = pin(words.groupBy("bucket").applyInArrow(_add_words, f"{RECORD}, words long, tokens long"), "words")
    known, tokens = (x or 0 for x in words.agg(F.sum("words"), F.sum("tokens")).first())
    places = Places(buckets, *_frequent(words, tokens, buckets))

    uri = files.folder(spark, "grams")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("level", "int"), ("uri", "string"), ("stats", "array<bigint>"))]
    level = source.mapInArrow(lambda b: _count_grams(b, order, places), RECORD).select("bucket", "body", *none)
    for own in range(order, 1, -1):
        level = level.groupBy("bucket").applyInArrow(_of_level(own, order, places, uri), LEVEL)
    raw = words.select("bucket", "body", *none)
    level = level.unionByName(raw).groupBy("bucket").applyInArrow(_of_level(1, order, places, uri), LEVEL)
    made = pin(level.select("bucket", "level", "uri", "stats"), "grams")
    sums = [F.sum(F.col("stats")[i]) for i in range(6)]
    found = {r[0]: [x or 0 for x in r[1:]] for r in made.groupBy("level").agg(*sums).collect()}
    stats = [found.get(n, [0] * 6) for n in range(1, order + 1)]
    # A name of 32 bytes for each file, written by one task as it reads them.
    listed = made.repartition(1).sortWithinPartitions("level", F.desc("bucket"))
    names = listed.mapInArrow(lambda b: _write_names(b, order, buckets, uri), "uri string").first()
    return Model(order, places, uri, names[0] if names else "", stats, known, tokens)


def _of_level(size: int, order: int, places: Places, uri: str):
    return lambda table: _level(table, size, order, places, uri)


def _frequent(words: DataFrame, tokens: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than half of a bucket's share of all tokens, at most two a bucket, and
    the buckets that each takes."""
    least = max(1, tokens // (2 * buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                arrays = files.unpack(body)
                counts = _whole(arrays["raw"], len(arrays["words"]))
                many = counts > least
                if many.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(arrays["words"][many].view(np.int64)), pa.array(counts[many])], ["word", "n"]
                    )

    rows = words.select("body").mapInArrow(run, "word long, n long").collect()
    found = np.array([r.word for r in rows], np.int64).view(np.uint64)
    spread = np.array([min(buckets, -(-r.n // least)) for r in rows], np.int64)
    order = np.argsort(found)
    return found[order], spread[order]
