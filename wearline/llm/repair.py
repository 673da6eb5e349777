"""Token ids in files that are compressed with a grammar of id pairs (Re-Pair).

Texts are encoded in ascending key order and cut into shards of about ``SHARD_TOKENS`` ids. In a
shard, the most frequent pairs of neighbouring symbols are replaced by new symbols, round after round,
until no pair is left whose rule takes less room than it saves (``PAYS`` occurrences). A round takes the
pairs from the highest count down to a part of it, so that frequent pairs come first; where two of them
overlap the more frequent one is taken. Counts are exact. A pair never begins with a symbol that ends a document, so a document is a whole range of symbols. Rules are stored with the lengths of their
expansions, which allows to fetch one document, or one place of it, without expanding what lies before.

File: the fields of ``HEAD``, then keys (int64), a byte for each key that is NULL, symbol starts and id
starts of the documents (uint32, one more than documents), rules (uint32 pairs), expansion lengths
(uint32), the low 16 bits of all symbols, then the others, as many bits each as the head says.

Ids are those of the tokenizers library. Texts are cut before each blank that begins a word. A distinct word
is encoded once per worker (the library's model does, on the bytes of each piece of its own splitter in the
vocabulary's alphabet), and the ids are joined back by position. Texts with characters for which
the splitter here is not known to be equal, or with special tokens, go to the library whole.

NULL texts count as empty; an empty text is its end id alone. Rows without a key come first. Rows that
share a key follow one another in the order of a hash of their texts, equal texts one after the other.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wearline.session import pin

from . import files
from .common import pieces, texts

SHARD_TOKENS = 1 << 20
#: A rule takes 12 bytes and a replaced pair frees a symbol of 2.25 bytes or more.
PAYS = 6
#: A round takes pairs down to this part of the highest count, and to a third of what the round before did: few
#: places of frequent pairs may be left, those that others overlap, and rounds for them alone would take long.
PART = 8
SLOT_BITS = 17
MAGIC = b"WLRP0002"
HEAD = struct.Struct("<8s6Q")
WIDTHS = [2, 4, 8, 16]

# Characters for which the splitters agree, one by one (tested): Latin to Cyrillic, punctuation,
# kana, Han, Hangul.
_OTHER = regex.compile("[^\x00-\u0557\u2010-\u2027\u3000-\u303f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")
# Blanks that begin a word.
_CUT = regex.compile(r" (?=\S)")


def _alphabet() -> str:
    """The characters that stand for bytes in a byte-level vocabulary: a visible one for itself,
    the others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    letters = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(letters[b] for b in range(256))


class _NoWord(Exception):
    """A blank stands before white space or the end."""


class _Words(dict):
    """Ids of a blank and a word as bytes, made by the library's model while they stay in the table."""

    LIMIT = 1_000_000

    def __init__(self, library: Tokenizer, pattern: str):
        super().__init__()
        self.tokenize, self.letters = library.model.tokenize, _alphabet()
        self.blank = self.letters[ord(" ")]
        # Words are kept here; a second table in the model only costs time.
        library.model._resize_cache(0)
        self.split = regex.compile(pattern).findall
        self.others: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _NoWord
        # Letters are one piece, and one other character behind them is another.
        if word.isalpha():
            value = self._ids(self.blank + word) if word.isascii() else self._made(" " + word)
        elif word[:-1].isalpha():
            value = self[word[:-1]] + self._piece(word[-1])
        else:
            found = self.split(" " + word)
            value = self._made(found[0]) if len(found) == 1 else b"".join(map(self._piece, found))
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value

    def start(self, word: str) -> bytes:
        """Ids of a word that no blank precedes."""
        return b"".join(map(self._piece, self.split(word)))

    def _piece(self, piece: str) -> bytes:
        if piece[0] == " " and not piece.isspace():
            return self[piece[1:]]
        value = self.others.get(piece)
        if value is None:
            if len(self.others) >= self.LIMIT // 4:
                self.others.clear()
            value = self.others[piece] = self._made(piece)
        return value

    def _made(self, piece: str) -> bytes:
        return self._ids(charmap_decode(piece.encode(), "strict", self.letters)[0])

    def _ids(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()


class Encoder:
    """Ids of the tokenizers library for a byte-level vocabulary that is split by ``pattern``.

    The pattern must begin a piece at each blank that stands before another character than white space,
    whatever lies around, keep letters together with the blank before them, and not join a character that is
    no letter to these: texts are cut there first.
    """

    def __init__(self, library_file: str, pattern: str):
        self.library = Tokenizer.from_file(library_file)
        self.words = _Words(Tokenizer.from_file(library_file), pattern)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __call__(self, text: str) -> np.ndarray:
        if not text.isascii() and _OTHER.search(text) or (self.special is not None and self.special.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            ids = self._joined(text.split(" "))
        except _NoWord:
            ids = self._joined(_CUT.split(text))
        return np.frombuffer(ids, np.uint32)

    def _joined(self, parts: list[str]) -> bytes:
        return self.words.start(parts[0]) + b"".join(map(self.words.__getitem__, parts[1:]))


@lru_cache(1)
def encoder(library_file: str, pattern: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(library_file, pattern)


def compress(ids: np.ndarray, end_id: int, base: int, pays: int = PAYS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols, and rules (rows of two symbols); rule r stands for symbol ``base + r``."""
    s = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made, last, turns = 0, len(ids), np.random.default_rng(7)
    # Symbols that end a document are the first of no pair.
    closing = np.zeros(base, bool)
    closing[end_id] = True
    # Places whose pair may still become a rule: a rare pair stays rare until it is changed, and
    # then it is another one.
    alive = np.append(~closing[s[:-1]], False) if len(s) else np.zeros(0, bool)
    while True:
        left = int(np.count_nonzero(alive))
        if not left:
            break
        # While most places take part all of them are gone through, which needs no lists of places.
        dense = 2 * left > len(s)
        if dense:
            first, second = s[:-1], s[1:]
        else:
            live = np.flatnonzero(alive)
            first, second = s[live], s[live + 1]
        pair = np.empty(len(first), np.uint64)
        halves = pair.view("<u4").reshape(-1, 2)
        halves[:, 0], halves[:, 1] = second, first
        # A table by a hash. Slot 0 is for places that take no part; a pair that falls there waits for the next round.
        bits = min(SLOT_BITS, left.bit_length() + 1)
        size = 1 << bits
        slots = pair * (turns.integers(1, 1 << 63, dtype=np.uint64) | np.uint64(1))
        slots >>= np.uint64(64 - bits)
        slots = slots.view(np.int64)
        if dense:
            slots *= alive[:-1]
        counts = np.bincount(slots, minlength=size)
        counts[0] = pays
        rare = (counts < pays).take(slots, mode="clip")
        if dense:
            alive[:-1] &= ~rare
        else:
            alive[live[rare]] = False
        counts[0] = 0
        last = max(pays, min(int(counts.max()) // PART, last // 3))
        # Only slots with so many places are looked at: each has the count of one pair, that of its last place.
        # Others of the slot are left to a next round.
        found = np.flatnonzero((counts >= last).take(slots, mode="clip"))
        pair, slots = pair[found], slots[found]
        at = found if dense else live[found]
        held = np.zeros(size, np.uint64)
        held[slots] = pair
        slots *= held.take(slots, mode="clip") == pair
        counts = np.bincount(slots, minlength=size)
        counts[0] = 0
        # Pairs weigh what their place by count is. Among equal counts a part of the hash decides, so that many
        # places of a repeated passage are replaced at once.
        weight = np.zeros(size, np.int32)
        chosen = np.flatnonzero(counts >= last)
        weight[chosen[np.argsort(counts[chosen], kind="stable")]] = np.arange(1, len(chosen) + 1)
        own = weight.take(slots, mode="clip")
        # Of two pairs that overlap the one that weighs more; of a run of one pair every other one.
        apart = at[1:] != at[:-1] + 1
        take = own > 0
        take[1:] &= apart | (own[1:] >= own[:-1])
        take[:-1] &= apart | (own[:-1] >= own[1:])
        found = np.flatnonzero(take)
        at = at[found]
        place = np.arange(len(at))
        new = np.append(True, at[1:] != at[:-1] + 1)[: len(at)]
        take = (place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0
        at, slots = at[take], slots[found[take]]
        taken, number = np.zeros(size, bool), np.zeros(size, np.uint32)
        taken[slots] = True
        used = np.flatnonzero(taken)
        number[used] = np.arange(base + made, base + made + len(used), dtype=np.uint32)
        used = held[used]
        rules.append(np.column_stack([used >> np.uint64(32), used & np.uint64(0xFFFFFFFF)]))
        s[at] = number[slots]
        made += len(used)
        closing = np.append(closing, closing[rules[-1][:, 1].astype(np.int64)])
        alive[at] = (at + 2 < len(s)) & ~closing[s[at]]
        before = at[at > 0] - 1
        alive[before] = ~closing[s[before]]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        # What stood before a replaced pair may have gone with the pair before that.
        # Of many gaps a list is quicker, of few the mask.
        if 50 * len(at) > len(s):
            keep = np.flatnonzero(keep)
        s, alive = s[keep], alive[keep]
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.int64)
    return s, table.astype(np.uint32)


def lengths_of(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion lengths of the rules; a rule only names earlier ones."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint32)


def pack(symbols: np.ndarray, width: int) -> bytes:
    """The low 16 bits of all symbols, then ``width`` further bits of each."""
    each = 16 // width
    high = np.zeros((-(-len(symbols) // each), each), np.uint16)
    high.ravel()[: len(symbols)] = symbols >> 16
    joined = np.zeros(len(high), np.uint16)
    for i, column in enumerate(high.T):
        joined |= column << np.uint16(i * width)
    return (symbols & 0xFFFF).astype("<u2").tobytes() + joined.astype("<u2").tobytes()


def build(keys: list, sizes: np.ndarray, ids: np.ndarray, end_id: int, base: int) -> bytes:
    """A shard's file; ``keys`` may hold None, ``sizes`` are the documents' id counts with the end id."""
    symbols, rules = compress(ids, end_id, base)
    lengths = lengths_of(rules, base)
    id_starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint32)
    width = np.concatenate([np.ones(base, np.int64), lengths]).take(symbols)
    symbol_starts = np.searchsorted(np.concatenate([[0], np.cumsum(width)]), id_starts).astype(np.uint32)
    bits = next(w for w in WIDTHS if base + len(rules) <= 1 << (16 + w))
    return b"".join(
        [
            HEAD.pack(MAGIC, len(keys), len(rules), len(symbols), len(ids), base, bits),
            np.array([0 if k is None else k for k in keys], "<i8").tobytes(),
            np.array([k is None for k in keys], np.uint8).tobytes(),
            symbol_starts.astype("<u4").tobytes(),
            id_starts.astype("<u4").tobytes(),
            rules.astype("<u4").tobytes(),
            lengths.astype("<u4").tobytes(),
            pack(symbols, bits),
        ]
    )


@dataclass
class Shard:
    """A shard's file that is open for reading at any place."""

    source: object

    def __post_init__(self):
        magic, self.documents, self.n_rules, self.n_symbols, self.n_ids, self.base, self.bits = HEAD.unpack(self._read(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        n, at = self.documents, HEAD.size
        none = np.frombuffer(self._read(at + 8 * n, n), np.uint8).astype(bool)
        self.keys = pa.array(np.frombuffer(self._read(at, 8 * n), "<i8"), mask=none)
        at += n
        self.symbol_starts = np.frombuffer(self._read(at + 8 * n, 4 * n + 4), "<u4")
        self.id_starts = np.frombuffer(self._read(at + 12 * n + 4, 4 * n + 4), "<u4")
        at += 16 * n + 8
        self.rules = np.frombuffer(self._read(at, 8 * self.n_rules), "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(self._read(at + 8 * self.n_rules, 4 * self.n_rules), "<u4")
        self.symbols_at = at + 12 * self.n_rules

    def _read(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("the file ends early")
        return data

    @cached_property
    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all symbols one after the other, plain ids first, and where each begins and how many it has."""
        base = self.base
        parts: list[tuple] = []
        for a, b in self.rules.tolist():
            parts.append((parts[a - base] if a >= base else (a,)) + (parts[b - base] if b >= base else (b,)))
        flat = np.fromiter(chain(range(base), chain.from_iterable(parts)), np.uint32)
        width = np.concatenate([np.ones(base, np.int64), self.lengths])
        return flat, np.cumsum(width) - width, width

    def symbols(self, first: int, stop: int) -> np.ndarray:
        low = np.frombuffer(self._read(self.symbols_at + 2 * first, 2 * (stop - first)), "<u2").astype(np.uint32)
        each = 16 // self.bits
        a, z = first // each, -(-stop // each)
        high = np.frombuffer(self._read(self.symbols_at + 2 * (self.n_symbols + a), 2 * (z - a)), "<u2").astype(np.uint32)
        shifts = np.arange(each, dtype=np.uint32) * np.uint32(self.bits)
        high = (high[:, None] >> shifts & np.uint32((1 << self.bits) - 1)).ravel()[first - each * a : stop - each * a]
        return low | high << np.uint32(16)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, starts, widths = self.expansions
        width = widths.take(symbols)
        ends = np.cumsum(width)
        # From where an id stands to where it is listed.
        at = np.repeat(starts.take(symbols) - ends + width, width)
        at += np.arange(len(at))
        return flat.take(at)

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``, from its own symbols only."""
        return self.expand(self.symbols(int(self.symbol_starts[i]), int(self.symbol_starts[i + 1])))

    def all(self) -> np.ndarray:
        return self.expand(self.symbols(0, self.n_symbols))


def write_shards(docs: DataFrame, uri: str, library_file: str, pattern: str, end_id: int, key: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards below ``uri``; returns their manifest in key order.

    (``uri``, ``documents``, ``tokens``, ``start``), ``start`` counting all ids of the shards
    before. Keys are whole numbers.
    """
    rows = texts(docs, key, text).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    rows = rows.repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(library_file, pattern)
        base = max(encode.library.get_vocab_size() - 1, end_id) + 1
        part, held, keys, count, number = TaskContext.get().partitionId(), [], [], 0, 0

        def stored() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held])
            data = build(keys, sizes, np.concatenate(held), end_id, base)
            row = {"part": part, "number": number, "uri": files.write(uri, data, ".ids"), "documents": len(held), "tokens": count}
            return pa.RecordBatch.from_pylist([row])

        for piece in pieces(batches, "t"):
            for k, t in zip(piece.column("k").to_pylist(), piece.column("t").to_pylist()):
                ids = np.append(encode(t), np.uint32(end_id))
                keys.append(k)
                held.append(ids)
                count += len(ids)
                if count >= shard_tokens:
                    yield stored()
                    held, keys, count, number = [], [], 0, number + 1
        if held:
            yield stored()

    made = pin(rows.mapInArrow(run, "part long, number long, uri string, documents long, tokens long"), "shards")
    # Starts in two steps: of the tasks' parts, a row each, and within each part.
    parts = made.groupBy("part").agg(F.sum("tokens").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return made.join(parts, "part").select("uri", "documents", "tokens", (F.col("first") + within).alias("start"))


def read_shards(manifest: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``key``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, from the files.

    ``with_ids`` adds ``ids``. A file is read by one task.
    """
    more = ", ids array<int>" if with_ids else ""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                with files.open_at(uri) as source:
                    shard = Shard(source)
                    ids = shard.all().astype("<u4")
                cuts = shard.id_starts.astype(np.int64)
                raw = memoryview(ids.tobytes())
                columns = {
                    key: shard.keys,
                    "start": pa.array(cuts[:-1] + start),
                    "n_tokens": pa.array(np.diff(cuts)),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"{key} long, start long, n_tokens long, ids_crc32 long{more}"
    return manifest.select("uri", "start").repartition(tasks).mapInArrow(run, schema)
