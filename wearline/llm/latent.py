"""Benchmark passages in documents: latent retrieval, then word-order and answer checks.

Texts are words in lower case, cut at blanks and punctuation. The vocabulary is that of
the benchmark (of a block of about ``ITEMS`` items, so that its tables have a fixed bound),
without terms that occur in more than ``COMMON`` of the documents and in more than ``FEW_ITEMS``
items; a term of few items stays, however many documents have copied it. Passages are windows of
``PASSAGE`` words that begin every ``STRIDE`` words; each is a TF-IDF vector. An item of more than
``PASSAGE`` words is cut into such windows too and has a vector for each.

1. One pass counts the documents of each term.
2. The leading directions of the passages are found by a randomised SVD: a random start is
   multiplied by the passages and their transpose, ``POWER`` times, each time as sums over tasks
   that meet in a tree; the driver holds terms x ``RANK`` numbers. Benchmark items take part
   with the same total weight as the corpus, so that a single copy among many passages still
   lies in the space.
3. One pass compares every passage with every item by cosine in that space. Where it reaches
   ``COSINE``, the longest common subsequence of the item and the words around the passage is
   taken; for an item of more than ``PASSAGE`` words these reach as many words further to both
   sides as the item has. An item is found if it covers ``LCS`` of the item's words and half of the answer (the
   words of the item's last sentence, the last ``ANSWER`` at most) is there, or if it covers
   ``LCS_ALONE``.

Nothing of a document's size or of all documents reaches the driver. NULL texts count as empty;
items without words are never found. An item is a key (which may be NULL) and a text: equal ones count
once, those that share the key only are found each on its own; items whose words are all common are compared by word
order with every passage, since they have no direction in the space.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from .common import pieces, texts

ITEMS = 2_000
PASSAGE, STRIDE = 64, 32
RANK, POWER = 64, 1
COMMON, FEW_ITEMS = 0.05, 2
COSINE = 0.6
CHUNK = 4096
LCS, LCS_ALONE = 0.6, 0.8
ANSWER = 8
MARKS = b".,;:!?\"'()[]{}|*#$%&"
_PLAIN = bytes.maketrans(MARKS, b" " * len(MARKS))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_PLAIN).split()


def terms_of(vocabulary: dict[bytes, int], words: Sequence[bytes]) -> np.ndarray:
    """Numbers of words, -1 for those outside the vocabulary."""
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: keys and words, the vocabulary, and each item's terms.

    ``parts`` are the (item, first word, end) that have a vector of their own.
    """

    keys: list
    words: list[list[bytes]]
    answers: list[list[bytes]]
    vocabulary: dict[bytes, int]
    parts: list[tuple[int, int, int]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        keys, words, answers = [], [], []
        for key, text in rows:
            found = words_of((text or "").encode())
            if found:
                keys.append(key)
                words.append(found)
                parts = [p for p in (text or "").encode().replace(b"\n", b" ").split(b".") if p.strip()]
                last = words_of(parts[-1]) if parts else []
                answers.append((last or found)[-ANSWER:])
        vocabulary = {w: i for i, w in enumerate(sorted({w for x in words for w in x}))}
        parts = []
        for i, x in enumerate(words):
            last = max(0, len(x) - PASSAGE)
            parts += [(i, at, at + PASSAGE) for at in [*range(0, last, STRIDE), last]]
        return cls(keys, words, answers, vocabulary, parts)

    def rows(self, weight: np.ndarray) -> np.ndarray:
        """TF-IDF rows of unit length (or zero), one a part of an item."""
        out = np.zeros((len(self.parts), len(weight)), np.float32)
        for i, (item, first, end) in enumerate(self.parts):
            np.add.at(out[i], [self.vocabulary[w] for w in self.words[item][first:end]], 1)
        return _unit(out * weight)


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def tree_sum(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of vectors (float64, column ``v`` binary), one a task at the end of each level."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for v in batch.column("v"):
                total += np.frombuffer(v.as_buffer(), np.float64)
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while tasks > 1:
        tasks = -(-tasks // 8)
        parts = parts.repartition(tasks).mapInArrow(add, "v binary")
    return sum((np.frombuffer(r.v, np.float64) for r in parts.collect()), np.zeros(width))


def _documents_of_terms(docs: DataFrame, items: Items, text: str) -> tuple[np.ndarray, int]:
    width = len(items.vocabulary) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for piece in pieces(batches, text):
            column = piece.column(text).cast(pa.large_binary()).to_pylist()
            total[-1] += len(column)
            for t in column:
                found = terms_of(items.vocabulary, set(words_of(t)))
                total[found[found >= 0]] += 1
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    found = tree_sum(docs.select(text).mapInArrow(run, "v binary"), width)
    return found[:-1], int(found[-1])


def _occurrences(docs: DataFrame, items: Items, weight: np.ndarray, text: str) -> DataFrame:
    """Terms with a weight and their passages (apart, not overlapping), packed by pieces."""
    used = weight > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found, passage, base = [], [], 0
            for t in piece.column(text).cast(pa.large_binary()).to_pylist():
                own = terms_of(items.vocabulary, words_of(t))
                at = np.flatnonzero(own >= 0)
                at = at[used[own[at]]]
                found.append(own[at])
                passage.append(at // PASSAGE + base)
                base += len(own) // PASSAGE + 1
            columns = {"terms": np.concatenate(found), "passages": np.concatenate(passage).astype(np.int32)}
            if len(columns["terms"]):
                yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    return pin(docs.select(text).mapInArrow(run, "terms binary, passages binary"), "occurrences")


def _passage_rows(term: np.ndarray, passage: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage numbers from 0, terms, values) of rows of unit length."""
    _, passage = np.unique(passage, return_inverse=True)
    pair, count = np.unique(passage.astype(np.int64) << 32 | term, return_counts=True)
    passage, term = pair >> 32, pair & 0xFFFFFFFF
    value = count * weight[term]
    size = np.sqrt(np.bincount(passage, value**2))
    return passage, term, (value / size[passage]).astype(np.float32)


def _add_products(total: np.ndarray, base: np.ndarray, passage: np.ndarray, term: np.ndarray, value: np.ndarray) -> int:
    """Add the rows' transpose times the rows times ``base``; chunks of whole rows fit a cache."""
    edges = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    bounds = np.append(edges, len(passage))
    row = 0
    while row < len(edges):
        stop = max(row + 1, int(np.searchsorted(edges, edges[row] + CHUNK)))
        part = slice(bounds[row], bounds[stop])
        t, v, inner = term[part], value[part], edges[row:stop] - bounds[row]
        image = np.add.reduceat(base[t] * v[:, None], inner, axis=0)
        of = np.repeat(np.arange(stop - row), np.diff(bounds[row : stop + 1]))
        order = np.argsort(t, kind="stable")
        back = image[of[order]] * v[order, None]
        cuts = np.flatnonzero(np.append(True, np.diff(t[order]) != 0))
        total[t[order][cuts]] += np.add.reduceat(back, cuts, axis=0)
        row = stop
    return len(edges)


def _multiplied(occurrences: DataFrame, base: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The passages' transpose times the passages times ``base``, and the passages' number."""
    terms, rank = base.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((terms, rank)), 0
        for batch in batches:
            for t, p in zip(batch.column("terms"), batch.column("passages")):
                passage, term, value = _passage_rows(
                    np.frombuffer(t.as_buffer(), np.int32), np.frombuffer(p.as_buffer(), np.int32), weight
                )
                rows += _add_products(total, base, passage, term, value)
        out = np.append(total.ravel(), rows)
        yield pa.RecordBatch.from_pydict({"v": pa.array([out.tobytes()], pa.binary())})

    found = tree_sum(occurrences.mapInArrow(run, "v binary"), terms * rank + 1)
    return found[:-1].reshape(terms, rank), float(found[-1])


def directions(occurrences: DataFrame, items: Items, weight: np.ndarray, rank: int = RANK, power: int = POWER) -> np.ndarray:
    """Terms x rank: the leading right singular vectors of passages and items."""
    own = items.rows(weight)
    terms = len(weight)
    rank = min(rank, terms)
    base = np.random.default_rng(3).standard_normal((terms, rank)).astype(np.float32)
    for _ in range(power):
        product, rows = _multiplied(occurrences, base, weight)
        share = max(rows, 1.0) / max(len(own), 1)
        product += share * (own.T @ (own @ base))
        base, _ = np.linalg.qr(product)
        base = base.astype(np.float32)
    # Turn the basis to the singular vectors; the last product gives the small matrix.
    product, rows = _multiplied(occurrences, base, weight)
    product += max(rows, 1.0) / max(len(own), 1) * (own.T @ (own @ base))
    _, turn = np.linalg.eigh(base.T @ product)
    return np.ascontiguousarray((base @ turn[:, ::-1]).astype(np.float32))


def common_subsequence(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence of an item (its words' places as bit masks)
    and ``words``, all places of the item at once."""
    full = (1 << size) - 1
    row = full
    get = masks.get
    for w in words:
        hit = row & get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return size - row.bit_count()


@dataclass(frozen=True)
class Search:
    items: Items
    weight: np.ndarray
    space: np.ndarray

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(text, item, cosine, share of the item, share of the answer, first word)."""
        words = [words_of(t) for t in texts]
        best: dict[tuple[int, int], tuple] = {}
        for text, passage, item, cosine in self._candidates(words):
            masks, answer = self.masks[item]
            size = len(self.items.words[item])
            slack = STRIDE // 2 + (size if size > PASSAGE else 0)
            start = max(0, passage * STRIDE - slack)
            around = words[text][start : passage * STRIDE + PASSAGE + slack]
            share = common_subsequence(masks, size, around) / size
            if share < LCS:
                continue
            there = set(around)
            answered = sum(w in there for w in answer) / len(answer)
            if share >= LCS_ALONE or answered >= 0.5:
                found = (share, answered, cosine, -start)
                if (text, item) not in best or found > best[text, item]:
                    best[text, item] = found
        for (text, item), (share, answered, cosine, start) in sorted(best.items()):
            yield text, item, cosine, share, answered, -start

    @property
    def masks(self) -> list:
        if not hasattr(self, "_masks"):
            made = []
            for words, answer in zip(self.items.words, self.items.answers):
                masks: dict[bytes, int] = {}
                for i, w in enumerate(words):
                    masks[w] = masks.get(w, 0) | 1 << i
                made.append((masks, answer))
            object.__setattr__(self, "_masks", made)
        return self._masks

    @property
    def latent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if not hasattr(self, "_latent"):
            rows = self.items.rows(self.weight)
            of = np.array([p[0] for p in self.items.parts], np.int64)
            plain = np.setdiff1d(of, of[np.linalg.norm(rows, axis=1) > 0])
            object.__setattr__(
                self, "_latent", (_unit(rows @ self.space), of, plain, self.space * self.weight[:, None].astype(np.float32))
            )
        return self._latent

    def _candidates(self, words: list[list[bytes]]) -> Iterator[tuple[int, int, int, float]]:
        """(text, passage, item, cosine) of all texts' passages that come near an item."""
        latent, of, plain, space = self.latent
        per_stride = PASSAGE // STRIDE
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        passages = np.maximum(1, -(-(sizes - (PASSAGE - STRIDE)) // STRIDE))
        for text, count in enumerate(passages.tolist()) if len(plain) else ():
            for passage in range(count):
                for item in plain.tolist():
                    yield text, passage, item, 0.0
        # Strides of all texts in one row of numbers, with room for the last passages' ends.
        base = np.cumsum(passages + per_stride) - (passages + per_stride)
        terms = terms_of(self.items.vocabulary, [w for x in words for w in x])
        at = np.flatnonzero(terms >= 0)
        at = at[self.weight[terms[at]] > 0]
        if not len(at):
            return
        starts = np.cumsum(sizes) - sizes
        text = np.searchsorted(starts, at, side="right") - 1
        stride = (at - starts[text]) // STRIDE + base[text]
        edges = np.flatnonzero(np.append(True, stride[1:] != stride[:-1]))
        sums = np.add.reduceat(space[terms[at]], edges, axis=0)
        filled = stride[edges]
        # Passages that hold a filled stride: the stride's own and those that began before it.
        slot = np.unique((filled[:, None] - np.arange(per_stride)).ravel())
        of_text = np.searchsorted(base, slot, side="right") - 1
        inside = (slot >= 0) & (slot - base[of_text] < passages[of_text])
        slot, of_text = slot[inside], of_text[inside]
        place = np.full(int(base[-1] + passages[-1]) + 2 * per_stride, len(filled))
        place[filled] = np.arange(len(filled))
        sums = np.concatenate([sums, np.zeros((1, sums.shape[1]), sums.dtype)])
        for part in range(0, len(slot), 4096):
            own, texts_of = slot[part : part + 4096], of_text[part : part + 4096]
            rows = sums[place[own]]
            for k in range(1, per_stride):
                rows = rows + sums[place[own + k]]
            cosines = _unit(rows) @ latent.T
            hit, row = np.nonzero(cosines >= COSINE)
            cosine, item = cosines[hit, row], of[row]
            # Of the parts of an item that a passage comes near, the nearest.
            order = np.lexsort((-cosine, item, hit))
            hit, item, cosine = hit[order], item[order], cosine[order]
            new = np.append(True, (hit[1:] != hit[:-1]) | (item[1:] != item[:-1]))[: len(hit)]
            hit, item, cosine = hit[new], item[new], cosine[new]
            yield from zip(texts_of[hit].tolist(), (own - base[texts_of])[hit].tolist(), item.tolist(), cosine.tolist())


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key``, ``item``, ``cosine``, ``lcs``, ``answer``, ``first_word``: one row for each
    document and each benchmark item found in it."""
    source = texts(docs, key, text)
    kind, item_kind = source.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"{key} {kind}, {item} {item_kind}, cosine double, lcs double, answer double, first_word long"
    found = None
    for search in _searches(source, benchmark, text, item, item_text):
        one = source.mapInArrow(_found_by(search, key, text, item), schema)
        found = one if found is None else found.unionByName(one)
    return found


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found, each row by its own text."""
    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias(text))
    kept = docs
    for search in _searches(source, benchmark, text, item, item_text):
        kept = kept.mapInArrow(_rows_without(search, text), docs.schema)
    return kept


def _rows_without(search: Search, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = pc.fill_null(batch.column(text), "")
            whole = pa.RecordBatch.from_arrays([*batch.columns, filled], [*map(str, range(batch.num_columns)), "filled"])
            for piece in pieces([whole], "filled"):
                column = piece.column("filled").cast(pa.large_binary()).to_pylist()
                clean = np.ones(len(column), bool)
                clean[[m[0] for m in search.matches(column)]] = False
                rows = piece.filter(pa.array(clean))
                yield pa.RecordBatch.from_arrays(rows.columns[:-1], schema=batch.schema)

    return run


def _searches(source: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> Iterator[Search]:
    """A search for each block of the benchmark, of about ``ITEMS`` vectors."""
    wanted = benchmark.filter(F.col(item_text).isNotNull())
    # An item of some 500 bytes has one vector, a longer one about one a stride.
    further = F.ceil((F.octet_length(item_text) - 8 * PASSAGE) / (6 * STRIDE))
    vectors = wanted.agg(F.sum(1 + F.greatest(further, F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-int(vectors) // ITEMS))
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64(item, item_text), F.lit(blocks)) == block)
        rows = [tuple(r) for r in part.select(item, item_text).distinct().collect()]
        rows.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
        yield _search(source, Items.of(rows), text)


def _search(docs: DataFrame, items: Items, text: str) -> Search:
    counts, total = _documents_of_terms(docs, items, text)
    in_items = np.zeros(len(counts))
    for words in items.words:
        in_items[[items.vocabulary[w] for w in set(words)]] += 1
    common = (counts > COMMON * total) & (in_items > FEW_ITEMS)
    # Positive even for a term of all documents.
    weight = np.where(common, 0.0, np.log((2 + total) / (1 + counts)))
    if weight.any():
        space = directions(_occurrences(docs, items, weight, text), items, weight)
    else:
        space = np.zeros((len(weight), 1), np.float32)
    return Search(items, weight, space)


def _found_by(search: Search, key: str, text: str, item: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            keys = piece.column(key).to_pylist()
            column = piece.column(text).cast(pa.large_binary()).to_pylist()
            out = [(keys[t], search.items.keys[i], c, s, a, f) for t, i, c, s, a, f in search.matches(column)]
            if out:
                columns = list(zip(*out))
                kinds = [piece.schema.field(key).type, None, *[pa.float64()] * 3, pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    [key, item, "cosine", "lcs", "answer", "first_word"],
                )

    return run
