"""Removal of word runs that occur in an earlier document, with an FM-index per shard.

Contexts that may share a phrase meet by their anchors (see ``windows``); the distinct ones of a
shard are indexed as one text of word numbers. Every context is then streamed against the index:
backward search from the end of each window follows its suffix interval word by word, which is
its matching statistic; a window whose interval shrinks to itself is left at once, and those
that reach 13 words get the least key of their interval.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordHashes
from .fmindex import FmIndex
from .windows import Anchors, Finder, remove_repeats

WINDOW, GRAM = 13, 5
REACH = WINDOW - GRAM + 1
WIDTH = WINDOW + REACH - 1
QUERIES = 1 << 18


class Words:
    """Words of joined texts: numbers in a table of distinct words, and their hashes."""

    def __init__(self, words: list[bytes], hashes: np.ndarray):
        self.words, self.hashes = words, hashes


_HASHES = WordHashes()


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    split = [t.split() for t in column.cast(pa.large_binary()).to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
    words = [w for x in split for w in x]
    hashes = _HASHES.of(words)
    return hashes, starts, Words(words, hashes)


def rows(own: Words, a: Anchors) -> np.ndarray:
    """Word hashes of contexts, 0 outside them, and each context's words as one object."""
    place = (a.at - (REACH - 1))[:, None] + np.arange(WIDTH)
    inside = (place >= a.first[:, None]) & (place < (a.last + WINDOW)[:, None])
    out = np.zeros(len(place), [("hash", np.uint64, WIDTH), ("pad", np.int64), ("words", object)])
    if len(place):
        out["hash"] = np.where(inside, own.hashes[np.clip(place, 0, len(own.hashes) - 1)], 0)
        out["pad"] = np.maximum(0, a.first - (a.at - (REACH - 1)))
        out["words"] = [b" ".join(own.words[x:y]) for x, y in zip(a.first.tolist(), (a.last + WINDOW).tolist())]
    return out


def folded(rows: np.ndarray) -> np.ndarray:
    return rows["hash"]


def pack(rows: np.ndarray) -> bytes:
    """The number of rows, a byte each for the words missing before them, and lines of words."""
    paddings = rows["pad"].astype(np.uint8).tobytes()
    return len(rows).to_bytes(4, "little") + paddings + b"\n".join(rows["words"].tolist())


def unpack(body: bytes) -> np.ndarray:
    count = int.from_bytes(body[:4], "little")
    out = np.zeros(count, [("pad", np.int64), ("words", object)])
    out["pad"] = np.frombuffer(body, np.uint8, count, 4)
    out["words"] = body[4 + count :].split(b"\n")
    return out


def first(rows: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, least key that has this window) of all windows of all rows."""
    numbers: dict[bytes, int] = {}
    slot = WIDTH + 1
    text = np.ones((len(rows), slot), np.int64)
    for i, (pad, line) in enumerate(zip(rows["pad"].tolist(), rows["words"].tolist())):
        found = [numbers.setdefault(w, len(numbers) + 2) for w in line.split(b" ")]
        text[i, pad : pad + len(found)] = found
    text = text.ravel()
    index = FmIndex(text, WINDOW)
    key_of = np.append(keys, np.iinfo(np.int64).max)[index.order // slot]

    size = high - low + 1
    row = np.repeat(np.arange(len(rows)), size)
    offset = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = row * slot + REACH - 1 - offset
    least = keys[row].copy()
    for part in range(0, len(at), QUERIES):
        own = np.arange(part, min(part + QUERIES, len(at)))
        lo, hi = index.all(len(own))
        for back in reversed(range(WINDOW)):
            lo, hi = index.step(text[at[own] + back], lo, hi)
            more = hi - lo > 1
            own, lo, hi = own[more], lo[more], hi[more]
        if len(own):
            # Windows with one interval are one phrase.
            edge, back = np.unique(np.column_stack([lo, hi]), axis=0, return_inverse=True)
            width = edge[:, 1] - edge[:, 0]
            inside = np.repeat(edge[:, 0], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            found = np.minimum.reduceat(key_of[inside], np.cumsum(width) - width)
            least[own] = found[back.ravel()]
    return row, offset, least


def kept(own: Words, starts: np.ndarray, covered: np.ndarray) -> dict[str, pa.Array]:
    texts, gone = [], np.concatenate([[0], np.cumsum(covered)])[starts]
    for a, b, any_gone in zip(starts.tolist(), starts[1:].tolist(), np.diff(gone).tolist()):
        words = own.words[a:b]
        if any_gone:
            words = [w for w, c in zip(words, covered[a:b].tolist()) if not c]
        texts.append(b" ".join(words).decode())
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    inner = starts[1:-1][starts[1:-1] < len(covered)]
    opens[inner] = covered[inner]
    return {
        "n_words": pa.array(np.diff(starts)),
        "n_removed": pa.array(np.diff(gone)),
        "n_spans": pa.array(np.diff(np.concatenate([[0], np.cumsum(opens)])[starts])),
        "kept": pa.array(texts, pa.string()),
    }


FINDER = Finder(
    WINDOW, GRAM, symbols, rows, folded, pack, unpack, first, kept,
    "n_words long, n_removed long, n_spans long, kept string",
)


def remove_repeated_phrases(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``n_spans`` and ``kept`` (the words left, joined by
    blanks) of every row: words go that a window of 13 words covers whose words also start in a
    row with a smaller key."""
    return remove_repeats(docs, FINDER, key, text)
