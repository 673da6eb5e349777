"""Removal of byte strings that occur in an earlier document, with suffix sorting by buckets.

The windows that may be shared meet by their anchors (see ``windows``); a task then sorts the
suffixes that begin at these windows. First the
suffixes at the places of a difference cover are ranked, by doubling the compared length. A
window is at most 7 bytes before a sampled place; contexts are laid out at multiples of the
period with their anchors at one place, so that windows that can be equal have equal residues.
So the order of a residue's windows is that of the sampled suffixes behind them, sorted stably
by the few bytes before: bucket by bucket of leading bytes, with one bucket's keys held at a
time, and long ties are settled by the ranks. Neighbours that agree in a whole window are
occurrences of one string, and the least key among them is the first document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import raw_bytes
from .windows import Anchors, Finder, remove_repeats

WINDOW, GRAM = 50, 16
PERIOD = 16
# A difference cover of 16. Every residue is a difference of two of these.
COVER = [0, 1, 2, 5, 8]
BUCKET = 1 << 18
REACH = WINDOW - GRAM + 1
WIDTH = WINDOW + REACH - 1
SLOT = -(-WIDTH // PERIOD) * PERIOD + PERIOD

_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_TO_SAMPLE = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, starts = raw_bytes(column)
    return _CODES[data], starts, data


def rows(data: np.ndarray, a: Anchors) -> np.ndarray:
    place = (a.at - (REACH - 1))[:, None] + np.arange(WIDTH)
    inside = (place >= a.first[:, None]) & (place < (a.last + WINDOW)[:, None])
    out = np.zeros((len(place), SLOT), np.uint8)
    if len(place):
        out[:, :WIDTH] = np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0)
    return out


def folded(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view("<u8")


def pack(rows: np.ndarray) -> bytes:
    return np.ascontiguousarray(rows[:, :WIDTH]).tobytes()


def unpack(body: bytes) -> np.ndarray:
    found = np.frombuffer(body, np.uint8).reshape(-1, WIDTH)
    return np.pad(found, ((0, 0), (0, SLOT - WIDTH)))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number in byte order."""
    out = np.zeros(len(text) - 7, np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | text[i : len(text) - 7 + i]
    return out


def _ranked(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Ranks from 1 of rows whose sorted order is given; equal rows share one."""
    new = np.zeros(len(order), bool)
    for k in keys:
        in_order = k[order]
        new[1:] |= in_order[1:] != in_order[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) + 1
    return rank


def cover_order(words: np.ndarray, slots: int, slot: int, last: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled places up to ``last`` of each slot in the order of their suffixes, and ranks.

    Suffixes are compared to ``depth`` bytes at least. Ranks start from ``PERIOD`` bytes and
    double their depth each round; a round ranks the places that the next ones still need.
    """
    rounds = [PERIOD]
    while rounds[-1] < depth:
        rounds.append(rounds[-1] * 2)
    reaches = [last]
    for known in reversed(rounds[:-1]):
        reaches.append(reaches[-1] + known)
    rank = np.zeros(slots * slot + rounds[-1] + slot, np.int64)
    for known, reach in zip(rounds, reversed(reaches)):
        inside = np.arange(min(reach + 1, slot))
        inside = inside[np.isin(inside % PERIOD, COVER)]
        at = (np.arange(slots)[:, None] * slot + inside).ravel()
        if known == PERIOD:
            keys = [words[at], words[at + 8]]
            order = np.lexsort(keys[::-1])
        else:
            half = known // 2
            keys = [rank[at] * (len(rank) + 1) + rank[at + half]]
            order = np.argsort(keys[0], kind="stable")
        rank[at] = _ranked(order, keys)
    return at[order], rank


def first(rows: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, least key that has this window) of all windows of all rows."""
    slots = len(rows)
    # Suffixes that leave their slot read into the next one; no window does.
    text = np.concatenate([rows.ravel(), np.zeros(SLOT + 8, np.uint8)])
    words = _words(text)
    sample, _ = cover_order(words, slots, SLOT, REACH - 1 + PERIOD // 2, WINDOW)
    sample_row, sample_place = sample // SLOT, sample % SLOT
    out_row, out_offset, out_least = [], [], []
    for residue in range(PERIOD):
        # The windows of a residue in the order of the sampled suffix behind them, ...
        ahead = int(_TO_SAMPLE[residue])
        taken = (sample_place - ahead) % PERIOD == residue
        row, place = sample_row[taken], sample_place[taken] - ahead
        offset = REACH - 1 - place
        inside = (place >= 0) & (offset >= low[row]) & (offset <= high[row])
        row, place, offset = row[inside], place[inside], offset[inside]
        at = row * SLOT + place
        if not len(at):
            continue
        # ... then bucket by bucket of leading bytes by the bytes before it.
        if ahead:
            front = words[at] >> np.uint64(64 - 8 * ahead)
            order = _bucket_sorted(front, ahead)
            row, offset, at = row[order], offset[order], at[order]
        new = np.zeros(len(at), bool)
        new[0] = True
        for skip in (*range(0, WINDOW - 8, 8), WINDOW - 8):
            w = words[at + skip]
            new[1:] |= w[1:] != w[:-1]
        cuts = np.flatnonzero(new)
        found = np.minimum.reduceat(keys[row], cuts)
        out_row.append(row)
        out_offset.append(offset)
        out_least.append(np.repeat(found, np.diff(np.append(cuts, len(at)))))
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_row, out_offset, out_least))


def _bucket_sorted(front: np.ndarray, size: int) -> np.ndarray:
    """The stable order of ``size`` leading bytes: buckets by the first two, then each bucket
    on its own, so that only one bucket's keys are held."""
    if size <= 2:
        return np.argsort(front.astype(np.uint16), kind="stable")
    lead = (front >> np.uint64(8 * (size - 2))).astype(np.uint16)
    order = np.argsort(lead, kind="stable")
    lead = lead[order]
    edges = np.append(np.flatnonzero(np.append(True, lead[1:] != lead[:-1])), len(lead))
    start = 0
    while start < len(order):
        # Whole buckets, as many as fit; a larger one stands alone.
        fit = np.searchsorted(edges, start + BUCKET, side="right") - 1
        stop = int(edges[max(fit, np.searchsorted(edges, start, side="right"))])
        part = order[start:stop]
        order[start:stop] = part[np.argsort(front[part], kind="stable")]
        start = stop
    return order


def kept(data: np.ndarray, starts: np.ndarray, covered: np.ndarray) -> dict[str, pa.Array]:
    n = len(starts) - 1
    # A run of removed bytes ends with its document.
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    inner = starts[1:-1][starts[1:-1] < len(data)]
    opens[inner] = covered[inner]
    spans_of = np.concatenate([[0], np.cumsum(opens)])
    closes = covered.copy()
    closes[:-1] &= ~covered[1:]
    closes[inner[inner > 0] - 1] = covered[inner[inner > 0] - 1]
    row = np.repeat(np.arange(n), np.diff(starts))
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    base = starts[row[begin]] if len(begin) else begin
    span = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["start", "end"])
    rest = data[~covered]
    lengths = np.diff(np.concatenate([[0], np.cumsum(~covered)])[starts])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(rest.tobytes())])
    return {
        "n_bytes": pa.array(np.diff(starts)),
        "spans": pa.ListArray.from_arrays(pa.array(spans_of[starts].astype(np.int32)), span),
        "kept": body,
    }


FINDER = Finder(
    WINDOW, GRAM, symbols, rows, folded, pack, unpack, first, kept,
    "n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary",
)


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``spans`` (the removed runs of bytes) and ``kept`` (the rest) of
    every row: bytes go that a string of 50 bytes covers which also starts in a smaller key."""
    return remove_repeats(docs, FINDER, key, text)
