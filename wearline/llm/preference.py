"""Document quality as Bradley-Terry strengths learned from preference pairs.

A labelled good text is preferred to a labelled bad one. The chance of that is the logistic
function of the difference of two strengths, and a strength is a weighted sum of measures of
the whole text, so the weights come from a logistic loss on feature differences. The decision
threshold is a quantile of the strengths of the labelled rows; the published score is the
logistic function of the strength, shifted so that this quantile scores ``CUT``.

The weights are fitted on at most about ``max_labels`` labelled rows, chosen by a hash of the
key (one bound, documented here); scoring covers all rows in one pass without a shuffle.

NULL texts count as empty; empty texts get a score like any other. Labels that are NULL are
left out; repeated labels of a key count by their mean. Without labels of both kinds nothing
can be learned: every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import pieces, raw_bytes, texts

CUT = 0.3
MAX_LABELS = 20_000
PAIRS_PER_ROW = 8
SYMBOLS = b"#$%&*|!@^~<>{}[]\\=+_"
# Numbers and punctuation say nothing about quality: a short text may be mostly a phone number.
FEATURES = [
    "upper", "symbols", "word_length", "distinct_words", "repeated_neighbours", "distinct_lines",
    "capital_words", "length",
]

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
_CLASS[list(SYMBOLS)] = 4
_CLASS[list(b".,;:?'\"()-/")] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 6
_CLASS[128:] = 7
_CAPITALS = re.compile(rb"(?<![^\s])[A-Z]{2,}")


def measure(text: bytes, counts: np.ndarray) -> list[float]:
    """The features of one text; ``counts`` are its bytes by class."""
    n = len(text)
    if n == 0:
        return [0.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0]
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    w = max(len(words), 1)
    letters = counts[1] + counts[2] + counts[7]
    return [
        counts[1] / max(letters, 1),
        counts[4] / n,
        min((n - counts[6]) / w, 40) / 10,
        (len(set(words)) / w) ** 0.5,
        sum(map(eq, words, words[1:])) / w,
        len(set(lines)) / max(len(lines), 1),
        len(_CAPITALS.findall(text)) / w,
        np.log1p(w) / 10,
    ]


def features(batch: pa.RecordBatch, text: str) -> np.ndarray:
    data, offsets = raw_bytes(batch.column(text))
    row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(offsets))
    counts = np.bincount(row * 8 + _CLASS[data], minlength=batch.num_rows * 8).reshape(-1, 8)
    whole = data.tobytes()
    return np.array(
        [measure(whole[a:b], c) for a, b, c in zip(offsets, offsets[1:], counts.tolist())]
    ).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Strength:
    """Weights of the features (after centring and scaling) and the threshold."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def of(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.centre) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.of(rows) - self.threshold + np.log(CUT / (1 - CUT))
        # Rounding in the logistic function must not move a row over the cut.
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        over = self.of(rows) >= self.threshold
        return np.where(over, np.maximum(s, CUT), np.minimum(s, np.nextafter(CUT, 0)))


NOTHING_LEARNED = Strength(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), np.log(CUT / (1 - CUT)))


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> Strength:
    """Newton steps on the pairwise logistic loss, then the best quantile as threshold."""
    if good.all() or not good.any():
        return NOTHING_LEARNED
    centre, scale = rows.mean(0), rows.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (rows - centre) / scale
    draw = np.random.default_rng(7)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    n = PAIRS_PER_ROW * max(len(better), len(worse))
    pairs = x[better[np.arange(n) % len(better)]] - x[draw.choice(worse, n)]
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(pairs @ weights, -500, 500)))
        slope = pairs.T @ (1 - chance) / n - ridge * weights
        curve = (pairs * (chance * (1 - chance))[:, None]).T @ pairs / n + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 5 / max(np.linalg.norm(step), 1e-12))
        if np.linalg.norm(step) < 1e-8:
            break
    strength = x @ weights
    order = np.argsort(strength, kind="stable")
    sorted_strength, sorted_good = strength[order], good[order]
    # Balanced errors if the lowest k rows are refused, for every quantile k / n.
    refused_good = np.concatenate([[0], np.cumsum(sorted_good)]) / len(better)
    kept_bad = 1 - np.concatenate([[0], np.cumsum(~sorted_good)]) / len(worse)
    errors = refused_good + kept_bad
    best = np.flatnonzero(errors == errors.min())
    k = int(best[len(best) // 2])
    low = sorted_strength[max(k - 1, 0)]
    high = sorted_strength[min(k, len(strength) - 1)]
    return Strength(centre, scale, weights, float((low + high) / 2))


def labelled(labels: DataFrame, key: str, label: str, max_labels: int) -> DataFrame:
    """(``key``, ``good``) of the rows to learn from: held-out keys left out, bounded."""
    rows = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(key)
        .agg((F.avg(label) >= 0.5).alias("good"))
    )
    total = rows.count()
    if total > max_labels:
        rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * max_labels / total))
    return rows


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_labels: int = MAX_LABELS) -> Strength:
    """Fit on the labelled rows; the driver gets their features, ``max_labels`` rows at most."""
    chosen = F.broadcast(labelled(labels, key, label, max_labels))
    rows = texts(docs, key, text).join(chosen, key).select("good", text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found = pa.array(features(piece, text).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column("good"), found], ["good", "found"])

    got = rows.mapInArrow(run, "good boolean, found array<double>").toArrow().to_pydict()
    if not got["good"]:
        return NOTHING_LEARNED
    x, good = np.array(got["found"]), np.array(got["good"])
    order = np.lexsort([*x.T, good])  # the same sums whatever the order of arrival
    return fit(x[order], good[order])


def score(docs: DataFrame, strength: Strength, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    ``carry`` adds ``row``, the whole row, so that rows can be kept without a join.
    """
    source = docs.select(
        F.col(key),
        F.coalesce(F.col(text), F.lit("")).alias(text),
        F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    names = [key, "held_out", *(["row"] if carry else [])]
    schema = StructType([StructField(n, source.schema[n].dataType) for n in names])
    schema = schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found = strength.score(features(piece, text))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(n) for n in names), pa.array(found), pa.array((found >= CUT).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    return source.mapInArrow(run, schema)
