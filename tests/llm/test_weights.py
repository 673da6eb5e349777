"""Clusters, samples and language-model scores against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline.llm import centroids, importance, kneser_ney, kneser_ney_rows, queries
from wearline.llm.common import segments

# -- clusters ----------------------------------------------------------------------


def plain_clusters(rows, k, rounds, salt, width):
    """Cluster and distance of each row, the final centroids and the rows that take part."""
    kept = [(key, [int(x) for x in v]) for key, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"{salt}:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None]
    centres = [v for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(own[i]) for x in zip(*own[i])] if own[i] else c for i, c in enumerate(centres)]
    return [(key, *reversed(nearest(v))) for key, v in kept], centres


def check_clusters(spark, rows, k, rounds, width):
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("v", F.lit("x")).withColumn("cluster", F.lit("y"))
    got = centroids.cluster(df, k, rounds, "2", width).collect()
    want, centres = plain_clusters(rows, k, rounds, "2", width)
    fit = lambda n: n if n < 1 << 63 else None
    sums = Counter()
    for _, c, d in want:
        sums[c] += d
    line = lambda r: tuple((x is None, x or 0) for x in r)
    full = [
        (key, c, fit(d), fit(sums[c]), fit(sum(sums.values())), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for key, c, d in want
    ]
    assert sorted(map(line, map(tuple, got))) == sorted(map(line, full))
    return got


@pytest.mark.parametrize("seed", range(3))
def test_clusters_with_ties_and_repeated_rows(spark, seed):
    draw = random.Random(seed)
    rows = [(i, [float(draw.randint(-4, 4)) for _ in range(5)]) for i in range(300)]
    rows += [(None, [1.0] * 5), (None, [1.0] * 5), (7, [2.0] * 5), rows[3], rows[3], (900, None), (901, [1.0]), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 5), (904, [float("inf")] * 5), (905, [])]
    got = check_clusters(spark, rows, 12, 4, 5)
    assert sum(r.vec_id is None for r in got) == 2 and not any(r.vec_id and r.vec_id >= 900 for r in got)


def test_fewer_vectors_than_centroids_and_large_ones(spark):
    check_clusters(spark, [(1, [3.0]), (2, [-3.0]), (3, [3.0])], 40, 3, 1)
    check_clusters(spark, [(i, [1e21 * (i % 3), float(i), -(2.0**70)]) for i in range(30)], 4, 3, 3)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, vector array<double>")
    found = centroids.cluster(empty, 4, 2, "2", 3)
    assert found.count() == 0 and found.columns[:3] == ["vec_id", "cluster", "distance"]
    nameless = spark.createDataFrame([(None, [1.0])], empty.schema)
    assert centroids.cluster(nameless, 4, 2, "2", 1).count() == 0


def test_threshold_stops_before_all_centroids_are_met(monkeypatch):
    draw = np.random.default_rng(2)
    own = draw.integers(0, 100_000, (50, 2)).astype(float)
    lists = centroids.Lists(own)
    number, distance = lists.nearest(own + 1)
    assert (number == np.arange(50)).all() and (distance == 2).all()


# -- samples -----------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def plain_sample(rows, target, percent, least, salt):
    """(key, n_features, weight, score, rank) of each row; equal keys and scores in any order."""
    ours, theirs = Counter(), Counter()
    for _, text in rows:
        ours += plain_features(text)[1]
    for text in target:
        theirs += plain_features(text)[1]
    all_ours, all_theirs = ours.total() + 10000, theirs.total() + 10000
    gain = lambda b: math.floor(1000 * math.log((theirs[b] + 1) * all_ours / ((ours[b] + 1) * all_theirs)))
    out = []
    for key, text in rows:
        words, found = plain_features(text)
        weight = sum(n * gain(b) for b, n in found.items())
        h = int(hashlib.sha256(f"{salt}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, found.total(), words, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = rank
    return sorted((tuple(r) for r in out), key=str)


def test_samples(spark, docs_of):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdeXYÄé7-_") for _ in range(draw.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(draw.randint(0, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, " . "), (None, "a b c " * 10), (None, "x"), (3, rows[3][1]), (3, rows[3][1]), (503, "z" * 5000 + " tail"), (504, "long " * 3000)]
    target = [" ".join(word() for _ in range(30)) for _ in range(20)] + [None, "long long long"]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs_of(rows).repartition(6), benchmark, 30, 20, "42")
    assert got.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_sample(rows, target, 30, 20, "42")


def test_sample_of_few_or_no_rows(spark, docs_of):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs_of([]), benchmark, 5, 20, "42").count() == 0
    few = importance.resample(docs_of([(1, "a " * 30), (2, "b")]), benchmark, 5, 20, "42").collect()
    assert [r.rank for r in few] == [None, None]


@pytest.mark.parametrize("rows,kept,shrunk", [(3000, 256, 8), (3000, 2, 2), (1, 256, 8)])
def test_cutoff_is_the_key_of_its_rank(spark, monkeypatch, rows, kept, shrunk):
    monkeypatch.setattr(importance, "KEPT", kept)
    monkeypatch.setattr(importance, "SHRUNK", shrunk)
    draw = random.Random(rows)
    keys = sorted((draw.randint(-5, 5), draw.choice([0, 0, 1]), i) for i in range(rows))
    df = spark.createDataFrame(draw.sample(keys, rows), "a long, b long, c long").repartition(7)
    for rank in {1, rows, rows // 2 or 1, rows // 20 or 1}:
        assert importance.cutoff(df, ["a", "b", "c"], rank) == keys[rank - 1]
    assert importance.cutoff(df, ["a", "b", "c"], rows + 1) is None


def test_merged_medians_keep_a_share_on_each_side():
    draw = random.Random(3)
    groups = [[(draw.randint(0, 10**6),) for _ in range(draw.choice([1, 5, 200]))] for _ in range(3000)]
    medians = importance._drawn_together([(sorted(g)[(len(g) - 1) // 2], len(g)) for g in groups])
    assert len(medians) <= importance.KEPT
    values = [x for g in groups for x in g]
    pivot = importance.weighted_median(medians)
    assert 0.24 < sum(v <= pivot for v in values) / len(values) < 0.76


# -- language model ----------------------------------------------------------------


def plain_tokens(text, pads):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ["<s>"] * pads + words + ["</s>"]


class PlainModel:
    """The recursion of the definition over dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        counts = Counter()
        self.raw = Counter()
        for text in texts:
            seq = plain_tokens(text, order - 1)
            self.raw.update(seq[order - 1 :])
            counts.update(tuple(seq[i : i + order]) for i in range(len(seq) - order + 1))
        self.levels = {order: counts}
        for size in range(order - 1, 0, -1):
            self.levels[size] = Counter(g[1:] for g in self.levels[size + 1])
        self.context = {size: defaultdict(list) for size in self.levels}
        for size, grams in self.levels.items():
            for gram, n in grams.items():
                self.context[size][gram[:-1]].append(n)
        self.d = {size: kneser_ney.discounts([sum(n == k for n in grams.values()) for k in (1, 2, 3, 4)]) for size, grams in self.levels.items()}

    def p(self, gram):
        size = len(gram)
        if not size:
            return 1 / (len(self.raw) + 1)
        behind, d = self.context[size].get(gram[:-1], []), self.d[size]
        lower = self.p(gram[1:])
        if not behind:
            return lower
        total = sum(behind)
        n = self.levels[size][gram]
        return max(n - d[min(n, 3)], 0) / total + sum(d[min(x, 3)] for x in behind) / total * lower

    def score(self, text):
        seq = plain_tokens(text, self.order - 1)
        ends = range(self.order - 1, len(seq))
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1 : i + 1]))) for i in ends)


def prose(draw, words, n):
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.mark.parametrize("order,bucket_bytes", [(2, 1 << 24), (2, 200), (3, 400), (4, 1 << 24)])
def test_model_scores(docs_of, order, bucket_bytes):
    draw = random.Random(order)
    words = ["The", "the", "of", "é", "a,b", *[f"w{i}" for i in range(40)]]
    rows = [(i, prose(draw, words[: draw.choice([3, 8, 45])], draw.randint(0, 60))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (None, "the of new"), (None, "the of new"), (3, rows[3][1]), (204, "  x y")]
    unseen = [(300, "never met words"), (301, "the never of")]
    model = kneser_ney.learn(docs_of(rows), order, bucket_bytes=bucket_bytes)
    plain = PlainModel([t for _, t in rows], order)
    assert (model.tokens, model.words) == (plain.raw.total(), len(plain.raw))
    flagged = docs_of(rows + unseen).withColumn("held_out", F.col("doc_id") >= 300)
    got = model.score(flagged).collect()
    want = sorted(((k, len(plain_tokens(t, 0)), sum(w in plain.raw for w in plain_tokens(t, 0)), t) for k, t in rows + unseen), key=str)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r) for r in got), key=lambda x: str(x[:3]))
    assert [g[:3] for g in got] == sorted([w[:3] for w in want], key=str)
    by_key = {k: t for k, t in rows + unseen}
    low = plain.raw.total() + len(plain.raw) + 1
    for key, _, _, r in got:
        text = by_key[key]
        assert r.score == pytest.approx(plain.score(text), rel=1e-9)
        assert r.base_score == pytest.approx(sum(math.log10((plain.raw[w] + 1) / low) for w in plain_tokens(text, 0)), rel=1e-12)
        assert r.held_out == (None if key is None else key >= 300)


def test_query_scores_by_grams_of_five_words(spark, tmp_path):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, prose(draw, words, draw.randint(0, 40))) for i in range(60)] + [(60, None), (None, "w1 w2"), (61, "new w1 w2 w3 w4 w5")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = PlainModel([t for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 7 != 2], 5)
    got = queries.op13_kneser_ney(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.held_out for r in got) > 3
    for r in got:
        assert r.score == pytest.approx(plain.score(dict(rows)[r.doc_id]), rel=1e-9)
        assert r.train_tokens == plain.raw.total()


def check_rows(docs_of, rows, order, bucket_bytes):
    flagged = docs_of(rows).withColumn("held_out", F.col("doc_id") >= 300)
    got = kneser_ney_rows.learn_and_score(flagged, order=order, bucket_bytes=bucket_bytes).collect()
    plain = PlainModel([t for k, t in rows if k is None or k < 300], order)
    low = plain.raw.total() + len(plain.raw) + 1
    want = [(k, None if k is None else k >= 300, plain_tokens(t, 0), t) for k, t in rows]
    want = [(k, f, len(w), sum(x in plain.raw for x in w), t) for k, f, w, t in want]
    name = lambda r: tuple(map(str, r[:4]))
    assert sorted(map(name, got)) == sorted(map(name, want))
    texts = defaultdict(list)
    for w in want:
        texts[name(w)].append(w[4])
    for r in got:
        scores = {t: plain.score(t) for t in texts[name(r)]}
        assert any(r.score == pytest.approx(s, rel=1e-9) for s in scores.values())
        assert any(r.base_score == pytest.approx(sum(math.log10((plain.raw[w] + 1) / low) for w in plain_tokens(t, 0)), rel=1e-12) for t in scores)
        assert r.train_tokens == plain.raw.total() and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


@pytest.mark.parametrize("order,bucket_bytes", [(2, 1 << 24), (2, 100), (5, 1 << 24), (5, 100), (5, 1500)])
def test_rows_scored_where_their_grams_meet(docs_of, order, bucket_bytes):
    """Small buckets split the contexts of all sizes."""
    draw = random.Random(order + bucket_bytes)
    words = ["The", "the", "of", "é", "a,b", "Y" * 70, "y" * 70, "z" * 64 + "a", "z" * 64 + "b", *[f"w{i}" for i in range(30)]]
    rows = [(i, prose(draw, words[: draw.choice([3, 9, 39])], draw.randint(0, 60))) for i in range(80)]
    rows += [(i, "the of the of the " * 9) for i in range(100, 110)] + [(120, "é Ü x\x0bx\x1fx\xa0x"), (121, " \n\t "), (122, ""), (123, None)]
    rows += [(None, "the of new"), (None, "the of new"), (3, rows[3][1]), (204, "  x y")]
    rows += [(300, "never met words"), (301, "the never of the of the of"), (302, None), (303, "unknown " * 30), *[(i, rows[i - 310][1] or "") for i in range(310, 330)]]
    check_rows(docs_of, rows, order, bucket_bytes)


def test_rows_scored_by_a_model_of_no_texts(docs_of):
    check_rows(docs_of, [(300, "a b"), (301, None)], 5, 1 << 24)
    flagged = docs_of([]).withColumn("held_out", F.lit(True))
    assert kneser_ney_rows.learn_and_score(flagged).count() == 0


def test_tokens_are_kept_in_few_bytes():
    draw = np.random.default_rng(5)
    ids = np.minimum(draw.zipf(1.2, 30_000), 1_000_000).astype(np.uint32)
    arrays = {f"w{k}": np.roll(ids, k) for k in range(5)} | {"none": np.empty(0, np.int64), "large": np.array([1 << 63, 5], np.uint64)}
    body = kneser_ney_rows.squeezed(arrays)
    assert len(body) < 10 * len(ids)
    back = kneser_ney_rows.loosened(body)
    assert list(back) == list(arrays) and all((back[n] == a).all() for n, a in arrays.items())


def test_probabilities_add_up_to_one(docs_of):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    model = kneser_ney.learn(docs_of([(i, prose(draw, words, 30)) for i in range(20)]), 2)
    hashes = kneser_ney.WordHashes().of([w.encode() for w in [*words, "unseen"]])
    for context in (hashes[0], kneser_ney.BEGIN, hashes[-1]):
        total = 0.0
        for w in [*hashes, kneser_ney.END]:
            tokens = np.array([context, w], np.uint64)
            total += 10 ** model.logs(tokens, np.array([1]))[0][0]
        assert total == pytest.approx(1.0)


def test_frequent_words_take_several_buckets(docs_of):
    rows = [(i, " ".join(f"the w{i}_{j}" for j in range(50))) for i in range(40)]
    model = kneser_ney.learn(docs_of(rows), 2, bucket_bytes=500)
    at = np.flatnonzero(model.places.words == kneser_ney.WordHashes().of([b"the"])[0])
    assert len(model.places.words) <= 2 * model.places.buckets + 1 and model.places.spread[at[0]] > 5
    plain = PlainModel([t for _, t in rows], 2)
    got = model.score(docs_of(rows[:3]).withColumn("held_out", F.lit(False))).collect()
    assert [r.score for r in got] == [pytest.approx(plain.score(rows[r.doc_id][1])) for r in got]


def test_model_of_no_texts(docs_of):
    model = kneser_ney.learn(docs_of([]), 2)
    assert (model.tokens, model.words) == (0, 0)
    got = model.score(docs_of([(1, "a b"), (2, None)]).withColumn("held_out", F.lit(True))).collect()
    assert [(r.score, r.base_score, r.n_tokens, r.n_known) for r in got] == [(0.0, 0.0, 3, 0), (0.0, 0.0, 1, 0)]
    assert model.score(docs_of([]).withColumn("held_out", F.lit(True))).count() == 0


def test_segments_cut_at_blanks_only():
    draw = random.Random(2)
    text = " ".join("x" * draw.randint(1, 40) for _ in range(500)).encode() + b"\n" + b"y" * 300
    parts = list(segments(text, 64))
    assert len(parts) > 50 and [w for p in parts for w in p.split()] == text.split()
    assert list(segments(b"", 64)) == [b""]
