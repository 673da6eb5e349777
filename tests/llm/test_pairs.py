"""Near copies and exact search against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wearline.llm import common, kdtree, simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(keys, near):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in near:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_fingerprints_and_components(docs_of):
    draw = random.Random(4)
    base = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(200)) for _ in range(8)]
    rows = []
    for i in range(90):
        words = draw.choice(base).split()
        for _ in range(draw.choice([0, 1, 1, 2])):
            words[draw.randrange(len(words))] = "CHANGED"
        rows.append((i, " ".join(words)))
    rows += [(100, ""), (101, None), (102, " \n"), (103, "one"), (104, "ONE"), (105, "one two"), (103, "one")]
    prints = {k: plain_print(t) for k, t in rows}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = classes(prints, near)
    got = simhash.near_copies(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id] for r in got)
    assert len(set(want.values())) > 5


@pytest.mark.parametrize("radius,width", [(0, 1), (2, 1), (5, 2), (88, 8)])
def test_bit_sliced_distances(radius, width):
    draw = np.random.default_rng(radius)
    base = draw.integers(0, 1 << 63, (10, width), dtype=np.uint64)
    rows = base[draw.integers(0, 10, 130)]
    for _ in range(radius):
        rows[np.arange(130), draw.integers(0, width, 130)] ^= np.uint64(1) << draw.integers(0, 64, 130).astype(np.uint64)
    q, v = simhash.within(rows[:70], rows, radius)
    apart = np.bitwise_count(rows[:70, None] ^ rows[None]).sum(axis=2, dtype=int)
    assert set(zip(q.tolist(), v.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius))))


def test_blocks_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    draw = random.Random(1)
    prints = {draw.getrandbits(12) for _ in range(400)}
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    got = {(r.a, r.b) for r in simhash.links(df).collect()}
    assert got == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


def test_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_classes(rows):
    """The rows' numbers by the class of their fingerprints."""
    prints = [plain_print(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    return classes(range(len(rows)), near)


def test_one_row_of_each_class_stays(spark, docs_of):
    draw = random.Random(14)
    base = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(150)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = draw.choice(base).split()
        for _ in range(draw.choice([0, 1, 1, 2])):
            words[draw.randrange(len(words))] = "CHANGED"
        rows.append((i, " ".join(words)))
    # Repeated keys with other texts, rows without a key, repeated rows, rows without words.
    rows += [(5, base[0]), (5, "own text of five"), (1, "own text of five"), (None, base[1]), (None, "alone and nameless")]
    rows += [(None, "alone and nameless"), (200, ""), (201, None), (None, " "), (77, "same row"), (77, "same row")]
    found = near_classes(rows)
    docs = docs_of(rows).withColumnsRenamed({"id": "row", "score": "at", "salt": "t"}).withColumn("_text", F.lit("x")).repartition(5)
    got = simhash.without_copies(docs)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    assert len(got) == len(set(found.values()))
    left = set()
    for key, text in got:
        mine = {found[i] for i, r in enumerate(rows) if r == (key, text)}
        assert len(mine) == 1 and not mine & left
        left |= mine
        keys = [rows[i][0] for i in found if found[i] in mine and rows[i][0] is not None]
        assert key == (min(keys) if keys else None)


def test_near_copies_of_no_rows(docs_of):
    assert simhash.near_copies(docs_of([])).count() == 0
    assert simhash.without_copies(docs_of([])).count() == 0


def test_rows_of_a_large_class_are_not_moved(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 4)
    rows = spark.createDataFrame([(i, 1 if i % 3 == 0 else i) for i in range(300)], "k long, print long")
    sizes = rows.groupBy("print").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    got = {(r.k, r.first) for r in common.spread_join(rows, sizes, "print").collect()}
    assert got == {(i, 0 if i % 3 == 0 or i == 1 else i) for i in range(300)}


def brute(vectors, queries, k):
    out = []
    for q, x in queries:
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), i) for i, y in vectors if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale,leaf", [(1, 512), (3, 8), (10**9, 32)])
def test_search_against_brute_force(spark, scale, leaf):
    draw = np.random.default_rng(3)
    rows = [(int(i), [float(int(x) * scale) for x in draw.integers(-3, 4, 6)]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    queries = [r for r in rows if r[0] % 20 == 0]
    got = kdtree.top_k(df, df.filter("vec_id % 20 = 0"), 20, shard_rows=200, query_rows=16, leaf=leaf).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, queries, 20)


def test_search_with_repeated_keys_and_large_values(spark):
    rows = [(0, [1.0, 2.0]), (0, [2.0, -1.0]), (0, [1.0, 2.0]), (1, [5.0, 5.0]), (1, [5.0, 5.0]), (2, [-1.0, 0.0]), (20, [1.0, 1.0])]
    for large in (1.0, 1e21, 1e300):
        given = [(i, [x * large for x in v]) for i, v in rows]
        df = spark.createDataFrame(given, "vec_id long, vector array<double>").withColumns({"id": F.lit("x"), "size": F.lit("y"), "v": F.lit("z")})
        got = kdtree.top_k(df, df.filter("vec_id % 20 = 0"), 3, shard_rows=2, query_rows=2).collect()
        want = []
        for q, x in given:
            if q % 20 == 0:
                scores = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), i) for i, y in given if i != q)
                want += [(q, r + 1, i, -s if -(10**38) < s < 10**38 else None) for r, (s, i) in enumerate(scores[:3])]
        assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str) == sorted(want, key=str)


def test_vectors_that_take_no_part(spark):
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [])]
    good = [(0, [1.0, 2.0]), (20, [3.0, -1.0]), (21, [1.0]), (40, [2.0])]
    df = spark.createDataFrame(bad + good, "vec_id long, vector array<double>")
    got = kdtree.top_k(df, df.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(0, 20, 1), (20, 0, 1), (40, 21, 2)]
    none = kdtree.top_k(df.filter("vec_id < 0"), df.filter("vec_id < 0"), 20)
    assert none.count() == 0 and none.filter(F.col("rank") > 0).count() == 0


def test_box_bounds_are_never_too_low():
    draw = np.random.default_rng(9)
    tree = kdtree.Tree.build(np.arange(5000), draw.integers(-50, 50, (5000, 5)).astype(float))
    tree = kdtree.Tree.unpack(tree.pack(), 5, True)
    q = draw.integers(-50, 50, 5).astype(float)
    reach = tree.reach(q[None])[0]
    assert len(reach) > 15 and tree.leaves_from == len(reach) // 2
    for node, (a, b) in enumerate(tree.bounds):
        if b > a:
            assert reach[node] >= (tree.rows[a:b] @ q).max()
