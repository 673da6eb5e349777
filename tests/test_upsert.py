"""Upserts and change feeds against a plain dictionary, on random sequences."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators import changes as C
from wearline.operators.upsert import (
    insert_absent,
    latest_per_key,
    refuse_duplicates,
    upsert,
)
from wearline.session import as_ts, scratch
from wearline.sources.tables import VersionedTable, bucketed

SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("a", T.StringType()),
        T.StructField("b", T.IntegerType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sort_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_latest_per_key_breaks_ties_and_keeps_null_keys(spark):
    data = frame(spark, [(1, "x", 1), (1, "y", 2), (1, "z", 2), (None, "n", 1), (None, "n", 1)])
    got = latest_per_key(data, ["k"], ["b"]).collect()
    assert sort_rows(got) == sort_rows([(1, "z", 2), (None, "n", 1), (None, "n", 1)])


def test_latest_of_one_hot_key_is_cut_before_the_shuffle(spark):
    data = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit("a").alias("a"),
        F.col("id").cast("int").alias("b"),
    )
    got = latest_per_key(data, ["k"], ["b"], null_keys=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert got.filter("k = 0").collect()[0].b == 199_998
    assert got.count() == data.select("k").distinct().count()


def test_duplicate_source_keys_are_refused(spark):
    twice = frame(spark, [(1, "x", 1), (1, "y", 2)])
    with pytest.raises(Exception, match="several source rows for key"):
        refuse_duplicates(twice, ["k"]).collect()
    with pytest.raises(Exception, match="several source rows for key"):
        upsert(frame(spark, []), twice, ["k"]).collect()


def test_upsert_updates_inserts_and_keeps(spark):
    target = frame(spark, [(1, "x", 1), (2, "y", 2), (None, "n", 0)])
    source = frame(spark, [(2, "Y", 20), (3, "z", 3), (None, "m", 1)])
    want = [(1, "x", 1), (2, "Y", 20), (3, "z", 3), (None, "n", 0), (None, "m", 1)]
    assert sort_rows(upsert(target, source, ["k"]).collect()) == sort_rows(want)
    partly = [(1, "x", 1), (2, "y", 20), (3, "z", 3), (None, "n", 0), (None, "m", 1)]
    assert sort_rows(upsert(target, source, ["k"], ["b"]).collect()) == sort_rows(partly)


def test_update_may_set_null(spark):
    target, source = frame(spark, [(1, "x", 1)]), frame(spark, [(1, None, None)])
    assert sort_rows(upsert(target, source, ["k"], ["b"]).collect()) == [(1, "x", None)]


def test_insert_absent(spark):
    target, source = frame(spark, [(1, "x", 1)]), frame(spark, [(1, "X", 9), (2, "y", 2)])
    got = insert_absent(target, source, ["k"]).collect()
    assert sort_rows(got) == [(1, "x", 1), (2, "y", 2)]


def test_change_rows(spark):
    before = frame(spark, [(1, "x", 1), (2, "y", 2)])
    source = frame(spark, [(2, "Y", 2), (3, "z", 3), (None, "n", 0)])
    got = C.change_rows(before, source, ["k"]).collect()
    assert sort_rows(got) == sort_rows(
        [
            (2, "y", 2, "update_preimage"),
            (2, "Y", 2, "update_postimage"),
            (3, "z", 3, "insert"),
            (None, "n", 0, "insert"),
        ]
    )
    partly = C.change_rows(before, source.filter("k = 2"), ["k"], update_cols=["b"]).collect()
    assert sort_rows(partly) == [(2, "y", 2, "update_postimage"), (2, "y", 2, "update_preimage")]


def test_unchanged_rows_can_be_left_out(spark):
    before = frame(spark, [(1, "x", 1), (2, "y", 2)])
    source = frame(spark, [(1, "x", 9), (2, "Y", 2)])
    kept = C.change_rows(before, source, ["k"], skip_unchanged=True, stamp_cols=["b"])
    assert {r.k for r in kept.collect()} == {2}
    assert C.change_rows(before, source, ["k"]).count() == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_random_commits(spark, seed):
    """Stored table, feed, history and past versions agree with a dictionary."""
    rng = random.Random(seed)
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"], snapshot_every=3)
    state, loose, snapshots = {}, [], []
    for version in range(5):
        keys = rng.sample(range(12), rng.randint(0, 6))
        rows = [(k, rng.choice("abc"), rng.randint(0, 3)) for k in keys]
        nulls = [(None, "n", version)] * rng.randint(0, 2)
        gone = [k for k in rng.sample(sorted(state), min(2, len(state))) if k not in keys]
        removed = frame(spark, [(k, None, None) for k in gone]) if gone else None
        got = table.commit(
            frame(spark, rows + nulls), as_ts(f"2024-01-0{version + 1} 00:00:00"), gone=removed
        )
        assert got == version
        state = {k: v for k, v in state.items() if k not in gone} | {r[0]: r for r in rows}
        loose = loose + nulls
        snapshots.append(list(state.values()) + loose)
    log = table.changes()
    for version, want in enumerate(snapshots):
        assert sort_rows(table.read(version).collect()) == sort_rows(want)
        replayed = C.as_of_version(log, ["k"], version).collect()
        assert sort_rows(replayed) == sort_rows(want)
    assert sort_rows(table.read().collect()) == sort_rows(snapshots[-1])
    assert sort_rows(table.read_at(as_ts("2024-01-03 12:00:00")).collect()) == sort_rows(snapshots[2])
    with pytest.raises(ValueError, match="as old as"):
        table.read_at(as_ts("2023-12-31 00:00:00"))
    with pytest.raises(ValueError, match="is not in 0..4"):
        table.read(5)
    pre = log.filter("_change_type = 'update_preimage'").select("k", C.VERSION)
    post = log.filter("_change_type = 'update_postimage'").select("k", C.VERSION)
    assert sort_rows(pre.collect()) == sort_rows(post.collect())
    columns = [C.VERSION, "rows_inserted", "rows_updated", "rows_deleted"]
    counted = {r[0]: tuple(r) for r in C.history(log).select(*columns).collect()}
    for row in table.history().select(*columns).collect():
        assert tuple(row) == counted.get(row[0], (row[0], 0, 0, 0))
    assert table.changes(3).select(C.VERSION).distinct().count() <= 2


def test_half_written_commit_is_not_seen(spark):
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"])
    table.commit(frame(spark, [(1, "x", 1)]), as_ts("2024-01-01"))
    rows = table.changes().drop(C.VERSION)
    rows.write.parquet(f"{table.path}/changes/{C.VERSION}=1")
    assert table.last_version() == 0 and table.changes().count() == 1
    table.commit(frame(spark, [(2, "y", 2)]), as_ts("2024-01-02"))
    assert sort_rows(table.read().collect()) == [(1, "x", 1), (2, "y", 2)]


def test_replayed_batch_is_left_out(spark):
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"])
    for batch in (0, 1, 1, 0):
        table.commit(frame(spark, [(batch, "x", 1)]), as_ts("2024-01-01"), writer="s", batch=batch)
    assert table.last_version() == 1


def test_bulk_log_equals_commits(spark):
    rows = [(1, "a", 1, 0), (2, "b", 1, 0), (1, "c", 2, 1), (3, "d", 1, 2), (1, "e", 3, 2)]
    data = spark.createDataFrame(rows, "k int, a string, b int, v int")
    bulk = C.log_of_versions(data, ["k"], "v", as_ts("2024-01-01"))
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"])
    for version in range(3):
        table.commit(data.filter(F.col("v") == version).drop("v"), as_ts("2024-01-01"))
    columns = [*C.META, "k", "a", "b"]
    assert sort_rows(bulk.select(*columns).collect()) == sort_rows(
        table.changes().select(*columns).collect()
    )


def test_small_source_is_broadcast_and_target_not_shuffled(spark):
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"], null_keys=False)
    many = spark.range(50_000).selectExpr("CAST(id AS INT) k", "'a' a", "CAST(id AS INT) b")
    table.commit(many, as_ts("2024-01-01"))
    few = table._stage(many.filter("k < 10"))
    near = table.read().filter(table._key_range(few))
    rows = C.change_rows(near, few, ["k"], assume_unique=True, null_keys=False)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "GreaterThanOrEqual(k,0)" in plan and "LessThanOrEqual(k,9)" in plan


def test_many_rows_without_a_key_are_spread_over_files(spark):
    """A third of the rows lacks the key; no file of the snapshot holds them all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(30_000, numPartitions=4).selectExpr(
            "IF(id % 3 = 0, NULL, CAST(id AS INT)) k", "concat('a', id) a", "CAST(id AS INT) b"
        )
        table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"], snapshot_rows=0)
        table.commit(rows, as_ts("2024-01-01"))
        table.commit(rows, as_ts("2024-01-02"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    counts = table.read().groupBy(F.col("k").isNull().alias("lacks")).count().collect()
    assert {r.lacks: r["count"] for r in counts} == {True: 20_000, False: 20_000}
    state = spark.read.parquet(f"{table.path}/state/version=1").filter("k IS NULL")
    per_file = [r.n for r in state.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_file) == 20_000 and max(per_file) < 15_000


def test_snapshots_follow_the_rows_changed(spark):
    table = VersionedTable(spark, scratch(spark, "t"), SCHEMA, ["k"], snapshot_share=0.2, snapshot_rows=0)
    table.commit(frame(spark, [(k, "x", 0) for k in range(20)]), as_ts("2024-01-01"))
    for k in range(5):
        table.commit(frame(spark, [(k, "y", 1)]), as_ts("2024-01-02"))
    states = {r[C.VERSION] for r in table.history().filter("has_state").collect()}
    assert states == {0, 5}
    assert table.read().filter("b = 1").count() == 5


def test_state_of_versions_is_one_exchange_and_the_as_of_read(spark):
    rows = spark.range(3000).selectExpr(
        "IF(id % 50 = 0, NULL, CAST(id % 40 AS INT)) k", "concat('a', id % 7) a", "CAST(id % 5 AS INT) b", "CAST(id % 9 AS INT) v"
    )
    for version in (0, 4, 8):
        whole = rows.filter("k IS NOT NULL")
        log = C.log_of_versions(latest_per_key(whole, ["k", "v"], ["b"]), ["k"], "v", as_ts("2024-01-01"))
        want = C.as_of_version(log, ["k"], version)
        got = C.state_of_versions(whole, ["k"], "v", version, ["b"], null_keys=False)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sort_rows(got.collect()) == sort_rows(want.collect()) != []
        assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "Generate" not in plan
    nameless = C.state_of_versions(rows, ["k"], "v", 8, ["b"]).filter("k IS NULL").count()
    assert nameless == rows.filter("k IS NULL").count()


def test_a_bucketed_target_is_not_moved(spark):
    many = spark.range(20_000).selectExpr("CAST(id AS INT) k", "'a' a", "CAST(id AS INT) b")
    target = bucketed(many, scratch(spark, "b"), ["k"], 8)
    source = many.filter("k % 2 = 0").selectExpr("k", "'z' a", "b").unionByName(many.selectExpr("k + 50000 AS k", "a", "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(target, source, ["k"], assume_unique=True, null_keys=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 40_000 and merged.filter("a = 'z'").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange, that of the source's keys.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
