from __future__ import annotations

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from wearline.operators import audit, gold, learn, serving
from wearline.operators.changes import CHANGE, META, VERSION, as_of_version, changes_between, log_of_versions
from wearline.operators.layout import clustered, gridded
from wearline.operators.upsert import upsert
from wearline.plans import queries
from wearline.plans.queries import features, machine_features, prediction_log, rounded
from wearline.schemas import FAILURES, GROUP_KEYS, MEASURES, with_labels
from wearline.session import as_ts, pin, scratch
from wearline.sources.driver_tables import line_log, machine_log


@pytest.fixture(scope="module")
def feats(spark, small):
    return pin(features(spark, small))


def rows_of(df):
    return sorted(map(str, rounded(df).collect()))


def test_refreshing_cuts_before_it_aggregates(spark, small, feats):
    feed = machine_log(spark, small).filter(F.col(VERSION) > 20)
    groups = pin(gold.affected_groups(feed))
    refreshed = gold.refresh_groups(feats, groups)
    whole = gold.daily(feats).join(groups, GROUP_KEYS, "left_semi")
    assert rows_of(refreshed) == rows_of(whole) != []
    plan = refreshed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_incremental_with_moved_groups_equals_recompute(spark, small):
    before = pin(machine_features(spark, small, -1, 10))
    after = pin(upsert(before, machine_features(spark, small, 10), ["udi"]))
    feed = pin(machine_log(spark, small).filter(F.col(VERSION) > 10))
    groups = pin(gold.affected_groups(feed, "recompute"))
    fresh = pin(gold.refresh_groups(after, groups))
    gone = gold.emptied_groups(groups, fresh)
    state = gold.daily(before).join(gone, GROUP_KEYS, "left_anti")
    assert rows_of(upsert(state, fresh, GROUP_KEYS)) == rows_of(gold.daily(after))


def test_state_of_signed_changes_is_the_aggregate(spark, small):
    """Measures missing, rows that move and leave, groups that empty, and nothing left behind."""
    rows = pin(
        with_labels(machine_log(spark, small))
        .withColumn("torque_nm", F.expr("IF(reading % 3 = 0, NULL, torque_nm)"))
        .withColumn("air_temperature_k", F.expr("IF(event_date = DATE'2024-01-02', NULL, air_temperature_k)"))
    )
    state = None
    for low, high in ((-1, 4), (4, 5), (5, 29)):
        delta = pin(gold.daily_changes(changes_between(rows, low, high)))
        if state is None:
            state = delta
        else:
            kept = state.join(delta, GROUP_KEYS, "left_anti")
            state = pin(kept.unionByName(gold.merged_state(state, delta)))
        now = as_of_version(rows, ["udi"], high, null_keys=False)
        assert rows_of(gold.daily_of(state)) == rows_of(gold.daily(now)) != []
    assert state.filter("n = 0").count() > 0
    left = state.filter("n = 0").drop(*GROUP_KEYS)
    assert all(not value for row in left.collect() for value in row)
    plan = gold.merged_state(state, delta)._jdf.queryExecution().optimizedPlan().toString()
    assert "udi" not in plan


def test_feature_rows_take_the_newest_image(spark):
    base = {"udi": "int", "product_id": "string", "machine_type": "string", "event_date": "date"}
    columns = [*base, "event_hour", *MEASURES, "machine_failure", *FAILURES]
    row = [f"CAST(NULL AS {base.get(c, 'int')}) {c}" for c in columns if c != "udi"]
    data = spark.range(3).selectExpr("CAST(id % 2 AS INT) udi", *row, "CAST(id AS INT) v")
    data = data.withColumn("torque_nm", F.col("v").cast("double"))
    log = log_of_versions(data, ["udi"], "v", as_ts("2024-01-01"))
    got = {r.udi: r.torque_nm for r in gold.feature_rows(log, as_ts(None)).collect()}
    assert got == {0: 2.0, 1: 1.0}


def test_audit_pairs_hold_every_version_pair(spark, small):
    log = pin(machine_log(spark, small))
    made = gold.rule_predictions(log.filter(F.col(CHANGE) != "update_preimage"), F.current_timestamp(), also=META)
    pairs = audit.audit_pairs(log, made)
    n = made.groupBy("udi").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert pairs.count() == n
    late = audit.audit_pairs(log, made, silver_start=25, gold_start=28)
    assert late.agg(F.min("silver_version"), F.min("gold_version")).first()[:] == (25, 28)


def test_risk_bands(spark):
    data = spark.createDataFrame(
        [(0.0, 0), (34.0, 100), (35.0, 100), (70.0, 100)], "avg_tool_wear double, max_tool_wear int"
    )
    got = [(r.risk_score, r.risk_band) for r in serving.risk(data).collect()]
    assert got == [(0.0, "low"), (34.0, "low"), (35.0, "medium"), (70.0, "high")]


def test_health_and_totals_of_no_rows(feats):
    assert tuple(serving.health(feats, "nowhere").first()) == (0.0, 0, 0)
    assert {r.total_failures for r in serving.failure_distribution(feats, "nowhere").collect()} == {0}
    assert tuple(serving.summary(feats, "nowhere").first()) == (0, 0, 0)
    assert serving.binned(serving.heat(feats, "nowhere")).count() == 0


def test_all_choice_means_no_filter(feats):
    assert serving.summary(feats, "Todos", "Todos").first() == serving.summary(feats).first()


def test_distribution_reads_the_table_once(feats):
    plan = serving.failure_distribution(feats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert serving.binned(serving.heat(feats), bins=5).agg(F.max("air_bin")).first()[0] == 4


def test_clustered_keeps_rows_and_narrows_files(spark, feats):
    path = scratch(spark, "z")
    clustered(feats, ["product_id", "event_date"], files=4).write.parquet(path)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, feats.collect()))
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("product_id").alias("p"))
    products = feats.agg(F.count_distinct("product_id")).first()[0]
    assert spans.count() == 4 and spans.filter(F.col("p") <= products / 3).count() == 4


def test_every_row_is_in_one_part_of_a_split(spark):
    rows = spark.range(200).selectExpr(
        "IF(id % 4 = 0, NULL, id) k", "IF(id % 5 = 0, NULL, IF(id = 1, 9, id % 2)) s", "id"
    )
    train, test = learn.stratified_split(rows, "s", "k")
    assert sorted(r.id for r in train.unionByName(test).collect()) == list(range(200))
    assert test.filter("s IS NULL").count() > 0 and test.filter("s = 9").count() == 0


def test_grid_skips_by_either_column_and_fills_files(spark):
    rows = spark.range(60_000, numPartitions=6).selectExpr(
        "IF(id % 3 = 0, 7, id * 7919 % 1000) a", "IF(id % 11 = 0, NULL, concat('k', id * 104729 % 997)) b", "id"
    )
    path = scratch(spark, "grid")
    gridded(rows, ["a", "b"], files=25).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.agg(F.sum("id"), F.count("*")).first()[:] == (60_000 * 59_999 // 2, 60_000)
    files = back.groupBy(F.input_file_name()).agg(
        F.min("a").alias("la"), F.max("a").alias("ha"), F.min("b").alias("lb"), F.max("b").alias("hb"), F.count("*").alias("n")
    ).collect()
    assert 15 <= len(files) <= 35 and max(f.n for f in files) < 2.5 * 60_000 / 25
    assert sum(f.la <= 500 <= f.ha for f in files) <= len(files) / 3
    assert sum(f.lb is not None and f.lb <= "k500" <= f.hb for f in files) <= len(files) / 3


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_grid_of_few_rows(spark, rows):
    few = spark.range(rows).selectExpr("CAST(NULL AS STRING) a", "id b", "id")
    assert sorted(r.id for r in gridded(few, ["a", "b"]).collect()) == list(range(rows))
    assert gridded(few, ["a", "b"], files=9).count() == rows


def test_heat_is_scanned_once_for_bounds_and_bins(spark, feats):
    found = serving.binned(serving.heat(feats))
    assert found.count() and found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.collectToPython()
    text = plan.toString()
    final = text[text.index("Final Plan") : text.index("Initial Plan")] if "Initial Plan" in text else text
    assert final.count("FileScan") - final.count("ReusedExchange") <= 1


def test_clustered_splits_a_hot_value(spark):
    hot = spark.range(40_000, numPartitions=4).selectExpr(
        "IF(id % 3 = 0, 'P7', concat('P', id)) product_id", "DATE'2024-01-01' event_date", "id"
    )
    path = scratch(spark, "z")
    clustered(hot, ["product_id", "event_date"], files=8).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 10_000


def test_split_is_stratified_and_stable(spark, feats):
    train, test = learn.stratified_split(feats, "machine_failure", "udi")
    assert train.count() + test.count() == feats.count()
    assert train.join(test, "udi", "left_semi").count() == 0
    sizes = feats.groupBy("machine_failure").count().withColumnRenamed("count", "n")
    shares = test.groupBy("machine_failure").count().join(sizes, "machine_failure")
    for r in shares.collect():
        assert abs(r["count"] - r.n * 0.2) <= max(2, r.n * 0.01)
    again = learn.stratified_split(feats.repartition(3), "machine_failure", "udi")[1]
    assert sorted(again.select("udi").collect()) == sorted(test.select("udi").collect())


def test_f1_is_zero_where_undefined(spark):
    data = spark.createDataFrame([(1, 1, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0)], "a int, b int, c int, d int")
    got = learn.f1_scores(data, {"x": ("a", "b"), "y": ("c", "d")}).collect()
    assert [tuple(r) for r in got] == [("x", 0.5), ("y", 0.0)]


def test_models_learn_and_survive_saving(spark):
    data = spark.range(400).selectExpr(
        "CAST(id AS INT) udi",
        "concat('P', id) product_id",
        "300.0D + id % 7 air_temperature_k",
        "310.0D + id % 11 process_temperature_k",
        "CAST(1200 + id % 13 AS INT) rotational_speed_rpm",
        "IF(id % 10 = 9, NULL, CAST(id % 50 AS DOUBLE)) torque_nm",
        "CAST(id % 100 AS INT) tool_wear_min",
        *[f"IF(id % 50 > {10 * i + 5}, 1, 0) {f}_label" for i, f in enumerate(FAILURES)],
    )
    model = learn.fit(data, rounds=2, depth=2)
    path = scratch(spark, "model")
    learn.save(model, path)
    loaded = learn.load(path)
    found = {r.target: r.f1 for r in learn.evaluate(loaded, data).collect()}
    assert list(found) == FAILURES and min(found.values()) > 0.8
    scored = learn.score(loaded, data, as_ts("2024-01-01"))
    ones = scored.agg(F.min("prediction_score"), F.max("prediction_score")).first()
    assert 0 <= ones[0] < ones[1] <= 1
    assert scored.count() == 400
    assert scored.filter("udi % 10 <> 9 AND pred_twf <> IF(udi % 50 > 5, 1, 0)").count() == 0


def sensor_rows(spark, n, parts):
    return spark.range(n, numPartitions=parts).selectExpr(
        "CAST(id AS INT) udi",
        "concat('P', id) product_id",
        "300.0D + id % 7 air_temperature_k",
        "310.0D + id % 11 process_temperature_k",
        "CAST(1200 + id % 13 AS INT) rotational_speed_rpm",
        "CAST(id % 50 AS DOUBLE) torque_nm",
        "CAST(id % 100 AS INT) tool_wear_min",
        *[f"IF(id % 50 > {10 * i + 5}, 1, 0) {f}_label" for i, f in enumerate(FAILURES)],
    )


def test_models_are_fitted_in_tasks_by_rows(spark, monkeypatch):
    seen = []
    whole = learn.GBTClassifier.fit

    def fit(trees, data):
        seen.append((data.rdd.getNumPartitions(), data.count()))
        return whole(trees, data)

    monkeypatch.setattr(learn.GBTClassifier, "fit", fit)
    learn.fit(sensor_rows(spark, 400, 40), rounds=1, depth=1)
    assert seen == [(1, 400)] * len(FAILURES)
    assert learn.training_rows(sensor_rows(spark, 2 * learn.ROWS_PER_TASK + 1, 1)).rdd.getNumPartitions() == 3


def test_training_tasks_do_not_exceed_those_that_run_at_once(spark, monkeypatch):
    monkeypatch.setattr(learn, "ROWS_PER_TASK", 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = learn.training_rows(sensor_rows(spark, 400, 40))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (rows.rdd.getNumPartitions(), rows.count()) == (spark.sparkContext.defaultParallelism, 400)


def test_models_of_queries_learn_from_all_train_rows(spark, tmp_path, monkeypatch):
    spark.range(70_000).selectExpr(
        "id event_id",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) ts",
        "id % 1500 user_id",
        "element_at(array('click', 'view', 'purchase', 'signup'), CAST(id % 4 AS INT) + 1) event_type",
        "CAST(id * 31 % 997 AS DOUBLE) / 10 value",
    ).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    whole = learn.GBTClassifier.fit

    def fit(trees, data):
        seen.append(data.count())
        return whole(trees, data)

    monkeypatch.setattr(learn.GBTClassifier, "fit", fit)
    monkeypatch.setattr(learn, "fit", partial(learn.fit, rounds=1, depth=1))
    queries._model(spark, str(tmp_path))
    train, _ = learn.stratified_split(queries.taught(spark, str(tmp_path)), "machine_failure", "udi")
    assert train.count() > 55_000 and seen == [train.count()] * len(FAILURES)


def test_scoring_is_spread_and_on_dense_vectors(spark):
    model = learn.fit(sensor_rows(spark, 400, 2), rounds=1, depth=1)
    rows = sensor_rows(spark, 400_000, 1)
    scored = learn.score(model, rows, as_ts("2024-01-01"))
    parts = scored.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 400_000 and max(r["count"] for r in parts) < 200_000
    assert type(model.transform(rows).first()["_features"]).__name__ == "DenseVector"


def test_line_log_versions(spark, small):
    log = line_log(spark, small)
    assert log.filter(F.col(CHANGE) == "insert").count() == log.select("l_orderkey", "l_linenumber").distinct().count()


def test_reports_come_in_their_order(spark, small):
    log = machine_log(spark, small)
    rows = audit.change_history(log, audit.SILVER_HISTORY).collect()
    keys = [(r[VERSION], r.udi, r[CHANGE]) for r in rows]
    assert keys == sorted(keys) and len(keys) > 100
    times = [r.gold_commit_ts for r in audit.newest_first(audit.audit_pairs(log, prediction_log(spark, small))).collect()]
    assert times == sorted(times, reverse=True) and len(set(times)) > 5


@pytest.mark.parametrize("seconds", [7, 1000, 86_400])
def test_current_predictions_of_a_hot_machine(spark, seconds):
    """Against brute force: one machine with most commits, some without a machine, several models."""
    draw = random.Random(seconds)
    machine = lambda: draw.choice([(1, "P")] * 6 + [(2, "P"), (3, "Q"), (None, "P"), (4, None)])
    silver = [(*machine(), v, 3 * v + draw.choice([0, 1])) for v in range(150)]
    made = [(*machine(), v, draw.randint(0, 500), f"m{draw.randint(0, 2)}") for v in range(90)]
    taken, unique = set(), []
    for r in made:
        if (r[0], r[1], r[3], r[4]) not in taken:
            taken.add((r[0], r[1], r[3], r[4]))
            unique.append(r)
    meta = ["'insert' _change_type", "v _commit_version", "timestamp_seconds(s) _commit_timestamp"]
    left = spark.createDataFrame(silver, "udi int, product_id string, v long, s long").selectExpr("udi", "product_id", *[f"0D {m}" for m in MEASURES], *meta)
    right = spark.createDataFrame(unique, "udi int, product_id string, v long, s long, model_name string")
    right = right.selectExpr("udi", "product_id", *[f"0 {c}" for c in audit.PREDICTED], "model_name", "'v' model_version", *meta)
    want = []
    for udi, product, v, s in silver:
        whole = udi is not None and product is not None
        after = min((x[3] for x in silver if x[:2] == (udi, product) and x[3] > s), default=None)
        near = [(g[3], g[4], g[2]) for g in unique if g[:2] == (udi, product) and g[3] >= s and (after is None or g[3] < after)]
        want.append((v, min(near)[2] if near and whole else None))
    got = audit.current_predictions(left, right, seconds=seconds).collect()
    assert sorted((r.silver_version, r.gold_version) for r in got) == sorted(want)


def test_current_prediction_of_each_image(spark):
    measures = [f"0D {m}" for m in MEASURES]
    silver = spark.range(3).selectExpr(
        "CAST(1 AS INT) udi", "'P' product_id", *measures, "'insert' _change_type",
        "CAST(id AS BIGINT) _commit_version", "timestamp_seconds(id * 10) _commit_timestamp",
    )
    flags = [f"0 {c}" for c in audit.PREDICTED]
    made = spark.createDataFrame([(0, 3), (1, 7), (2, 20)], "v long, s long").selectExpr(
        "CAST(1 AS INT) udi", "'P' product_id", *flags, "'m' model_name", "'v' model_version",
        "'insert' _change_type", "v _commit_version", "timestamp_seconds(s) _commit_timestamp",
    )
    got = audit.current_predictions(silver, made).orderBy("silver_version").collect()
    assert [(r.silver_version, r.gold_version) for r in got] == [(0, 0), (1, None), (2, 2)]
