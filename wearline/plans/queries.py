"""Registered queries: each takes (spark, directory of the given tables)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.functions.rules import FAILURE_RULES, QUALITY_RULES, flags, violation
from wearline.operators import audit, changes, gold, learn, serving
from wearline.operators.control import GOLD_FLOW, advance_mark, changes_above_mark, first_mark
from wearline.operators.layout import clustered, gridded
from wearline.operators.quality import enforce, split_valid, with_event_time
from wearline.operators.quality import audit as quality_audit
from wearline.operators.upsert import insert_absent, latest_per_key, upsert
from wearline.plans.medallion import Config, Lakehouse
from wearline.schemas import (
    FAILURES,
    GROUP_KEYS,
    HEADERS,
    MEASURES,
    PREDICTION_KEYS,
    RAW,
    RAW_COLUMNS,
    SILVER,
    TEXT_BRONZE,
    failure_columns,
    with_labels,
)
from wearline.session import as_ts, pin, scratch
from wearline.sources.driver_tables import (
    FIRST_DAY,
    FIRST_YEAR,
    LINE_KEY,
    MACHINE_KEY,
    day_ts,
    line_log,
    line_versions,
    machine_log,
    machine_versions,
    sensors,
    table,
    valid_sensors,
)
from wearline.sources.files import append_bronze, read_bronze, read_raw, replace
from wearline.sources.tables import VersionedTable, bucketed
from wearline.streaming import ingest

HALF = 15
DAY1, DAY2 = "2026-04-02 08:00:00", "2026-04-03 08:00:00"
FEATURE_COLUMNS = [
    "udi",
    *GROUP_KEYS,
    "event_hour",
    *MEASURES,
    "machine_failure",
    *[f"{f}_label" for f in FAILURES],
]
AVERAGES = [f"avg_{m}" for m in MEASURES]


def rounded(df: DataFrame, columns: list[str] = AVERAGES) -> DataFrame:
    """Averages at six places: their last digits depend on the order of summation."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_labels(valid_sensors(spark, sf_dir)).select(*FEATURE_COLUMNS)


def early(df: DataFrame) -> DataFrame:
    return df.filter(F.col("batch_no") < HALF)


def late(df: DataFrame) -> DataFrame:
    return df.filter(F.col("batch_no") >= HALF)


# -- files, Bronze, streams --------------------------------------------------------


def land_csv(df: DataFrame, path: str, extra: tuple[str, ...] = (), sep: str = ",") -> None:
    """Write rows as raw files with the raw header."""
    headers = [F.col(name).alias(header) for header, name in HEADERS.items()]
    df.select(*headers, *extra).write.mode("append").options(header=True, sep=sep).csv(path)


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "raw")
    land_csv(sensors(spark, sf_dir), path)
    return read_raw(spark, path, as_ts(DAY1)).select(*RAW_COLUMNS)


def raw_scan_sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "raw")
    land_csv(sensors(spark, sf_dir), path, sep=";")
    return read_raw(spark, path, as_ts(DAY1), sep=None).select(*RAW_COLUMNS)


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, bronze = scratch(spark, "landing"), scratch(spark, "bronze")
    land_csv(sensors(spark, sf_dir), landing)
    for day in (DAY1, DAY2):
        append_bronze(read_raw(spark, landing, as_ts(day)), bronze)
    return (
        read_bronze(spark, bronze)
        .groupBy("ingestion_date")
        .agg(
            F.count("udi").alias("n_rows"),
            F.count("source_file").alias("n_sources"),
            F.sum(F.col("tool_wear_min").cast("bigint")).alias("sum_wear"),
        )
    )


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that land in two portions, drained by three starts of one stream."""
    landing, bronze, state = (scratch(spark, n) for n in ("landing", "bronze", "checkpoint"))
    rows = sensors(spark, sf_dir)
    for portion in (early(rows), late(rows), None):
        if portion is not None:
            land_csv(portion, landing)
        ingest.drain_to_bronze(ingest.stream_files(spark, landing), bronze, state)
    text = read_bronze(spark, bronze, schema=None)
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW])


def land_mixed_up(df: DataFrame, path: str, extra: str | None = None) -> None:
    """Raw files whose columns come in another order, ``extra`` in the middle of them."""
    headers = [F.col(name).alias(header) for header, name in HEADERS.items()][::-1]
    if extra is not None:
        headers.insert(len(headers) // 2, F.col(extra))
    df.select(*headers).write.mode("append").options(header=True).csv(path)


def stream_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their columns in other orders, and a column that only later files have."""
    landing, bronze, state = (scratch(spark, n) for n in ("landing", "bronze", "checkpoint"))
    kept = scratch(spark, "schema")
    rows = sensors(spark, sf_dir)
    for portion, extra in ((early(rows), None), (late(rows), "batch_no")):
        land_mixed_up(portion, landing, extra)
        ingest.drain_to_bronze(ingest.stream_files(spark, landing), bronze, state, kept=kept)
    merged = read_bronze(spark, bronze, merge=True)
    return merged.groupBy(F.col("batch_no").cast("int").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("udi").cast("bigint")).alias("sum_udi")
    )


def bronze_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Bronze filled by a stream, a batch load and the stream again."""
    lake = Lakehouse(spark, Config(scratch(spark, "lake"), TEXT_BRONZE, cluster=False))
    landing, state = scratch(spark, "landing"), scratch(spark, "checkpoint")
    rows = sensors(spark, sf_dir)
    third = F.col("batch_no") % 3
    land_csv(rows.filter(third == 0), landing)
    lake.ingest_stream(landing, state, DAY1)
    files = scratch(spark, "files")
    land_csv(rows.filter(third == 1), files)
    lake.ingest(files, DAY1)
    land_mixed_up(rows.filter(third == 2), landing)
    lake.ingest_stream(landing, state, DAY1)
    bronze = read_bronze(spark, lake.bronze, TEXT_BRONZE)
    return bronze.groupBy(F.col("ingest_no").cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("udi").cast("bigint")).alias("sum_udi"),
        F.sum(F.col("tool_wear_min").cast("bigint")).alias("sum_wear"),
    )


def flow_late_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after two ingests at one time and one dated the day before."""
    lake = Lakehouse(spark, Config(scratch(spark, "lake"), cluster=False))
    for third, day in enumerate((DAY2, DAY2, DAY1)):
        landing = scratch(spark, "landing")
        land_csv(sensors(spark, sf_dir).filter(F.col("batch_no") % 3 == third), landing)
        lake.ingest(landing, day)
        lake.to_silver(day)
    return lake.silver.read().select(*RAW_COLUMNS)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches merged into a Silver table keyed by machine."""
    landing, state = scratch(spark, "landing"), scratch(spark, "checkpoint")
    silver = VersionedTable(spark, scratch(spark, "silver"), SILVER, MACHINE_KEY)
    rows = by_machine(sensors(spark, sf_dir))
    run_ts = as_ts(DAY1)

    def prepare(batch: DataFrame) -> DataFrame:
        number = F.col("reading").cast("int")
        return ingest.newest_silver(batch.withColumn("reading", number), run_ts, ["reading"])

    for portion in (early(rows), late(rows)):
        land_csv(portion, landing, ("reading",))
        stream = ingest.stream_files(spark, landing)
        ingest.drain_to_table(stream, silver, prepare, run_ts, state, "silver")
    return silver.read().select(*RAW_COLUMNS)


def by_machine(df: DataFrame) -> DataFrame:
    """Sensor rows with the machine number as ``udi``; the event number is ``reading``."""
    machine = F.substring("product_id", 2, 20).cast("int")
    return df.withColumn("reading", F.col("udi")).withColumn("udi", machine)


def truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "plain")
    replace(with_labels(sensors(spark, sf_dir)).select(*FEATURE_COLUMNS), path)
    replace(features(spark, sf_dir), path)
    return spark.read.parquet(path)


# -- projection and quality gate ---------------------------------------------------


def loaded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table reloaded from raw files; the second load replaces the first."""
    lake, path = Lakehouse(spark, Config(scratch(spark, "lake"))), scratch(spark, "plain")
    for rows in (early(sensors(spark, sf_dir)), sensors(spark, sf_dir)):
        landing = scratch(spark, "landing")
        land_csv(rows, landing)
        lake.load_features(landing, path, DAY1)
    return spark.read.parquet(path)


def silver_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensors(spark, sf_dir).select(
        *RAW_COLUMNS, F.lit(DAY1).alias("ingestion_ts"), F.lit("events").alias("source_file"), "log_ts"
    )
    valid, _ = split_valid(rows)
    return with_event_time(valid).select(
        *RAW_COLUMNS,
        F.col("ingestion_ts").cast("timestamp_ntz").alias("ingestion_ts"),
        "source_file",
        F.col("log_ts").cast("timestamp_ntz").alias("log_ts"),
        "event_date",
        "event_hour",
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(sensors(spark, sf_dir), schema=RAW, ignore_null_fields=False)[1]


def as_text(df: DataFrame) -> DataFrame:
    """Raw columns as text, with some unreadable torque and wear values."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS], "log_ts")
    number = F.col("udi").cast("int")
    return text.withColumns(
        {
            "torque_nm": F.when(number % 229 == 0, "n/a").otherwise(F.col("torque_nm")),
            "tool_wear_min": F.when(number % 233 == 0, "12;5").otherwise(F.col("tool_wear_min")),
        }
    )


def quarantine_bad_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = as_text(sensors(spark, sf_dir))
    return split_valid(text, schema=RAW, ignore_null_fields=False)[1]


def valid_after_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(as_text(sensors(spark, sf_dir)), schema=RAW)[0]


def audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_audit(sensors(spark, sf_dir))


def audit_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_audit(valid_sensors(spark, sf_dir))


def audit_no_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_audit(sensors(spark, sf_dir).filter(F.col("machine_type") == "X"))


def enforce_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_sensors(spark, sf_dir).select(*RAW_COLUMNS)
    return enforce(rows.filter(violation(QUALITY_RULES).isNull()))


# -- Gold --------------------------------------------------------------------------


def daily_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.daily(features(spark, sf_dir)))


def predicted(rows: DataFrame, ts: Column | None = None) -> DataFrame:
    stamp = F.lit(DAY1).cast("timestamp_ntz") if ts is None else ts
    return gold.rule_predictions(rows, stamp)


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(sensors(spark, sf_dir)).drop("prediction_ts", "_pred_loaded_ts")


def rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predicted(sensors(spark, sf_dir))
    return rows.agg(
        *[F.sum(F.col(c).cast("bigint")).alias(c) for c in audit.PREDICTED],
        F.count_if(audit.any_failure()).alias("any_failure"),
    )


def machine_feed(spark: SparkSession, sf_dir: str, low: int, high: int | None = None) -> DataFrame:
    """The machine log's versions above ``low``, up to ``high`` if it is given."""
    log = machine_log(spark, sf_dir)
    return changes.changes(log, low + 1) if high is None else changes.changes_between(log, low, high)


def machine_features(spark: SparkSession, sf_dir: str, low: int, high: int | None = None) -> DataFrame:
    """Feature rows from the machine log's versions above ``low``."""
    feed = machine_feed(spark, sf_dir, low, high)
    return gold.feature_rows(feed, as_ts(DAY1)).select(*FEATURE_COLUMNS)


def features_of_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine_features(spark, sf_dir, -1)


def affected_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = machine_feed(spark, sf_dir, HALF - 1)
    return gold.affected_groups(feed, "recompute")


def _refreshed(spark: SparkSession, sf_dir: str, stale: str) -> DataFrame:
    """Daily aggregates of the early versions, then refreshed by the late ones."""
    log = pin(machine_log(spark, sf_dir), "log")
    feed = changes.changes(log, HALF)
    before = gold.feature_rows(changes.changes_between(log, -1, HALF - 1), as_ts(DAY1)).select(*FEATURE_COLUMNS)
    newer = gold.feature_rows(feed, as_ts(DAY1)).select(*FEATURE_COLUMNS)
    after = upsert(before, newer, ["udi"], assume_unique=True, null_keys=False)
    groups = pin(gold.affected_groups(feed, stale), "groups")
    fresh = pin(gold.refresh_groups(after, groups), "refreshed")
    state = gold.daily(before)
    if stale == "recompute":
        gone = gold.emptied_groups(groups, fresh)
        state = state.join(gone, GROUP_KEYS, "left_anti")
    return rounded(upsert(state, fresh, GROUP_KEYS, assume_unique=True, null_keys=False))


def daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "keep")


def daily_recompute_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "recompute")


def daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table from a state that took up the early versions, then the late ones as signed
    changes; rows move between groups with every version."""
    log = pin(with_labels(machine_log(spark, sf_dir)), "log")
    early_rows, late_rows = changes.changes_between(log, -1, HALF - 1), changes.changes(log, HALF)
    state = pin(gold.daily_changes(early_rows), "state")
    delta = pin(gold.daily_changes(late_rows), "delta")
    merged = gold.merged_state(state, delta)
    kept = state.join(delta, GROUP_KEYS, "left_anti")
    return rounded(gold.daily_of(kept.unionByName(merged)))


def changed_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = machine_log(spark, sf_dir)
    last = machine_versions(spark, sf_dir).agg(F.max("batch_no")).scalar()
    feed = log.filter(F.col(changes.VERSION) > last - 2)
    rows = by_machine(valid_sensors(spark, sf_dir))
    return gold.of_changed_keys(with_labels(rows), changes.new_images(feed), ["udi"]).select(
        "reading", *FEATURE_COLUMNS
    )


def changed_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value of the lines whose order is open."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    keys = orders.select(F.col("o_orderkey").alias("orderkey"))
    kept = gold.of_changed_keys(
        lines.select("orderkey", "l_returnflag", "l_quantity"), keys, ["orderkey"]
    )
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")
    )


# -- serving -----------------------------------------------------------------------

PICK = {"product": "P7", "machine_type": "L"}


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.health(features(spark, sf_dir)), ["avg_tool_wear"])


def health_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.health(features(spark, sf_dir), **PICK), ["avg_tool_wear"])


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = serving.risk(serving.health(features(spark, sf_dir), serving.ALL, "H"))
    return rounded(row, ["avg_tool_wear", "risk_score"])


def heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ordered_heat(serving.heat(features(spark, sf_dir)))


def heat_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ordered_heat(serving.heat(features(spark, sf_dir), machine_type="M"))


def heat_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.binned(serving.heat(features(spark, sf_dir)))


def heat_first_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.first_rows(
        serving.heat(features(spark, sf_dir)), ["air_temperature_k", "torque_nm"]
    )


def failure_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.failure_distribution(features(spark, sf_dir))


def failure_distribution_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.failure_distribution(valid_sensors(spark, sf_dir), **PICK)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.summary(features(spark, sf_dir))


def summary_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.summary(features(spark, sf_dir), **PICK)


def filter_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.filter_options(sensors(spark, sf_dir), "product_id")


def filter_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.filter_options(sensors(spark, sf_dir), "machine_type")


def top_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    best = serving.top_match(
        orders,
        ("o_orderstatus", "p"),
        [("o_orderpriority", "1-urgent"), ("o_orderpriority", "2-high")],
        ["o_orderdate", "o_orderkey"],
    )
    key = F.col("o_orderkey").cast("string")
    return best.select(F.concat("o_orderstatus", F.lit("."), key).alias("full_name"), "o_orderkey")


# -- upserts -----------------------------------------------------------------------


def newest_per_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine_versions(spark, sf_dir)


def newest_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, ["l_shipdate"], null_keys=False)


def upsert_1key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = machine_versions(spark, sf_dir)
    target, source = (
        latest_per_key(part, MACHINE_KEY, ["batch_no"], null_keys=False) for part in (early(rows), late(rows))
    )
    return upsert(target, source, MACHINE_KEY, null_keys=False)


def upsert_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_versions(spark, sf_dir)
    new = F.col("version") >= 4
    target, source = (
        latest_per_key(rows.filter(part), LINE_KEY, ["version"], null_keys=False) for part in (~new, new)
    )
    return upsert(target, source, LINE_KEY, null_keys=False)


def upsert_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the late rows merged into those of the early rows."""
    rows = machine_versions(spark, sf_dir)
    target, source = (
        predicted(latest_per_key(part, MACHINE_KEY, ["batch_no"], null_keys=False)).drop(
            "prediction_ts", "_pred_loaded_ts"
        )
        for part in (early(rows), late(rows))
    )
    return upsert(target, source, PREDICTION_KEYS, null_keys=False)


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the late years merged into a table that is bucketed and sorted by their key: the
    large source is dealt out to the buckets, the target stays where it is."""
    rows = line_versions(spark, sf_dir)
    new = F.col("version") >= 4
    target, source = (
        latest_per_key(rows.filter(part), LINE_KEY, ["version"], null_keys=False) for part in (~new, new)
    )
    target = bucketed(target, scratch(spark, "bucketed"), LINE_KEY, 16)
    return upsert(target, pin(source, "source"), LINE_KEY, null_keys=False)


def insert_absent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_versions(spark, sf_dir)
    target = rows.filter(F.col("version") == 0)
    source = latest_per_key(
        rows.filter(F.col("version") > 0), LINE_KEY, ["version"], null_keys=False
    )
    return insert_absent(target, source, LINE_KEY, null_keys=False)


def touch_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects seen again get a new time and nothing else."""
    bad = sensors(spark, sf_dir).filter(~F.expr("product_id IS NOT NULL AND machine_type IS NOT NULL"))
    payload = F.to_json(F.struct("product_id", "machine_type"), {"ignoreNullFields": "false"})

    def rejects(part: DataFrame, note: str, day: str) -> DataFrame:
        reason, seen = F.lit("missing").alias("error_reason"), F.lit(day).cast("timestamp_ntz")
        once = part.select(payload.alias("raw_payload"), reason).distinct()
        return once.withColumns({"note": F.lit(note), "_quarantine_ts": seen})

    target = rejects(bad.filter("batch_no < 20"), "first", DAY1)
    source = rejects(bad.filter("batch_no >= 10"), "second", DAY2)
    return upsert(target, source, ["raw_payload", "error_reason"], ["_quarantine_ts"])


def advance_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = as_ts(DAY1)
    control = first_mark(spark, GOLD_FLOW, ts).unionByName(first_mark(spark, "other", ts))
    moved = advance_mark(control, GOLD_FLOW, machine_log(spark, sf_dir), as_ts(DAY2))
    return moved.drop("last_run_ts")


# -- change feed and past versions -------------------------------------------------

FEED = [*changes.META, "udi", "reading", "product_id", "machine_type", *MEASURES, "event_date"]


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine_log(spark, sf_dir).select(*FEED)


def changes_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changes(machine_log(spark, sf_dir), 20).select(*FEED)


def changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changes_between(machine_log(spark, sf_dir), 5, 20).select(*FEED)


def changes_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flow has left to do once it has processed the early versions."""
    log = machine_log(spark, sf_dir)
    done = changes.changes_between(log, -1, HALF - 1)
    control = advance_mark(first_mark(spark, GOLD_FLOW, as_ts(DAY1)), GOLD_FLOW, done, as_ts(DAY2))
    return changes_above_mark(log, control, GOLD_FLOW).select(*FEED)


def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.as_of_version(machine_log(spark, sf_dir), MACHINE_KEY, 9, null_keys=False)


def as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return changes.as_of_timestamp(machine_log(spark, sf_dir), MACHINE_KEY, moment, null_keys=False)


def failed_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of_version(spark, sf_dir).filter(F.col("machine_failure") == 1)


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of the rule predictions made for every machine version."""
    rows = machine_versions(spark, sf_dir)
    made = gold.rule_predictions(rows, day_ts("batch_no"), also=["batch_no"])
    return changes.log_of_versions(
        made.drop("_pred_loaded_ts"), PREDICTION_KEYS, "batch_no", day_ts("batch_no"), null_keys=False
    )


def failures_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
    state = changes.as_of_timestamp(prediction_log(spark, sf_dir), PREDICTION_KEYS, moment, null_keys=False)
    return state.filter(audit.any_failure())


def state_before_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machines as they stood when the baseline first flagged a speed failure."""
    made = changes.new_images(prediction_log(spark, sf_dir)).filter(F.col("pred_osf") == 1)
    return audit.state_before_first_failure(
        machine_log(spark, sf_dir), MACHINE_KEY, made, null_keys=False
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.history(machine_log(spark, sf_dir))


def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.history(line_log(spark, sf_dir))


def line_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("version", F.year("l_shipdate") - FIRST_YEAR)
    return changes.state_of_versions(rows, LINE_KEY, "version", 4, ["l_shipdate"], null_keys=False)


def committed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed of the lines' yearly versions, as it would be committed."""
    return line_log(spark, sf_dir)


def committed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.as_of_version(line_log(spark, sf_dir), LINE_KEY, 5, null_keys=False)


def committed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = changes.history(line_log(spark, sf_dir))
    return commits.select(changes.VERSION, "rows_inserted", "rows_updated", "rows_deleted")


# -- audit -------------------------------------------------------------------------


def silver_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.change_history(machine_log(spark, sf_dir), audit.SILVER_HISTORY)


def prediction_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.change_history(prediction_log(spark, sf_dir), audit.PREDICTION_HISTORY)


def audit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = audit.audit_pairs(machine_log(spark, sf_dir), prediction_log(spark, sf_dir))
    return audit.newest_first(pairs)


# -- learned models ----------------------------------------------------------------


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = learn.stratified_split(features(spark, sf_dir), "machine_failure", "udi")
    named = [
        rows.select("udi", "machine_failure", F.lit(name).alias("part"))
        for rows, name in ((train, "train"), (test, "test"))
    ]
    return named[0].unionByName(named[1])


def split_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stratum before and after a split, with keys and strata missing."""
    rows = sensors(spark, sf_dir).withColumn("udi", F.expr("IF(udi % 13 = 0, NULL, udi)"))
    parts = learn.stratified_split(rows, "machine_type", "udi")
    count = F.count(F.lit(1))
    after = parts[0].unionByName(parts[1]).groupBy("machine_type").agg(count.alias("n_after"))
    before = rows.groupBy(F.col("machine_type").alias("_type")).agg(count.alias("n_before"))
    joined = before.join(after, F.col("_type").eqNullSafe(F.col("machine_type")))
    return joined.select(F.col("_type").alias("machine_type"), "n_before", "n_after")


def audit_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.current_predictions(machine_log(spark, sf_dir), prediction_log(spark, sf_dir))


def audit_current_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current predictions where one machine has a third of all commits: every reading is a Silver
    commit of its own, and a prediction for every second one is committed half a second later."""
    rows = valid_sensors(spark, sf_dir).withColumn("reading", F.col("udi")).withColumns(
        {
            "udi": F.expr("IF(reading % 3 = 0, 0, CAST(substr(product_id, 2) AS INT))"),
            "product_id": F.expr("IF(reading % 3 = 0, 'P0', product_id)"),
        }
    )

    def committed(part: DataFrame, shift: str) -> DataFrame:
        ts = F.expr(f"TIMESTAMP_NTZ '{FIRST_DAY} 00:00:00' + make_dt_interval(0, 0, 0, reading) {shift}")
        version = F.col("reading").cast("bigint")
        return part.withColumns({changes.CHANGE: F.lit(changes.INSERT), changes.VERSION: version, changes.COMMIT_TS: ts})

    made = gold.rule_predictions(rows, F.lit(DAY1).cast("timestamp_ntz"), also=["reading"])
    made = committed(made.filter("reading % 2 = 0"), "+ INTERVAL '0.5' SECOND")
    return audit.current_predictions(committed(rows, ""), made, seconds=600)


def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir)
    labels = failure_columns(rows)
    made = gold.rule_predictions(rows, as_ts(DAY1), also=list(labels.values()))
    pairs = {name: (column, f"pred_{name}") for name, column in labels.items()}
    return rounded(learn.f1_scores(made, pairs), ["f1"])


# The given flags follow no measure, so the trees of the queries are taught those of the rules,
# which they can learn. One fit serves all queries of a session over one directory.
_MODELS: dict[tuple[str, str], str] = {}


def taught(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows labelled by the rules, a seventeenth of the torques missing."""
    rows = features(spark, sf_dir)
    labelled = rows.withColumns(dict(zip(learn.LABELS, flags(FAILURE_RULES))))
    return labelled.withColumn("torque_nm", F.expr("IF(udi % 17 = 0, NULL, torque_nm)"))


def _model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The five models at full size, from all train rows of ``taught``, saved and loaded."""
    place = spark.sparkContext.applicationId, sf_dir
    if place not in _MODELS:
        train, _ = learn.stratified_split(taught(spark, sf_dir), "machine_failure", "udi")
        path = scratch(spark, "model")
        learn.save(learn.fit(train), path)
        _MODELS[place] = path
    return learn.load(_MODELS[place])


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every feature row's prediction, missing measures or not: that flags are 0
    or 1 and agree with the score. Whether the models have learned is for ``model_f1`` to say."""
    made = learn.score(_model(spark, sf_dir), taught(spark, sf_dir), as_ts(DAY1))
    score, classes = F.col("prediction_score"), [F.col(c) for c in audit.PREDICTED]
    fits = F.when(F.greatest(*classes) == 1, score >= 0.5).otherwise(score <= 0.5)
    return made.select(
        "udi",
        "product_id",
        F.forall(F.array(*classes), lambda c: c.isin(0, 1)).alias("flags_ok"),
        score.between(0, 1).alias("score_ok"),
        fits.alias("agrees"),
        "model_name",
        "model_version",
    )


def model_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 of the held-out rows per label; a label with few positives has none to speak of, and
    that of the machine type's rule cannot be high, as the trees see measures only."""
    _, test = learn.stratified_split(taught(spark, sf_dir), "machine_failure", "udi")
    found = learn.evaluate(_model(spark, sf_dir), test)
    seen = test.agg(*[F.sum(label).alias(label.removesuffix("_label")) for label in learn.LABELS])
    positives = seen.select(F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("n")) for c in FAILURES])))
    joined = found.join(positives, F.col("target") == F.col("label"))
    return joined.select("target", ((F.col("f1") >= 0.5) | (F.col("n") < 30)).alias("learned"))


def model_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model and of its copy after saving and loading, row by row."""
    rows, model, path = taught(spark, sf_dir), _model(spark, sf_dir), scratch(spark, "copy")
    learn.save(model, path)
    made = [learn.score(m, rows, as_ts(DAY1)) for m in (model, learn.load(path))]
    pairs = made[0].alias("a").join(made[1].alias("b"), "udi")
    same = F.col("a.prediction_score").eqNullSafe(F.col("b.prediction_score"))
    return pairs.select("udi", same.alias("same"))


def model_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned scores beside the baseline in one table, counted per model."""
    rows = features(spark, sf_dir)
    ts = as_ts(DAY1)
    scored = learn.score(_model(spark, sf_dir), rows, ts)
    rules = gold.rule_predictions(rows, ts)
    both = upsert(rules, scored, PREDICTION_KEYS, assume_unique=True, null_keys=False)
    return both.groupBy("model_name", "model_version").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("udi").alias("n_machines"),
        F.count_if(~F.col("prediction_score").between(0, 1)).alias("bad_scores"),
    )


# -- layout and whole flow ---------------------------------------------------------


def layout_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "clustered")
    rows = valid_sensors(spark, sf_dir).select(*RAW_COLUMNS, "log_ts")
    clustered(rows, ["product_id", "log_ts"], files=8).write.parquet(path)
    return spark.read.parquet(path)


def layout_skips_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a product and a day are found in a few of the files of a clustered table."""
    path = scratch(spark, "clustered")
    rows = valid_sensors(spark, sf_dir).select("product_id", "log_ts")
    clustered(rows, ["product_id", "log_ts"], files=8).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    one = stored.agg(F.min_by("product_id", "log_ts").alias("p"), F.to_date(F.min("log_ts")).alias("d"))
    day = F.to_date("log_ts") == one.select("d").scalar()
    found = stored.filter((F.col("product_id") == one.select("p").scalar()) & day)
    return found.agg(
        (F.count(F.lit(1)) > 0).alias("found"), (F.count_distinct("file") <= 2).alias("in_few_files")
    )


GRID = 36


def layout_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a product alone, a day alone and both are found by the value ranges of the files, which
    are what a reader skips by: a third of them at most, and a few."""
    path = scratch(spark, "grid")
    rows = valid_sensors(spark, sf_dir).select("product_id", "log_ts")
    gridded(rows, ["product_id", "log_ts"], files=GRID).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    one = stored.agg(F.min_by("product_id", "log_ts").alias("p"), F.date_trunc("day", F.min("log_ts")).alias("d"))
    ranges = stored.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("product_id", "log_ts") for name, f in (("lo", F.min), ("hi", F.max))],
    )
    p, d = one.select("p").scalar(), one.select(F.col("d").cast("timestamp_ntz")).scalar()
    product = p.between(F.col("lo_product_id"), F.col("hi_product_id"))
    day = (F.col("lo_log_ts") < d + F.expr("INTERVAL 1 DAY")) & (F.col("hi_log_ts") >= d)
    many = F.count(F.lit(1))
    return ranges.agg(
        F.sum("n").alias("n_rows"),
        (F.count_if(product) <= many / 3).alias("product_in_a_third"),
        (F.count_if(day) <= many / 3).alias("day_in_a_third"),
        F.count_if(product & day).between(1, 4).alias("both_in_few"),
        (F.max("n") <= 3 * F.avg("n")).alias("even"),
    )


def layout_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a table before and after its small files were packed."""
    before, after = scratch(spark, "small"), scratch(spark, "packed")
    rows = valid_sensors(spark, sf_dir).select("product_id", "log_ts", "udi")
    rows.repartition(40, "udi").write.parquet(before)
    gridded(spark.read.parquet(before), ["product_id", "log_ts"], files=4).write.parquet(after)
    sides = [
        spark.read.parquet(path).select(F.lit(name).alias("state"), "udi", F.col("_metadata.file_name").alias("file"))
        for name, path in (("before", before), ("after", after))
    ]
    found = sides[0].unionByName(sides[1]).groupBy("state")
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("udi").cast("bigint")).alias("sum_udi"),
        (F.count_distinct("file") <= 5).alias("few_files"),
    )


def _flow(
    spark: SparkSession, sf_dir: str, stale: str = "keep", cluster: bool = False
) -> Lakehouse:
    """Two runs over the readings by machine: the early ones, then the late ones."""
    # Clustered copies are made of snapshots, so these are made at once.
    every = 1 if cluster else 64
    lake = Lakehouse(spark, Config(scratch(spark, "lake"), stale=stale, cluster=cluster, snapshot_every=every))
    rows = by_machine(sensors(spark, sf_dir))
    for portion, day in ((early(rows), DAY1), (late(rows), DAY2)):
        landing = scratch(spark, "landing")
        land_csv(portion, landing)
        lake.run(landing, as_ts(day))
    return lake


def flow_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_flow(spark, sf_dir).daily.read()).drop("_gold_agg_loaded_ts")


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table behind a stream of Silver commits: two drains of one checkpoint, each after a
    Silver commit, and a third from the first commit on, which finds nothing left to do."""
    lake = Lakehouse(spark, Config(scratch(spark, "lake"), cluster=False))
    rows, state = by_machine(sensors(spark, sf_dir)), scratch(spark, "checkpoint")
    for portion, day in ((early(rows), DAY1), (late(rows), DAY2)):
        landing = scratch(spark, "landing")
        land_csv(portion, landing)
        lake.ingest(landing, as_ts(day))
        lake.to_silver(as_ts(day))
        lake.stream_gold(state, as_ts(day))
    lake.stream_gold(scratch(spark, "checkpoint"), as_ts(DAY2))
    return rounded(lake.daily.read()).drop("_gold_agg_loaded_ts")


def flow_daily_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_flow(spark, sf_dir, "recompute").daily.read()).drop("_gold_agg_loaded_ts")


def flow_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _flow(spark, sf_dir)
    pairs = audit.audit_pairs(lake.silver.changes(), lake.predictions.changes())
    return pairs.drop("silver_commit_ts", "gold_commit_ts")


def flow_audit_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each Silver image of both runs with the prediction that was current for it."""
    lake = _flow(spark, sf_dir)
    found = audit.current_predictions(lake.silver.changes(), lake.predictions.changes())
    return found.drop("silver_commit_ts", "gold_commit_ts")


def flow_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features read from their clustered copy."""
    rows = _flow(spark, sf_dir, cluster=True).read_clustered("features")
    return rows.drop("_gold_loaded_ts", "event_hour")


def flow_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of both runs beside the size of the quarantine."""
    lake = _flow(spark, sf_dir)
    rejected = lake.quarantine.read().agg(F.count(F.lit(1)).alias("n"))
    audits = lake.quality_audit().withColumn("audit_ts", F.col("audit_ts").cast("timestamp_ntz"))
    return audits.withColumn("quarantined", rejected.scalar())


QUERIES = {
    "q_raw_scan": raw_scan,
    "q_raw_scan_sniffed": raw_scan_sniffed,
    "q_bronze_append": bronze_append,
    "q_stream_bronze": stream_bronze,
    "q_stream_evolved": stream_evolved,
    "q_bronze_mixed": bronze_mixed,
    "q_flow_late_ingest": flow_late_ingest,
    "q_stream_upsert": stream_upsert,
    "q_truncate_reload": truncate_reload,
    "q_loaded_features": loaded_features,
    "q_silver_projection": silver_projection,
    "q_quarantine": quarantine,
    "q_quarantine_bad_cast": quarantine_bad_cast,
    "q_valid_after_casts": valid_after_casts,
    "q_quality_audit": audit_all,
    "q_quality_audit_valid": audit_valid,
    "q_quality_audit_empty": audit_no_rows,
    "q_enforce_pass": enforce_pass,
    "q_daily_agg": daily_agg,
    "q_rule_predictions": rule_predictions,
    "q_rule_totals": rule_totals,
    "q_features_of_feed": features_of_feed,
    "q_affected_groups": affected_groups,
    "q_daily_incremental": daily_incremental,
    "q_daily_recompute_moved": daily_recompute_moved,
    "q_daily_state": daily_state,
    "q_changed_machines": changed_machines,
    "q_changed_order_lines": changed_order_lines,
    "q_health": health,
    "q_health_filtered": health_filtered,
    "q_risk": risk,
    "q_heat": heat,
    "q_heat_filtered": heat_filtered,
    "q_heat_binned": heat_binned,
    "q_heat_first_1000": heat_first_1000,
    "q_failure_distribution": failure_distribution,
    "q_failure_distribution_filtered": failure_distribution_filtered,
    "q_summary": summary,
    "q_summary_filtered": summary_filtered,
    "q_filter_products": filter_products,
    "q_filter_types": filter_types,
    "q_top_match": top_match,
    "q_latest_per_key": newest_per_machine,
    "q_latest_per_line": newest_per_line,
    "q_upsert_1key": upsert_1key,
    "q_upsert_2key": upsert_2key,
    "q_upsert_3key": upsert_3key,
    "q_upsert_bucketed": upsert_bucketed,
    "q_insert_absent": insert_absent_lines,
    "q_touch_quarantine": touch_quarantine,
    "q_advance_mark": advance_marks,
    "q_change_feed": change_feed,
    "q_changes_from": changes_from,
    "q_changes_between": changes_between,
    "q_changes_above_mark": changes_above,
    "q_as_of_version": as_of_version,
    "q_as_of_timestamp": as_of_timestamp,
    "q_failed_as_of_version": failed_as_of_version,
    "q_failures_as_of": failures_as_of,
    "q_state_before_first_failure": state_before_first_failure,
    "q_history": history,
    "q_line_history": line_history,
    "q_line_as_of": line_as_of,
    "q_committed_feed": committed_feed,
    "q_committed_state": committed_state,
    "q_committed_history": committed_history,
    "q_silver_history": silver_history,
    "q_prediction_history": prediction_history,
    "q_audit_join": audit_join,
    "q_audit_current": audit_current,
    "q_audit_current_hot": audit_current_hot,
    "q_split_stratified": split_stratified,
    "q_split_missing": split_missing,
    "q_f1": f1,
    "q_gbt_scores": gbt_scores,
    "q_model_upsert": model_upsert,
    "q_model_f1": model_f1,
    "q_model_reloaded": model_reloaded,
    "q_layout_same_rows": layout_same_rows,
    "q_layout_skips_files": layout_skips_files,
    "q_layout_grid": layout_grid,
    "q_layout_files": layout_files,
    "q_flow_daily": flow_daily,
    "q_flow_daily_moved": flow_daily_moved,
    "q_stream_gold": stream_gold,
    "q_flow_audit": flow_audit,
    "q_flow_audit_current": flow_audit_current,
    "q_flow_clustered": flow_clustered,
    "q_flow_quality": flow_quality,
}
