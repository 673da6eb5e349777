"""Sensor-shaped views over the given ``events``, ``lineitem`` and ``orders`` tables.

The column texts are plain SQL and are used for the check queries too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.changes import log_of_versions
from wearline.operators.upsert import latest_per_key

SENSOR_COLUMNS = {
    "udi": "CAST(event_id AS INT)",
    "product_id": "CASE WHEN event_id % 97 = 0 THEN NULL "
    "ELSE concat('P', CAST(user_id AS STRING)) END",
    "machine_type": "CASE WHEN event_type IN ('click','view') THEN 'L' "
    "WHEN event_type = 'purchase' THEN 'M' WHEN event_type = 'signup' THEN 'H' "
    "WHEN event_id % 10 = 0 THEN NULL ELSE 'L' END",
    "air_temperature_k": "CASE WHEN event_id % 211 = 0 THEN CAST(400 AS DOUBLE) "
    "ELSE CAST(295 AS DOUBLE) + CAST(event_id % 96 AS DOUBLE) / CAST(10 AS DOUBLE) END",
    "process_temperature_k": "CASE WHEN event_id % 223 = 0 THEN CAST(200 AS DOUBLE) "
    "ELSE CAST(303 AS DOUBLE) + CAST(event_id % 137 AS DOUBLE) / CAST(10 AS DOUBLE) END",
    "rotational_speed_rpm": "CAST(CASE WHEN event_id % 227 = 0 THEN 0 "
    "ELSE 1168 + (event_id * 7) % 1719 END AS INT)",
    "torque_nm": "CASE WHEN event_id % 229 = 0 THEN CAST(-1 AS DOUBLE) "
    "WHEN value <= CAST(80 AS DOUBLE) THEN value ELSE value / CAST(10 AS DOUBLE) END",
    "tool_wear_min": "CAST(CASE WHEN event_id % 233 = 0 THEN -5 "
    "ELSE (event_id * 3) % 254 END AS INT)",
    "machine_failure": "CASE WHEN event_id % 217 = 0 OR event_id % 87 = 0 OR event_id % 105 = 0 "
    "OR event_id % 102 = 0 OR event_id % 526 = 0 THEN 1 ELSE 0 END",
    "twf": "CASE WHEN event_id % 217 = 0 THEN 1 ELSE 0 END",
    "hdf": "CASE WHEN event_id % 87 = 0 THEN 1 ELSE 0 END",
    "pwf": "CASE WHEN event_id % 105 = 0 THEN 1 ELSE 0 END",
    "osf": "CASE WHEN event_id % 102 = 0 THEN 1 ELSE 0 END",
    "rnf": "CASE WHEN event_id % 526 = 0 THEN 1 ELSE 0 END",
    "log_ts": "ts",
    "event_date": "CAST(ts AS DATE)",
    "event_hour": "CAST(extract(hour FROM ts) AS INT)",
    "batch_no": "CAST(extract(day FROM ts) AS INT) - 1",
}
VALID = "product_id IS NOT NULL AND machine_type IS NOT NULL AND log_ts IS NOT NULL"
MACHINE_KEY = ["udi"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
FIRST_DAY, FIRST_YEAR = "2024-01-01", 1995


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sensor row per event, with missing and impossible values."""
    exprs = [f"{sql} AS {name}" for name, sql in SENSOR_COLUMNS.items()]
    return table(spark, sf_dir, "events").selectExpr(*exprs)


def valid_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors(spark, sf_dir).filter(VALID)


def machine_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows at machine grain: ``udi`` is the machine, one row per machine and day."""
    rows = valid_sensors(spark, sf_dir).withColumn("reading", F.col("udi"))
    machine = F.substring("product_id", 2, 20).cast("int")
    return latest_per_key(
        rows.withColumn("udi", machine),
        ["udi", "batch_no"],
        ["log_ts", "reading"],
        null_keys=False,
        ties=False,
    )


def day_ts(version: str) -> F.Column:
    """Commit time of a daily version: the start of its day."""
    return F.expr(f"TIMESTAMP_NTZ '{FIRST_DAY} 00:00:00' + make_dt_interval({version})")


def machine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of the machine table, one version per day."""
    rows = machine_versions(spark, sf_dir)
    return log_of_versions(
        rows, MACHINE_KEY, "batch_no", day_ts("batch_no"), null_keys=False
    )


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the year of shipping as version, one row per line and version."""
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "version", F.year("l_shipdate") - FIRST_YEAR
    )
    return latest_per_key(rows, [*LINE_KEY, "version"], ["l_shipdate"], null_keys=False)


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_versions(spark, sf_dir)
    return log_of_versions(rows, LINE_KEY, "version", day_ts("version"), null_keys=False)
