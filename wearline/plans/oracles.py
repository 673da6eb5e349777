"""Check queries: the same results in standard SQL, for a second engine to run."""

from __future__ import annotations

from wearline.schemas import FAILURES, MEASURES, RAW_COLUMNS
from wearline.sources.driver_tables import SENSOR_COLUMNS, VALID

RAW = ", ".join(RAW_COLUMNS)
MEASURE_LIST = ", ".join(MEASURES)
LABELS = ", ".join(f"{f} AS {f}_label" for f in FAILURES)
FEATURES = (
    f"udi, product_id, machine_type, event_date, event_hour, {MEASURE_LIST}, "
    f"machine_failure, {LABELS}"
)
# The baseline's identity, its thresholds, and the columns of the daily table.
IDENTITY = "'baseline_rule_engine' AS model_name, 'v0' AS model_version"
PRED_LIST = ", ".join(f"pred_{f}" for f in FAILURES)
ANY_PRED = " OR ".join(f"pred_{f} = 1" for f in FAILURES)
PREDICTED = (
    "CASE WHEN tool_wear_min > 200 THEN 1 ELSE 0 END AS pred_twf, "
    "CASE WHEN process_temperature_k - air_temperature_k > 10 THEN 1 ELSE 0 END AS pred_hdf, "
    "CASE WHEN torque_nm > 55 THEN 1 ELSE 0 END AS pred_pwf, "
    "CASE WHEN rotational_speed_rpm < 1200 AND torque_nm > 50 THEN 1 ELSE 0 END AS pred_osf, "
    "CASE WHEN machine_type = 'L' AND tool_wear_min > 180 THEN 1 ELSE 0 END AS pred_rnf"
)
DAILY = (
    "product_id, machine_type, event_date, COUNT(*) AS total_registros, "
    + ", ".join(f"ROUND(AVG({m}), 6) AS avg_{m}" for m in MEASURES)
    + ", "
    + ", ".join(f"CAST(SUM({f}) AS BIGINT) AS total_{f}" for f in FAILURES)
)
BY_GROUP = "GROUP BY product_id, machine_type, event_date"
TIE_BREAK = ", ".join(f"{c} DESC NULLS LAST" for c in RAW_COLUMNS if c != "udi")
DAY = "TIMESTAMP '2024-01-01 00:00:00' + batch_no * INTERVAL 1 DAY"

_SENSORS = "sensors AS (SELECT " + ", ".join(
    f"{sql} AS {name}" for name, sql in SENSOR_COLUMNS.items()
) + " FROM events)"
_VALID = f"{_SENSORS}, valid AS (SELECT * FROM sensors WHERE {VALID})"
_REST = ", ".join(c for c in SENSOR_COLUMNS if c != "udi")
_MACHINES = (
    f"{_VALID}, machines AS (SELECT CAST(substr(product_id, 2) AS INT) AS udi, udi AS reading, "
    f"{_REST} FROM valid), versions AS (SELECT udi, reading, {_REST} FROM (SELECT *, ROW_NUMBER() "
    "OVER (PARTITION BY udi, batch_no ORDER BY log_ts DESC, reading DESC) AS rn FROM machines) t "
    "WHERE rn = 1)"
)


def _log(rows: str, key: str, version: str, ts: str, columns: str) -> str:
    """Change rows of ``rows``: inserts, postimages, and preimages at the next version."""
    return (
        f"(WITH n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {version}) AS k, "
        f"LEAD({version}) OVER (PARTITION BY {key} ORDER BY {version}) AS nv FROM {rows}), "
        f"i AS (SELECT *, CASE WHEN k = 1 THEN 'insert' ELSE 'update_postimage' END AS ct, "
        f"{version} AS cv FROM n UNION ALL SELECT *, 'update_preimage' AS ct, nv AS cv FROM n "
        f"WHERE nv IS NOT NULL) SELECT ct AS _change_type, CAST(cv AS BIGINT) AS _commit_version, "
        f"{ts} AS _commit_timestamp, {columns} FROM i)"
    )


_CV_DAY = "TIMESTAMP '2024-01-01 00:00:00' + CAST(cv AS INT) * INTERVAL 1 DAY"
_STATE = f"udi, reading, {_REST}".replace(", batch_no", "")
_MLOG = f"{_MACHINES}, log AS " + _log("versions", "udi", "batch_no", _CV_DAY, _STATE)
_PLOG = (
    f"{_MACHINES}, made AS (SELECT udi, product_id, batch_no, {DAY} AS prediction_ts, {PREDICTED}, "
    f"{IDENTITY}, CAST(0.5 AS DOUBLE) AS prediction_score FROM versions), plog AS "
    + _log(
        "made",
        "udi",
        "batch_no",
        _CV_DAY,
        f"udi, product_id, prediction_ts, {PRED_LIST}, model_name, model_version, prediction_score",
    )
)
_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_TIES = ", ".join(
    f"{c} DESC"
    for c in ["l_shipdate", *_LINE_COLUMNS.replace(" ", "").split(",")]
    if c not in ("l_orderkey", "l_linenumber")
)
_LINES = (
    f"lines AS (SELECT {_LINE_COLUMNS}, version FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
    f"l_orderkey, l_linenumber, version ORDER BY {_LINE_TIES}) AS rn FROM (SELECT *, "
    "CAST(extract(year FROM l_shipdate) AS INT) - 1995 AS version FROM lineitem) a) b WHERE rn = 1)"
)
_LLOG = f"{_LINES}, llog AS " + _log(
    "lines", "l_orderkey, l_linenumber", "version", _CV_DAY, _LINE_COLUMNS
)
FEED = (
    "_change_type, _commit_version, _commit_timestamp, udi, reading, product_id, machine_type, "
    f"{MEASURE_LIST}, event_date"
)


def _newest(rows: str, key: str, order: str, columns: str, where: str = "TRUE") -> str:
    return (
        f"(SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY "
        f"{order}) AS rn FROM {rows} WHERE {where}) z WHERE rn = 1)"
    )


_IMAGES = "_change_type IN ('insert', 'update_postimage')"


def _machine_state(where: str) -> str:
    return _newest("log", "udi", "_commit_version DESC", _STATE, f"{_IMAGES} AND {where}")


def _history(log: str) -> str:
    return (
        "SELECT _commit_version, _commit_timestamp, "
        "COUNT(*) FILTER (WHERE _change_type = 'insert') AS rows_inserted, "
        "COUNT(*) FILTER (WHERE _change_type = 'update_postimage') AS rows_updated, "
        "COUNT(*) FILTER (WHERE _change_type = 'delete') AS rows_deleted "
        f"FROM {log} GROUP BY _commit_version, _commit_timestamp"
    )


def _audit(where: str, extra: str = "") -> str:
    tests = {
        "null_key_rows": "udi IS NULL OR product_id IS NULL OR machine_type IS NULL OR log_ts IS NULL",
        "invalid_air_temp_rows": "NOT (air_temperature_k BETWEEN 250 AND 350)",
        "invalid_process_temp_rows": "NOT (process_temperature_k BETWEEN 250 AND 400)",
        "invalid_rotation_rows": "NOT (rotational_speed_rpm > 0)",
        "invalid_torque_rows": "NOT (torque_nm >= 0)",
        "invalid_tool_wear_rows": "NOT (tool_wear_min >= 0)",
    }
    sums = ", ".join(
        f"CAST(SUM(CASE WHEN {t} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, t in tests.items()
    )
    clean = " AND ".join(f"{n} = 0" for n in tests)
    return (
        f"SELECT *, CASE WHEN {clean} THEN 'PASS' ELSE 'FAIL' END AS quality_status{extra} FROM "
        f"(SELECT COUNT(*) AS total_rows, {sums} FROM {where}) c"
    )


def _health(where: str) -> str:
    return (
        "SELECT ROUND(COALESCE(AVG(tool_wear_min), 0), 6) AS avg_tool_wear, "
        "CAST(COALESCE(MAX(tool_wear_min), 0) AS INT) AS max_tool_wear, COUNT(*) AS total_records "
        f"FROM valid WHERE {where}"
    )


def _heat(where: str) -> str:
    return (
        "SELECT ROUND(air_temperature_k, 1) AS air_temperature_k, ROUND(torque_nm, 1) AS torque_nm, "
        f"COUNT(*) AS frequency FROM valid WHERE {where} GROUP BY 1, 2"
    )


def _failures(where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f.upper()}' AS failure_type, CAST(COALESCE(SUM({f}), 0) AS BIGINT) AS "
        f"total_failures FROM valid WHERE {where}"
        for f in FAILURES
    )


def _summary(where: str) -> str:
    return (
        "SELECT COUNT(*) AS total_records, COUNT(DISTINCT product_id) AS total_products, "
        f"COUNT(DISTINCT machine_type) AS total_types FROM valid WHERE {where}"
    )


def _bin(axis: str) -> str:
    return (
        f"CAST(LEAST(29, FLOOR(CASE WHEN hi_{axis} > lo_{axis} THEN ({axis} - lo_{axis}) / "
        f"(hi_{axis} - lo_{axis}) * 30 ELSE 0 END)) AS INT)"
    )


_JSON = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in RAW_COLUMNS) + "))"
MISSING = "Campos obrigatórios ausentes (product_id/machine_type/log_ts)"
NOT_CAST = "Valor não conversível para o tipo da coluna"
_TEXT = ", ".join(
    {
        "torque_nm": "CASE WHEN udi % 229 = 0 THEN 'n/a' ELSE CAST(torque_nm AS VARCHAR) END AS torque_nm",
        "tool_wear_min": "CASE WHEN udi % 233 = 0 THEN '12;5' ELSE CAST(tool_wear_min AS VARCHAR) END "
        "AS tool_wear_min",
    }.get(c, f"CAST({c} AS VARCHAR) AS {c}")
    for c in RAW_COLUMNS
)
_PICK = "product_id = 'P7' AND machine_type = 'L'"

# Machine states after the early and after all versions, and the refreshed aggregates.
_FEAT = (
    f"{_MLOG}, early AS {_machine_state('_commit_version <= 14')}, "
    f"late AS {_machine_state('TRUE')}"
)
_GROUPS = (
    "SELECT DISTINCT product_id, machine_type, event_date FROM log WHERE _commit_version > 14"
)


def _refreshed(kinds: str) -> str:
    touched = f"(product_id, machine_type, event_date) IN ({_GROUPS} AND {kinds})"
    return (
        f"WITH {_FEAT} SELECT {DAILY} FROM late WHERE {touched} {BY_GROUP} UNION ALL "
        f"SELECT {DAILY} FROM early WHERE NOT ({touched}) {BY_GROUP}"
    )


# The whole flow: early readings by machine on one day, late ones on the next.
def _run(where: str, day: str) -> str:
    return (
        f"(SELECT {RAW}, DATE '{day}' AS event_date FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
        f"udi ORDER BY {TIE_BREAK}) AS rn FROM machines WHERE {where}) z WHERE rn = 1)"
    )


_FLOW = (
    f"{_MACHINES}, first_run AS {_run('batch_no < 15', '2026-04-02')}, "
    f"second_run AS {_run('batch_no >= 15', '2026-04-03')}, final AS (SELECT * FROM second_run "
    "UNION ALL SELECT * FROM first_run WHERE udi NOT IN (SELECT udi FROM second_run))"
)
_BUCKET = "CAST('0x' || substr(md5(CAST(udi AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 1000"
_ADVANCED = "SELECT 'gold_from_silver_cdf' AS pipeline_name, CAST(MAX(_commit_version) AS BIGINT)"
_PAIRS = (
    "s.udi, s.product_id, "
    + ", ".join(f"s.{m}" for m in MEASURES)
    + ", "
    + ", ".join(f"g.pred_{f}" for f in FAILURES)
    + ", g.model_name, g.model_version"
)

def _dates_as_text(sql: str, *columns: str) -> str:
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({texts}) FROM ({sql}) dated"


_DATED = {
    "event_date": [
        "q_truncate_reload",
        "q_loaded_features",
        "q_silver_projection",
        "q_daily_agg",
        "q_features_of_feed",
        "q_affected_groups",
        "q_daily_incremental",
        "q_daily_recompute_moved",
        "q_daily_state",
        "q_stream_gold",
        "q_changed_machines",
        "q_latest_per_key",
        "q_upsert_1key",
        "q_change_feed",
        "q_changes_from",
        "q_changes_between",
        "q_changes_above_mark",
        "q_as_of_version",
        "q_as_of_timestamp",
        "q_failed_as_of_version",
        "q_state_before_first_failure",
        "q_flow_daily",
        "q_flow_daily_moved",
        "q_flow_clustered",
    ],
    "ingestion_date": ["q_bronze_append"],
}
_RESULTS = {
    "q_raw_scan": f"WITH {_SENSORS} SELECT {RAW} FROM sensors",
    "q_raw_scan_sniffed": f"WITH {_SENSORS} SELECT {RAW} FROM sensors",
    "q_bronze_append": f"WITH {_SENSORS} SELECT d.day AS ingestion_date, COUNT(udi) AS n_rows, "
    "COUNT(*) AS n_sources, CAST(SUM(tool_wear_min) AS BIGINT) AS sum_wear FROM sensors, "
    "(VALUES (DATE '2026-04-02'), (DATE '2026-04-03')) d(day) GROUP BY d.day",
    "q_stream_bronze": f"WITH {_SENSORS} SELECT {RAW} FROM sensors",
    "q_bronze_mixed": f"WITH {_SENSORS} SELECT CAST(batch_no % 3 AS INT) AS part, COUNT(*) AS n_rows, "
    "CAST(SUM(udi) AS BIGINT) AS sum_udi, CAST(SUM(tool_wear_min) AS BIGINT) AS sum_wear FROM sensors "
    "GROUP BY 1",
    "q_flow_late_ingest": f"WITH {_VALID} SELECT {RAW} FROM valid",
    "q_stream_evolved": f"WITH {_SENSORS} SELECT CASE WHEN batch_no < 15 THEN NULL ELSE batch_no END "
    "AS batch_no, COUNT(*) AS n_rows, CAST(SUM(udi) AS BIGINT) AS sum_udi FROM sensors GROUP BY 1",
    "q_stream_upsert": f"WITH {_MACHINES} SELECT {RAW} FROM "
    + _newest("machines", "udi", "CASE WHEN batch_no < 15 THEN 1 ELSE 0 END, reading DESC", RAW),
    "q_truncate_reload": f"WITH {_VALID} SELECT {FEATURES} FROM valid",
    "q_loaded_features": f"WITH {_SENSORS} SELECT udi, product_id, machine_type, DATE '2026-04-02' AS "
    f"event_date, 8 AS event_hour, {MEASURE_LIST}, machine_failure, {LABELS} FROM sensors",
    "q_silver_projection": f"WITH {_VALID} SELECT {RAW}, TIMESTAMP '2026-04-02 08:00:00' AS "
    "ingestion_ts, 'events' AS source_file, log_ts, event_date, event_hour FROM valid",
    "q_quarantine": f"WITH {_SENSORS} SELECT CAST({_JSON} AS VARCHAR) AS raw_payload, "
    f"'{MISSING}' AS error_reason FROM sensors WHERE NOT ({VALID})",
    "q_quarantine_bad_cast": f"WITH {_SENSORS}, txt AS (SELECT {_TEXT}, ({VALID}) AS whole, "
    "(udi % 229 = 0 OR udi % 233 = 0) AS bad FROM sensors) SELECT CAST("
    f"{_JSON} AS VARCHAR) AS raw_payload, CASE WHEN whole THEN '{NOT_CAST}' ELSE '{MISSING}' END AS "
    "error_reason FROM txt WHERE bad OR NOT whole",
    "q_valid_after_casts": f"WITH {_VALID} SELECT {RAW} FROM valid WHERE udi % 229 <> 0 AND "
    "udi % 233 <> 0",
    "q_quality_audit": f"WITH {_SENSORS} " + _audit("sensors"),
    "q_quality_audit_valid": f"WITH {_VALID} " + _audit("valid"),
    "q_quality_audit_empty": f"WITH {_SENSORS} " + _audit("sensors WHERE machine_type = 'X'"),
    "q_enforce_pass": f"WITH {_VALID} SELECT {RAW} FROM valid WHERE air_temperature_k BETWEEN 250 AND "
    "350 AND process_temperature_k BETWEEN 250 AND 400 AND rotational_speed_rpm > 0 AND "
    "torque_nm >= 0 AND tool_wear_min >= 0",
    "q_daily_agg": f"WITH {_VALID} SELECT {DAILY} FROM valid {BY_GROUP}",
    "q_rule_predictions": f"WITH {_SENSORS} SELECT udi, product_id, {PREDICTED}, {IDENTITY}, "
    "CAST(0.5 AS DOUBLE) AS prediction_score FROM sensors",
    "q_rule_totals": f"WITH {_SENSORS}, p AS (SELECT {PREDICTED} FROM sensors) SELECT "
    + ", ".join(f"CAST(SUM(pred_{f}) AS BIGINT) AS pred_{f}" for f in FAILURES)
    + f", COUNT(*) FILTER (WHERE {ANY_PRED}) AS any_failure FROM p",
    "q_features_of_feed": f"WITH {_FEAT} SELECT {FEATURES} FROM late",
    "q_affected_groups": f"WITH {_MLOG} {_GROUPS}",
    "q_daily_incremental": _refreshed(_IMAGES),
    "q_daily_recompute_moved": f"WITH {_FEAT} SELECT {DAILY} FROM late {BY_GROUP}",
    "q_daily_state": f"WITH {_FEAT} SELECT {DAILY} FROM late {BY_GROUP}",
    "q_changed_machines": f"WITH {_MLOG} SELECT reading, {FEATURES} FROM machines WHERE udi IN "
    f"(SELECT udi FROM log WHERE _commit_version > (SELECT MAX(_commit_version) FROM log) - 2 AND {_IMAGES})",
    "q_changed_order_lines": "SELECT l_returnflag, COUNT(*) AS n_lines, ROUND(SUM(l_quantity), 2) AS "
    "sum_qty FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus "
    "= 'O') GROUP BY l_returnflag",
    "q_health": f"WITH {_VALID} " + _health("TRUE"),
    "q_health_filtered": f"WITH {_VALID} " + _health(_PICK),
    "q_risk": f"WITH {_VALID}, h AS (SELECT AVG(tool_wear_min) AS a, MAX(tool_wear_min) AS m, "
    "COUNT(*) AS n FROM valid WHERE machine_type = 'H'), r AS (SELECT *, LEAST(100, a / "
    "GREATEST(CAST(m AS DOUBLE), 1) * 100) AS s FROM h) SELECT ROUND(a, 6) AS avg_tool_wear, "
    "CAST(m AS INT) AS max_tool_wear, n AS total_records, ROUND(s, 6) AS risk_score, CASE WHEN "
    "s < 35 THEN 'low' WHEN s < 70 THEN 'medium' ELSE 'high' END AS risk_band FROM r",
    "q_heat": f"WITH {_VALID} " + _heat("TRUE"),
    "q_heat_filtered": f"WITH {_VALID} " + _heat("machine_type = 'M'"),
    "q_heat_binned": f"WITH {_VALID}, h AS ({_heat('TRUE')}), b AS (SELECT "
    "MIN(air_temperature_k) AS lo_air_temperature_k, MAX(air_temperature_k) AS hi_air_temperature_k, "
    "MIN(torque_nm) AS lo_torque_nm, MAX(torque_nm) AS hi_torque_nm FROM h) SELECT "
    f"{_bin('air_temperature_k')} AS air_bin, {_bin('torque_nm')} AS torque_bin, "
    "CAST(SUM(frequency) AS BIGINT) AS frequency FROM h, b GROUP BY 1, 2",
    "q_heat_first_1000": f"WITH {_VALID}, h AS ({_heat('TRUE')}) SELECT * FROM h ORDER BY "
    "air_temperature_k, torque_nm LIMIT 1000",
    "q_failure_distribution": f"WITH {_VALID} " + _failures("TRUE"),
    "q_failure_distribution_filtered": f"WITH {_VALID} " + _failures(_PICK),
    "q_summary": f"WITH {_VALID} " + _summary("TRUE"),
    "q_summary_filtered": f"WITH {_VALID} " + _summary(_PICK),
    "q_filter_products": f"WITH {_SENSORS} SELECT DISTINCT product_id FROM sensors WHERE product_id "
    "IS NOT NULL",
    "q_filter_types": f"WITH {_SENSORS} SELECT DISTINCT machine_type FROM sensors WHERE machine_type "
    "IS NOT NULL",
    "q_top_match": "SELECT concat(o_orderstatus, '.', CAST(o_orderkey AS VARCHAR)) AS full_name, "
    "o_orderkey FROM orders WHERE lower(o_orderstatus) = 'p' ORDER BY CASE WHEN "
    "lower(o_orderpriority) = '1-urgent' THEN 0 ELSE 1 END, CASE WHEN lower(o_orderpriority) = "
    "'2-high' THEN 0 ELSE 1 END, o_orderdate, o_orderkey LIMIT 1",
    "q_latest_per_key": f"WITH {_MACHINES} SELECT * FROM versions",
    "q_latest_per_line": "SELECT * FROM "
    + _newest("lineitem", "l_orderkey, l_linenumber", _LINE_TIES, _LINE_COLUMNS),
    "q_upsert_1key": f"WITH {_MACHINES} SELECT * FROM "
    + _newest("versions", "udi", "batch_no DESC", f"udi, reading, {_REST}"),
    "q_upsert_2key": f"WITH {_LINES} SELECT * FROM "
    + _newest("lines", "l_orderkey, l_linenumber", "version DESC", f"{_LINE_COLUMNS}, version"),
    "q_upsert_3key": f"WITH {_MACHINES} SELECT udi, product_id, {PREDICTED}, {IDENTITY}, "
    "CAST(0.5 AS DOUBLE) AS prediction_score FROM "
    + _newest("versions", "udi", "batch_no DESC", "*"),
    "q_insert_absent": f"WITH {_LINES} SELECT * FROM lines WHERE version = 0 UNION ALL SELECT * FROM "
    + _newest(
        "lines",
        "l_orderkey, l_linenumber",
        "version DESC",
        f"{_LINE_COLUMNS}, version",
        "version > 0 AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) "
        "FROM lines WHERE version = 0)",
    ),
    "q_touch_quarantine": f"WITH {_SENSORS}, r AS (SELECT CAST(to_json(struct_pack(product_id := "
    "product_id, machine_type := machine_type)) AS VARCHAR) AS raw_payload, MIN(batch_no) AS lo, "
    f"MAX(batch_no) AS hi FROM sensors WHERE NOT ({VALID}) GROUP BY 1) SELECT raw_payload, 'missing' "
    "AS error_reason, CASE WHEN lo < 20 THEN 'first' ELSE 'second' END AS note, CASE WHEN hi >= 10 "
    "THEN TIMESTAMP '2026-04-03 08:00:00' ELSE TIMESTAMP '2026-04-02 08:00:00' END AS "
    "_quarantine_ts FROM r",
    "q_advance_mark": f"WITH {_MLOG} {_ADVANCED} AS last_silver_commit_version FROM log UNION ALL "
    "SELECT 'other', CAST(-1 AS BIGINT)",
    "q_change_feed": f"WITH {_MLOG} SELECT {FEED} FROM log",
    "q_changes_from": f"WITH {_MLOG} SELECT {FEED} FROM log WHERE _commit_version >= 20",
    "q_changes_between": f"WITH {_MLOG} SELECT {FEED} FROM log WHERE _commit_version > 5 AND "
    "_commit_version <= 20",
    "q_changes_above_mark": f"WITH {_MLOG} SELECT {FEED} FROM log WHERE {_IMAGES} AND "
    "_commit_version > 14",
    "q_as_of_version": f"WITH {_MLOG} SELECT * FROM " + _machine_state("_commit_version <= 9"),
    "q_as_of_timestamp": f"WITH {_MLOG} SELECT * FROM "
    + _machine_state("_commit_timestamp <= TIMESTAMP '2024-01-20 12:00:00'"),
    "q_failed_as_of_version": f"WITH {_MLOG} SELECT * FROM "
    + _machine_state("_commit_version <= 9")
    + " WHERE machine_failure = 1",
    "q_failures_as_of": f"WITH {_PLOG} SELECT * FROM "
    + _newest(
        "plog",
        "udi",
        "_commit_version DESC",
        f"udi, product_id, prediction_ts, {PRED_LIST}, model_name, model_version, prediction_score",
        f"{_IMAGES} AND _commit_timestamp <= TIMESTAMP '2024-01-11 00:00:00'",
    )
    + f" WHERE {ANY_PRED}",
    "q_state_before_first_failure": f"WITH {_MLOG}, first AS (SELECT MIN(f.batch_no) AS v FROM (SELECT "
    f"batch_no, {PREDICTED} FROM versions) f WHERE pred_osf = 1) SELECT * FROM "
    + _machine_state("_commit_version <= (SELECT v FROM first)"),
    "q_history": f"WITH {_MLOG} " + _history("log"),
    "q_line_history": f"WITH {_LLOG} " + _history("llog"),
    "q_line_as_of": f"WITH {_LINES} SELECT * FROM "
    + _newest("lines", "l_orderkey, l_linenumber", "version DESC", _LINE_COLUMNS, "version <= 4"),
    "q_committed_feed": f"WITH {_LLOG} SELECT * FROM llog",
    "q_committed_state": f"WITH {_LINES} SELECT * FROM "
    + _newest("lines", "l_orderkey, l_linenumber", "version DESC", _LINE_COLUMNS, "version <= 5"),
    "q_committed_history": f"WITH {_LLOG}, h AS ({_history('llog')}) SELECT _commit_version, "
    "rows_inserted, rows_updated, rows_deleted FROM h",
    "q_silver_history": f"WITH {_MLOG} SELECT _change_type, _commit_version, _commit_timestamp, udi, "
    f"product_id, machine_type, {MEASURE_LIST}, machine_failure, {', '.join(FAILURES)} FROM log",
    "q_prediction_history": f"WITH {_PLOG} SELECT * FROM plog",
    "q_audit_join": f"WITH {_PLOG}, log AS {_MLOG.split('log AS ', 1)[1]} SELECT s._commit_version AS "
    "silver_version, s._commit_timestamp AS silver_commit_ts, g._commit_version AS gold_version, "
    f"g._commit_timestamp AS gold_commit_ts, {_PAIRS} FROM log s JOIN plog g ON s.udi = g.udi AND "
    "s.product_id = g.product_id WHERE s._change_type IN ('insert', 'update_postimage') AND "
    "g._change_type IN ('insert', 'update_postimage')",
    "q_audit_current": f"WITH {_PLOG}, log AS {_MLOG.split('log AS ', 1)[1]}, s AS (SELECT *, "
    "LEAD(_commit_timestamp) OVER (PARTITION BY udi, product_id ORDER BY _commit_timestamp) AS nx FROM "
    f"log WHERE {_IMAGES}), j AS (SELECT s._commit_version AS silver_version, s._commit_timestamp AS "
    "silver_commit_ts, g._commit_version AS gold_version, g._commit_timestamp AS gold_commit_ts, "
    f"s.udi, s.product_id, {', '.join(f's.{m}' for m in MEASURES)}, {PRED_LIST}, model_name, "
    "model_version, ROW_NUMBER() OVER (PARTITION BY s.udi, s.product_id, s._commit_version ORDER BY "
    "g._commit_timestamp, model_name) AS rn FROM s LEFT JOIN (SELECT * FROM plog WHERE "
    f"{_IMAGES}) g ON s.udi = g.udi AND s.product_id = g.product_id AND g._commit_timestamp >= "
    "s._commit_timestamp AND (s.nx IS NULL OR g._commit_timestamp < s.nx)) SELECT * EXCLUDE (rn) "
    "FROM j WHERE rn = 1",
    "q_split_missing": f"WITH {_SENSORS} SELECT machine_type, COUNT(*) AS n_before, COUNT(*) AS n_after "
    "FROM sensors GROUP BY 1",
    "q_split_stratified": f"WITH {_VALID}, h AS (SELECT udi, machine_failure, {_BUCKET} AS b FROM "
    "valid), c AS (SELECT machine_failure, b, COUNT(*) AS n FROM h GROUP BY 1, 2), s AS (SELECT *, "
    "SUM(n) OVER (PARTITION BY machine_failure ORDER BY b) AS u, SUM(n) OVER (PARTITION BY "
    "machine_failure) AS a FROM c), t AS (SELECT machine_failure, b AS last, ROW_NUMBER() OVER "
    "(PARTITION BY machine_failure ORDER BY ABS(u * 100 - a * 20), b) AS rn FROM s) SELECT h.udi, "
    "h.machine_failure, CASE WHEN h.b <= t.last THEN 'test' ELSE 'train' END AS part FROM h JOIN t ON "
    "h.machine_failure = t.machine_failure WHERE t.rn = 1",
    "q_f1": f"WITH {_VALID}, p AS (SELECT *, {PREDICTED} FROM valid) "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS target, ROUND(CASE WHEN SUM({f}) + SUM(pred_{f}) > 0 THEN 2.0 * "
        f"SUM({f} * pred_{f}) / (SUM({f}) + SUM(pred_{f})) ELSE 0.0 END, 6) AS f1 FROM p"
        for f in FAILURES
    ),
    "q_model_upsert": f"WITH {_VALID}, m AS (SELECT * FROM (VALUES ('baseline_rule_engine', 'v0'), "
    "('gbt_multioutput', 'v1')) t(model_name, model_version)) SELECT model_name, model_version, "
    "COUNT(*) AS n_rows, COUNT(DISTINCT udi) AS n_machines, CAST(0 AS BIGINT) AS bad_scores FROM "
    "valid, m GROUP BY 1, 2",
    "q_gbt_scores": f"WITH {_VALID} SELECT udi, product_id, TRUE AS flags_ok, TRUE AS score_ok, TRUE AS "
    "agrees, 'gbt_multioutput' AS model_name, 'v1' AS model_version FROM valid",
    "q_model_f1": "SELECT * FROM (VALUES " + ", ".join(f"('{f}', TRUE)" for f in FAILURES)
    + ") t(target, learned)",
    "q_model_reloaded": f"WITH {_VALID} SELECT udi, TRUE AS same FROM valid",
    "q_layout_skips_files": "SELECT TRUE AS found, TRUE AS in_few_files",
    "q_layout_same_rows": f"WITH {_VALID} SELECT {RAW}, log_ts FROM valid",
    "q_flow_daily": f"WITH {_FLOW} SELECT {DAILY} FROM first_run WHERE (product_id, machine_type, "
    "event_date) NOT IN (SELECT (product_id, machine_type, event_date) FROM second_run) "
    f"{BY_GROUP} UNION ALL SELECT {DAILY} FROM second_run {BY_GROUP}",
    "q_flow_daily_moved": f"WITH {_FLOW} SELECT {DAILY} FROM final {BY_GROUP}",
    "q_flow_audit": f"WITH {_FLOW}, s AS (SELECT CAST(0 AS BIGINT) AS v, * FROM first_run UNION ALL "
    f"SELECT CAST(1 AS BIGINT), * FROM second_run), g AS (SELECT v, udi, product_id, {PREDICTED}, "
    f"{IDENTITY} FROM s) SELECT s.v AS silver_version, g.v AS gold_version, {_PAIRS} FROM s JOIN g "
    "ON s.udi = g.udi AND s.product_id = g.product_id",
    "q_flow_clustered": f"WITH {_FLOW} SELECT udi, product_id, machine_type, event_date, "
    f"{MEASURE_LIST}, machine_failure, {LABELS} FROM final",
    "q_flow_quality": f"WITH {_FLOW}, q AS (SELECT COUNT(*) AS quarantined FROM (SELECT DISTINCT "
    f"{RAW}, batch_no < 15 AS half FROM (SELECT CASE WHEN product_id IS NULL THEN NULL ELSE "
    f"CAST(substr(product_id, 2) AS INT) END AS udi, {_REST} FROM sensors WHERE NOT ({VALID})) z) y), "
    "runs AS (SELECT TIMESTAMP '2026-04-02 08:00:00' AS audit_ts, a.* FROM ("
    + _audit("(SELECT *, event_date AS log_ts FROM first_run) x")
    + ") a UNION ALL SELECT TIMESTAMP '2026-04-03 08:00:00' AS audit_ts, a.* FROM ("
    + _audit("(SELECT *, event_date AS log_ts FROM final) x")
    + ") a) SELECT runs.*, q.quarantined FROM runs, q",
}

_HOT_TS = "TIMESTAMP '2024-01-01 00:00:00' + reading * INTERVAL 1 SECOND"
_GOLD_COLUMNS = f"{PRED_LIST}, model_name, model_version"
_RESULTS |= {
    "q_audit_current_hot": f"WITH {_VALID}, hot AS (SELECT * REPLACE (CASE WHEN udi % 3 = 0 THEN 0 ELSE "
    "CAST(substr(product_id, 2) AS INT) END AS udi, CASE WHEN udi % 3 = 0 THEN 'P0' ELSE product_id END AS "
    f"product_id), udi AS reading FROM valid), s AS (SELECT *, {_HOT_TS} AS ts FROM hot), n AS (SELECT *, "
    f"LEAD(ts) OVER (PARTITION BY udi, product_id ORDER BY ts) AS nx FROM s), g AS (SELECT udi, product_id, "
    f"reading AS gold_version, {_HOT_TS} + INTERVAL 500 MILLISECOND AS gold_ts, {PREDICTED}, {IDENTITY} FROM "
    "hot WHERE reading % 2 = 0) SELECT CAST(n.reading AS BIGINT) AS silver_version, n.ts AS silver_commit_ts, "
    "CAST(g.gold_version AS BIGINT) AS gold_version, g.gold_ts AS gold_commit_ts, n.udi, n.product_id, "
    f"{', '.join(f'n.{m}' for m in MEASURES)}, {_GOLD_COLUMNS} FROM n LEFT JOIN g ON n.udi = g.udi AND "
    "n.product_id = g.product_id AND g.gold_version = n.reading",
    "q_flow_audit_current": f"WITH {_FLOW}, s AS (SELECT CAST(0 AS BIGINT) AS v, * FROM first_run UNION ALL "
    f"SELECT CAST(1 AS BIGINT), * FROM second_run) SELECT v AS silver_version, v AS gold_version, udi, "
    f"product_id, {MEASURE_LIST}, {PREDICTED}, {IDENTITY} FROM s",
    "q_layout_grid": f"WITH {_VALID} SELECT COUNT(*) AS n_rows, TRUE AS product_in_a_third, TRUE AS "
    "day_in_a_third, TRUE AS both_in_few, TRUE AS even FROM valid",
    "q_layout_files": f"WITH {_VALID} SELECT state, COUNT(*) AS n_rows, CAST(SUM(udi) AS BIGINT) AS sum_udi, "
    "state = 'after' AS few_files FROM valid, (VALUES ('before'), ('after')) t(state) GROUP BY state",
    "q_upsert_bucketed": _RESULTS["q_upsert_2key"],
}
_RESULTS["q_stream_gold"] = _RESULTS["q_flow_daily"]

# Engines hand dates to a comparison in different forms, so they are compared as text.
ORACLES = _RESULTS | {
    name: _dates_as_text(_RESULTS[name], column) for column, names in _DATED.items() for name in names
}
