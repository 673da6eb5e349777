"""Column names, table schemas and the checks that hold a frame to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, TS, DATE = T.StringType(), T.TimestampType(), T.DateType()

# Header of the raw file, column name and type, in file order.
RAW_FIELDS = [
    ("UDI", "udi", INT),
    ("Product ID", "product_id", STRING),
    ("Type", "machine_type", STRING),
    ("Air temperature [K]", "air_temperature_k", DOUBLE),
    ("Process temperature [K]", "process_temperature_k", DOUBLE),
    ("Rotational speed [rpm]", "rotational_speed_rpm", INT),
    ("Torque [Nm]", "torque_nm", DOUBLE),
    ("Tool wear [min]", "tool_wear_min", INT),
    ("Machine failure", "machine_failure", INT),
    ("TWF", "twf", INT),
    ("HDF", "hdf", INT),
    ("PWF", "pwf", INT),
    ("OSF", "osf", INT),
    ("RNF", "rnf", INT),
]
FAILURES = ["twf", "hdf", "pwf", "osf", "rnf"]
MEASURES = [
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
]


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


HEADERS = {header: name for header, name, _ in RAW_FIELDS}
RAW_COLUMNS = [name for _, name, _ in RAW_FIELDS]
RAW_FILE = _schema(*[(header, kind) for header, _, kind in RAW_FIELDS])
RAW = _schema(*[(name, kind) for _, name, kind in RAW_FIELDS])

_ARRIVAL = [("ingestion_ts", TS), ("source_file", STRING), ("log_ts", TS)]
BRONZE = _schema(*[(name, kind) for _, name, kind in RAW_FIELDS], *_ARRIVAL, ("ingestion_date", DATE))
TEXT_BRONZE = _schema(
    *[(name, STRING) for _, name, _ in RAW_FIELDS], *_ARRIVAL, ("ingestion_date", DATE)
)
SILVER_INPUT = _schema(*[(name, kind) for _, name, kind in RAW_FIELDS], *_ARRIVAL)
SILVER = T.StructType(
    SILVER_INPUT.fields
    + _schema(("event_date", DATE), ("event_hour", INT), ("_silver_loaded_ts", TS)).fields
)
# Columns and types of the tables.
QUARANTINE = _schema(("raw_payload", STRING), ("error_reason", STRING), ("_quarantine_ts", TS))
AUDIT = _schema(
    ("audit_ts", TS),
    ("total_rows", LONG),
    ("null_key_rows", LONG),
    ("invalid_air_temp_rows", LONG),
    ("invalid_process_temp_rows", LONG),
    ("invalid_rotation_rows", LONG),
    ("invalid_torque_rows", LONG),
    ("invalid_tool_wear_rows", LONG),
    ("quality_status", STRING),
)
CONTROL = _schema(
    ("pipeline_name", STRING), ("last_silver_commit_version", LONG), ("last_run_ts", TS)
)
FEATURES = _schema(
    ("udi", INT),
    ("product_id", STRING),
    ("machine_type", STRING),
    ("event_date", DATE),
    ("event_hour", INT),
    *[(m, RAW[m].dataType) for m in MEASURES],
    ("machine_failure", INT),
    *[(f"{f}_label", INT) for f in FAILURES],
    ("_gold_loaded_ts", TS),
)
GROUP_KEYS = ["product_id", "machine_type", "event_date"]
DAILY = _schema(
    ("product_id", STRING),
    ("machine_type", STRING),
    ("event_date", DATE),
    ("total_registros", LONG),
    *[(f"avg_{m}", DOUBLE) for m in MEASURES],
    *[(f"total_{f}", LONG) for f in FAILURES],
    ("_gold_agg_loaded_ts", TS),
)
# What daily aggregates are made from: all of it adds up over changes.
DAILY_STATE = _schema(
    ("product_id", STRING),
    ("machine_type", STRING),
    ("event_date", DATE),
    ("n", LONG),
    *[(f"sum_{m}", T.DecimalType(38, 10)) for m in MEASURES],
    *[(f"n_{m}", LONG) for m in MEASURES],
    *[(f"total_{f}", LONG) for f in FAILURES],
)
PREDICTION_KEYS = ["udi", "model_name", "model_version"]
PREDICTIONS = _schema(
    ("udi", INT),
    ("product_id", STRING),
    ("prediction_ts", TS),
    *[(f"pred_{f}", INT) for f in FAILURES],
    ("model_name", STRING),
    ("model_version", STRING),
    ("prediction_score", DOUBLE),
    ("_pred_loaded_ts", TS),
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df``, or fail before any job with the sorted list of missing columns."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and reorder ``df`` to ``schema``; missing or extra columns are refused."""
    require_columns(df, schema.names)
    extra = sorted(set(df.columns) - set(schema.names))
    if extra:
        raise ValueError("columns not in the table: " + ", ".join(extra))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def snake_case(df: DataFrame) -> DataFrame:
    """Rename the raw header to column names; a byte-order mark before it is dropped."""
    bare = {c: c.lstrip("\ufeff") for c in df.columns}
    return df.withColumnsRenamed({c: HEADERS.get(b, b) for c, b in bare.items()})


def with_labels(df: DataFrame) -> DataFrame:
    """Rename the five failure flags to the label names used by the feature table."""
    return df.withColumnsRenamed({f: f"{f}_label" for f in FAILURES})


def failure_columns(df: DataFrame) -> dict[str, str]:
    """Map each failure to its column: the label columns when all five exist, else the flags."""
    have = {c.lower() for c in df.columns}
    labelled = all(f"{f}_label" in have for f in FAILURES)
    return {f: f"{f}_label" if labelled else f for f in FAILURES}
