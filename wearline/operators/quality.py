"""Quality gate: typed rows, quarantine, violation counts and enforcement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions.rules import QUALITY_RULES, Rule
from wearline.operators.upsert import has_null
from wearline.schemas import AUDIT, QUARANTINE, SILVER, SILVER_INPUT, conform, require_columns

# Required fields, key fields of the audit, and quarantine reasons.
REQUIRED = ["product_id", "machine_type", "log_ts"]
AUDIT_KEYS = ["udi", "product_id", "machine_type", "log_ts"]
MISSING_REASON = "Campos obrigatórios ausentes (product_id/machine_type/log_ts)"
CAST_REASON = "Valor não conversível para o tipo da coluna"


def try_casts(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Typed form of each schema column, NULL where the text cannot be read as its type."""
    return {
        f.name: F.col(f.name)
        if df.schema[f.name].dataType == f.dataType
        else F.col(f.name).try_cast(f.dataType)
        for f in schema
    }


def _bad_cast(df: DataFrame, schema: T.StructType) -> Column:
    test = F.lit(False)
    for name, typed in try_casts(df, schema).items():
        if df.schema[name].dataType != schema[name].dataType:
            test = test | (F.col(name).isNotNull() & typed.isNull())
    return test


def split_valid(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    schema: T.StructType = SILVER_INPUT,
    ignore_null_fields: bool = True,
    also: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Valid rows cast to ``schema``, and the rest as (raw_payload, error_reason).

    A row is valid when every required field is there and every value fits its type.
    ``also`` names further columns that valid rows keep.
    """
    require_columns(df, schema.names)
    missing, unreadable = has_null(required), _bad_cast(df, schema)
    typed = try_casts(df, schema)
    valid = df.filter(~missing & ~unreadable).select(
        *[c.alias(n) for n, c in typed.items()], *also
    )
    payload = F.to_json(
        F.struct(*schema.names), {"ignoreNullFields": str(ignore_null_fields).lower()}
    )
    quarantine = df.filter(missing | unreadable).select(
        payload.alias("raw_payload"),
        F.when(missing, MISSING_REASON).otherwise(CAST_REASON).alias("error_reason"),
    )
    return valid, quarantine


def with_event_time(df: DataFrame) -> DataFrame:
    """Add the date and hour of ``log_ts``."""
    return df.withColumns({"event_date": F.to_date("log_ts"), "event_hour": F.hour("log_ts")})


def silver_rows(valid: DataFrame, run_ts: Column) -> DataFrame:
    rows = with_event_time(valid).withColumn("_silver_loaded_ts", run_ts)
    return conform(rows.select(*SILVER.names), SILVER)


def quarantine_rows(rejected: DataFrame, run_ts: Column) -> DataFrame:
    """One row per distinct payload and reason."""
    return conform(rejected.distinct().withColumn("_quarantine_ts", run_ts), QUARANTINE)


def audit(
    df: DataFrame,
    rules: Sequence[Rule] = QUALITY_RULES,
    keys: Sequence[str] = AUDIT_KEYS,
    empty_is_pass: bool = False,
) -> DataFrame:
    """One row: total, rows with a missing key, violations per rule, and the verdict.

    On an empty table the counts are NULL and the verdict is FAIL, as SUM gives in SQL;
    ``empty_is_pass`` turns both round.
    """
    tests = {"null_key_rows": has_null(keys)} | {r.name: r.predicate for r in rules}
    counts = {name: F.sum(F.when(test, 1).otherwise(0)) for name, test in tests.items()}
    if empty_is_pass:
        counts = {name: F.coalesce(count, F.lit(0)) for name, count in counts.items()}
    row = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[c.alias(name) for name, c in counts.items()]
    )
    clean = F.lit(True)
    for name in counts:
        clean = clean & (F.col(name) == 0)
    return row.withColumn("quality_status", F.when(clean, "PASS").otherwise("FAIL"))


def audit_rows(df: DataFrame, run_ts: Column) -> DataFrame:
    return conform(audit(df).withColumn("audit_ts", run_ts), AUDIT)


def enforce(
    df: DataFrame, rules: Sequence[Rule] = QUALITY_RULES, null_violates: bool = False
) -> DataFrame:
    """The same rows; the job that reads them fails on the first row that breaks a rule.

    ``null_violates`` makes a rule that cannot be decided count as broken.
    """
    checks = [
        F.when(
            F.coalesce(rule.predicate, F.lit(null_violates)),
            F.raise_error(F.lit(f"row breaks rule {rule.name}")).cast("boolean"),
        )
        for rule in rules
    ]
    return df.filter(F.coalesce(*checks, F.lit(True)))
