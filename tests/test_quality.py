from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wearline.functions.rules import FAILURE_RULES, QUALITY_RULES, Rule, flags
from wearline.operators.quality import (
    CAST_REASON,
    MISSING_REASON,
    audit,
    enforce,
    quarantine_rows,
    split_valid,
)
from wearline.schemas import RAW, SILVER_INPUT, conform, failure_columns, require_columns
from wearline.session import as_ts, is_one_machine

NAMES = [
    "udi",
    "product_id",
    "machine_type",
    "log_ts",
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
]
TYPES = (
    "udi int, product_id string, machine_type string, log_ts string, air_temperature_k double, "
    "process_temperature_k double, rotational_speed_rpm int, torque_nm double, tool_wear_min int"
)
VALID = (7, "L2040", "L", "2026-05-11T06:30:00", 297.5, 308.2, 1420, 36.5, 112)
INVALID = (None, "H2041", "H", "2026-05-11T06:30:00", 612.0, 95.5, 0, -3.5, -2)
COUNTS = ["null_key_rows", *[r.name for r in QUALITY_RULES]]


def rows(spark, *data):
    return spark.createDataFrame(list(data), TYPES)


def test_valid_row_passes(spark):
    row = audit(rows(spark, VALID)).first()
    assert row.quality_status == "PASS" and row.total_rows == 1
    assert [row[c] for c in COUNTS] == [0] * 6


def test_invalid_row_breaks_every_rule(spark):
    row = audit(rows(spark, INVALID)).first()
    assert row.quality_status == "FAIL"
    assert [row[c] for c in COUNTS] == [1] * 6


def test_empty_table_fails_unless_asked(spark):
    empty = rows(spark, VALID).filter("false")
    row = audit(empty).first()
    assert row.quality_status == "FAIL" and row.total_rows == 0
    assert [row[c] for c in COUNTS] == [None] * 6
    assert audit(empty, empty_is_pass=True).first().quality_status == "PASS"


@pytest.mark.parametrize(
    ("air", "process", "rpm", "torque", "wear", "bad"),
    [
        (250.0, 250.0, 1, 0.0, 0, 0),
        (350.0, 400.0, 1, 0.0, 0, 0),
        (None, None, None, None, None, 0),
        (249.9, 400.1, 0, -0.1, -1, 5),
    ],
)
def test_limits(spark, air, process, rpm, torque, wear, bad):
    data = rows(spark, (1, "M1", "M", "2026-04-02", air, process, rpm, torque, wear))
    row = audit(data).first()
    assert sum(row[r.name] for r in QUALITY_RULES) == bad
    if bad:
        with pytest.raises(Exception, match="row breaks rule invalid_air_temp_rows"):
            enforce(data).collect()
    else:
        assert enforce(data).count() == 1


def test_enforce_null_only_if_asked(spark):
    data = rows(spark, (1, "M1", "M", "2026-04-02", None, 300.0, 1, 1.0, 1))
    assert enforce(data).count() == 1
    with pytest.raises(Exception, match="row breaks rule"):
        enforce(data, null_violates=True).collect()


def raw(spark, **changes):
    base = {f.name: "1" for f in SILVER_INPUT} | {
        "product_id": "P",
        "machine_type": "L",
        "ingestion_ts": "2026-04-02 00:00:00",
        "log_ts": "2026-04-02 00:00:00",
    }
    data = spark.createDataFrame([tuple(base.values())], list(base))
    for name, value in changes.items():
        data = data.withColumn(name, F.lit(value).cast("string"))
    return data


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None),
        ({"torque_nm": "12.5"}, None),
        ({"udi": None}, None),
        ({"product_id": None}, MISSING_REASON),
        ({"log_ts": None, "torque_nm": "x"}, MISSING_REASON),
        ({"torque_nm": "x"}, CAST_REASON),
        ({"log_ts": "never"}, CAST_REASON),
    ],
)
def test_gate(spark, changes, reason):
    valid, rejected = split_valid(raw(spark, **changes))
    assert valid.count() == (reason is None)
    assert [r.error_reason for r in rejected.collect()] == ([] if reason is None else [reason])
    assert [f.dataType for f in valid.schema] == [f.dataType for f in SILVER_INPUT]


def test_quarantine_keeps_one_row_per_payload(spark):
    twice = raw(spark, product_id=None)
    _, rejected = split_valid(twice.union(twice))
    assert quarantine_rows(rejected, as_ts("2026-04-02")).count() == 1


def test_rule_flags(spark):
    data = spark.createDataFrame(
        [
            (201, 300.0, 310.0, 1100, 56.0, "L"),
            (200, 300.0, 310.1, 1200, 55.0, "L"),
            (180, 300.0, 310.0, 1199, 50.1, "M"),
            (None, None, 310.0, None, None, None),
        ],
        "tool_wear_min int, air_temperature_k double, process_temperature_k double, "
        "rotational_speed_rpm int, torque_nm double, machine_type string",
    )
    got = [tuple(r) for r in data.select(*flags(FAILURE_RULES)).collect()]
    assert got == [(1, 0, 1, 1, 1), (0, 1, 0, 0, 1), (0, 0, 0, 1, 0), (0, 0, 0, 0, 0)]


def test_schema_checks(spark):
    data = spark.range(1).withColumn("udi", F.lit(1))
    with pytest.raises(ValueError, match="missing columns: air_temperature_k, hdf"):
        conform(data.select("udi"), RAW)
    with pytest.raises(ValueError, match="not in the table: id"):
        conform(data.select("*", *[F.lit(1).alias(c) for c in RAW.names if c != "udi"]), RAW)
    with pytest.raises(ValueError, match="missing columns: a, b"):
        require_columns(data, ["b", "a", "id"])


def test_failure_columns(spark):
    names = ["twf", "hdf", "pwf", "osf", "rnf"]
    labels = spark.range(1).select(*[F.lit(1).alias(f"{n.upper()}_LABEL") for n in names])
    assert failure_columns(labels)["osf"] == "osf_label"
    assert failure_columns(labels.drop("RNF_LABEL"))["osf"] == "osf"


def test_custom_rule(spark):
    row = audit(rows(spark, VALID), rules=[Rule("hot", "air_temperature_k > 297")]).first()
    assert row.hot == 1 and row.quality_status == "FAIL"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    assert is_one_machine("local") and is_one_machine("local[4]")
    assert not is_one_machine("local-cluster[2,1,1024]") and not is_one_machine("spark://host:7077")
