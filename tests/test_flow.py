"""Files, streams and whole runs."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wearline.operators import serving
from wearline.operators.control import Marks
from wearline.operators.quality import CAST_REASON, audit
from wearline.plans.medallion import Config, Lakehouse
from wearline.schemas import (
    BRONZE,
    FAILURES,
    HEADERS,
    QUARANTINE,
    RAW_COLUMNS,
    SILVER,
    TEXT_BRONZE,
    with_labels,
)
from wearline.session import as_ts, scratch
from wearline.sources import files
from wearline.sources.files import append_bronze, read_bronze, read_raw, separator_of
from wearline.sources.tables import VersionedTable
from wearline.streaming import ingest

DAY1, DAY2 = "2026-04-02 08:00:00", "2026-04-03 08:00:00"
# A raw sensor file may be named here; it is not part of this repository.
SENSOR_FILE = os.environ.get("SENSOR_FILE", "")
HEADER = ",".join(HEADERS)


def write_files(tmp_path, name, *lines, header=HEADER, bom=True):
    folder = tmp_path / "landing"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\r\n".join([header, *lines]) + "\r\n"
    (folder / name).write_bytes(("\ufeff" if bom else "").encode() + text.encode())
    return str(folder)


def line(udi, product="P1", kind="L", torque="40.5", wear="10"):
    return f"{udi},{product},{kind},298.1,308.6,1551,{torque},{wear},0,0,0,0,0,0"


def test_read_raw_drops_the_mark_and_keeps_types(spark, tmp_path):
    folder = write_files(tmp_path, "a.csv", line(1), line(2, product=""))
    got = read_raw(spark, folder, DAY1)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE]
    rows = got.orderBy("udi").collect()
    assert (rows[0].product_id, rows[0].torque_nm, rows[1].product_id) == ("P1", 40.5, None)
    assert rows[0].source_file.endswith("a.csv") and str(rows[0].ingestion_date) == "2026-04-02"


def test_separator_is_found_or_all_causes_are_given(spark, tmp_path):
    folder = write_files(tmp_path, "a.csv", line(1).replace(",", ";"), header=HEADER.replace(",", ";"))
    assert separator_of(spark, folder) == ";"
    assert read_raw(spark, folder, DAY1, sep=None).first().tool_wear_min == 10
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="separator ',': missing .*separator ';': missing"):
        separator_of(spark, str(tmp_path / "bad"))


def test_wrong_header_or_type_fails(spark, tmp_path):
    folder = write_files(tmp_path, "a.csv", line("x"), bom=False)
    with pytest.raises(Exception, match="(?i)malformed|cannot be parsed|FAILFAST"):
        read_raw(spark, folder, DAY1).collect()


def test_stream_equals_batch_and_sees_files_once(spark, tmp_path):
    paths = {n: scratch(spark, n) for n in ("bronze", "checkpoint", "schema")}
    folder = write_files(tmp_path, "a.csv", line(1), line(2, torque="n/a"), bom=False)

    def drain():
        stream = ingest.stream_files(spark, folder, files_per_batch=1)
        ingest.drain_to_bronze(stream, paths["bronze"], paths["checkpoint"], as_ts(DAY1), paths["schema"])
        return read_bronze(spark, paths["bronze"], schema=None, merge=True)

    assert drain().count() == 2
    assert drain().count() == 2
    write_files(tmp_path, "b.csv", line(3), bom=False)
    write_files(tmp_path, "c.csv", line(4) + ",north", header=HEADER + ",site", bom=False)
    rows = {r.udi: r for r in drain().collect()}
    assert sorted(rows) == ["1", "2", "3", "4"] and rows["2"].torque_nm == "n/a"
    assert (rows["4"].site, rows["3"].site, rows["1"].site) == ("north", None, None)
    assert len(ingest.stored_schema(spark, paths["schema"])) == len(RAW_COLUMNS) + 1


def test_stream_reads_each_file_by_its_header(spark, tmp_path):
    names = HEADER.split(",")
    values = line(1).split(",")
    turned = ",".join(["site", *names[::-1]]), ",".join(["north", *values[::-1]])
    write_files(tmp_path, "a.csv", turned[1], header=turned[0], bom=False)
    short = ",".join(names[1:]), ",".join(values[1:])
    folder = write_files(tmp_path, "b.csv", short[1], header=short[0])
    bronze = scratch(spark, "bronze")
    ingest.drain_to_bronze(ingest.stream_files(spark, folder), bronze, scratch(spark, "checkpoint"))
    rows = {r.udi: r for r in read_bronze(spark, bronze, merge=True).collect()}
    assert set(rows) == {"1", None} and rows["1"].site == "north"
    assert {r.product_id for r in rows.values()} == {"P1"} and {r.torque_nm for r in rows.values()} == {"40.5"}
    bad = write_files(tmp_path / "bad", "c.csv", "1,2", header="a,b", bom=False)
    with pytest.raises(Exception, match="cannot read"):
        ingest.drain_to_bronze(ingest.stream_files(spark, bad), bronze, scratch(spark, "checkpoint"))


def test_late_and_equal_run_times_lose_nothing(spark, tmp_path):
    house = Lakehouse(spark, Config(scratch(spark, "lake"), cluster=False))
    for n, day in enumerate((DAY2, DAY2, DAY1), 1):
        house.ingest(write_files(tmp_path / str(n), "a.csv", line(n)), day)
        house.to_silver(day)
    assert sorted(r.udi for r in house.silver.read().collect()) == [1, 2, 3]
    times = [r._commit_timestamp for r in house.silver.history().orderBy("_commit_version").collect()]
    assert times == sorted(times)


def test_an_unfinished_ingest_is_not_seen_and_is_replaced(spark):
    path = scratch(spark, "bronze")
    rows = spark.range(2).selectExpr("id", "DATE'2024-01-01' ingestion_date")
    assert append_bronze(rows, path, "w", 7) == 0
    rows.write.parquet(f"{path}/ingest_no=1/ingestion_date=2024-01-01")
    assert read_bronze(spark, path, schema=None).count() == 2
    assert append_bronze(rows, path, "w", 7) == 0 and append_bronze(rows.limit(1), path, "w", 8) == 1
    assert read_bronze(spark, path, schema=None).count() == 3


def test_streamed_rejects_go_to_quarantine(spark, tmp_path):
    silver = VersionedTable(spark, scratch(spark, "silver"), SILVER, ["udi"])
    refused = VersionedTable(spark, scratch(spark, "refused"), QUARANTINE, ["raw_payload", "error_reason"])
    landing = write_files(tmp_path, "a.csv", line(1), line(2, torque="n/a"), bom=False)
    ts = as_ts(DAY1)
    ingest.drain_to_table(
        ingest.stream_files(spark, landing), silver, lambda b: ingest.newest_silver(b, ts), ts,
        scratch(spark, "checkpoint"), "silver", refused,
    )
    assert [r.udi for r in silver.read().collect()] == [1]
    assert refused.read().first().error_reason == CAST_REASON


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two runs: machines 1-3 and one reject, then machine 2 again and machine 4."""
    tmp = tmp_path_factory.mktemp("lake")
    house = Lakehouse(spark, Config(scratch(spark, "lake"), stale="recompute", snapshot_every=2))
    house.run(write_files(tmp, "a.csv", line(1), line(2), line(3, wear="201"), line(5, kind="")), DAY1)
    tmp = tmp_path_factory.mktemp("lake")
    house.run(write_files(tmp, "b.csv", line(2, torque="60"), line(4, product="P2")), DAY2)
    return house


def test_second_run_merges_only_what_is_new(lake):
    assert sorted(r.udi for r in lake.silver.read().collect()) == [1, 2, 3, 4]
    assert {r.udi for r in lake.silver.changes(1).collect()} == {2, 4}
    assert lake.quarantine.read().count() == 1
    assert '"udi":5' in lake.quarantine.read().first().raw_payload


def test_gold_follows(lake):
    features = {r.udi: r for r in lake.features.read().collect()}
    assert features[2].torque_nm == 60.0 and features[2].twf_label == 0
    days = {(r.product_id, str(r.event_date)): r.total_registros for r in lake.daily.read().collect()}
    assert days == {("P1", "2026-04-02"): 2, ("P1", "2026-04-03"): 1, ("P2", "2026-04-03"): 1}
    made = {r.udi: (r.pred_twf, r.pred_pwf, r.pred_rnf) for r in lake.predictions.read().collect()}
    assert made == {1: (0, 0, 0), 2: (0, 1, 0), 3: (1, 0, 1), 4: (0, 0, 0)}


def test_marks_audits_and_history(lake):
    assert lake.mark("gold_from_silver_cdf") == 1
    audits = lake.quality_audit().orderBy("audit_ts").collect()
    assert [(r.total_rows, r.quality_status) for r in audits] == [(3, "PASS"), (4, "PASS")]
    counts = lake.silver.history().orderBy("_commit_version").collect()
    assert [(r.rows_inserted, r.rows_updated) for r in counts] == [(3, 0), (1, 1)]
    past = {r.udi: r.torque_nm for r in lake.silver.read_at(DAY1).collect()}
    assert past == {1: 40.5, 2: 40.5, 3: 40.5}


def test_run_without_new_silver_changes_nothing(lake):
    before = lake.features.last_version(), lake.daily.last_version()
    lake.to_gold(DAY2)
    assert (lake.features.last_version(), lake.daily.last_version()) == before


def test_clustered_copy_with_later_changes_is_the_table(lake):
    for name in ("silver", "features", "predictions"):
        table = getattr(lake, name).read()
        copy = lake.read_clustered(name)
        assert copy.columns == table.columns
        assert sorted(map(str, copy.collect())) == sorted(map(str, table.collect()))


def test_only_the_start_of_a_file_is_read_for_its_header(spark, tmp_path, monkeypatch):
    taken = []
    own = files._first_line

    for n in range(5):
        write_files(tmp_path, f"{n}.csv", *[line(i) for i in range(20_000)], header=HEADER if n else HEADER + ",more", bom=n == 1)
    folder = write_files(tmp_path, "none.csv")
    (tmp_path / "landing" / "empty.csv").write_bytes(b"")
    heads = files.header_lines(spark, folder)
    assert [h.lstrip("\ufeff") for p, h in heads] == [HEADER + ",more", *[HEADER] * 5]
    # A task hands out one line and asks for no second batch.
    batch = pa.RecordBatch.from_pydict({"value": ["h", "1", "2"], "source_file": ["f"] * 3, "start": [0] * 3})

    def batches():
        for _ in range(3):
            taken.append(1)
            yield batch

    assert [b.to_pydict() for b in own(batches())] == [{"source_file": ["f"], "value": ["h"]}] and len(taken) == 1
    # Files that share a partition are found all the same.
    small = write_files(tmp_path / "small", "a.csv", line(1))
    for n in range(6):
        write_files(tmp_path / "small", f"b{n}.csv", line(n))
    monkeypatch.setattr(type(spark.conf), "set", lambda *_: None)
    assert len(files.header_lines(spark, small)) == 7


def test_rows_by_header_are_one_plan(spark, tmp_path):
    names, values = HEADER.split(","), line(7).split(",")
    wanted = dict(zip(names, values))
    for n in range(30):
        order = sorted(names, key=lambda c: hash((n, c)))
        extra = [f"x{n % 3}"]
        write_files(tmp_path, f"{n:02}.csv", ",".join([*[wanted[c] for c in order], f'"a,{n}"']), "", "1,2", header=",".join(order + extra), bom=n % 2 == 0)
    folder = write_files(tmp_path, "99.csv")
    heads = files.header_lines(spark, folder)
    rows = files.rows_by_header(spark, heads)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    got = [r for r in rows.collect() if r.rnf is not None and r.udi is not None]
    assert len(got) == 30 and all(r.asDict()[HEADERS[c]] == v for r in got for c, v in wanted.items())
    assert sorted(r.x0 or r.x1 or r.x2 for r in got) == sorted(f"a,{n}" for n in range(30))
    assert rows.count() == 60


def test_gold_follows_a_stream_of_commits(spark, tmp_path):
    house = Lakehouse(spark, Config(scratch(spark, "lake"), stale="recompute", cluster=False))
    state = str(tmp_path / "checkpoint")
    house.stream_gold(state, DAY1)
    assert house.features.last_version() == -1
    days = {}
    for n, (day, lines) in enumerate([(DAY1, [line(1), line(2), line(3, wear="201")]), (DAY2, [line(2, torque="60"), line(4, product="P2")])]):
        house.ingest(write_files(tmp_path / str(n), "a.csv", *lines), day)
        house.to_silver(day)
        house.stream_gold(state, day)
        days = {(r.product_id, str(r.event_date)): r.total_registros for r in house.daily.read().collect()}
    assert days == {("P1", "2026-04-02"): 2, ("P1", "2026-04-03"): 1, ("P2", "2026-04-03"): 1}
    versions = lambda: [t.last_version() for t in (house.features, house.daily_state, house.daily, house.predictions)]
    before = versions()
    # The batch is not marked as done: it is handed over again.
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    house.stream_gold(state, DAY2)
    assert versions() == before == [1, 1, 1, 1] and house.mark("gold_from_silver_cdf") == 1
    # A run that ended before the mark was moved is done again, and adds nothing twice.
    house.control = Marks(spark, scratch(spark, "marks"))
    house.to_gold(DAY2)
    again = {(r.product_id, str(r.event_date)): r.total_registros for r in house.daily.read().collect()}
    assert again == days and house.mark("gold_from_silver_cdf") == 1
    assert {r.udi for r in house.predictions.read().collect()} == {1, 2, 3, 4}


def test_a_state_that_fell_behind_takes_up_all_it_missed(spark, tmp_path):
    house = Lakehouse(spark, Config(scratch(spark, "lake"), stale="recompute", cluster=False))
    house.run(write_files(tmp_path / "a", "a.csv", line(1), line(2)), DAY1)
    kept, house.daily_state = house.daily_state, VersionedTable(spark, scratch(spark, "state"), house.daily_state.schema, house.daily_state.keys, null_keys=False)
    house.run(write_files(tmp_path / "b", "b.csv", line(1, torque="50"), line(2, torque="60")), DAY2)
    rows = [(str(r.event_date), r.total_registros, r.avg_torque_nm) for r in house.daily.read().collect()]
    assert rows == [("2026-04-03", 2, 55.0)] and kept.last_version() == 0


def test_streamed_text_goes_through_the_gate(spark, tmp_path):
    house = Lakehouse(spark, Config(scratch(spark, "lake"), TEXT_BRONZE, cluster=False))
    landing = write_files(tmp_path, "a.csv", line(1), line(2, torque="n/a"), bom=False)
    house.ingest_stream(landing, scratch(spark, "checkpoint"))
    house.process(DAY1)
    assert [r.udi for r in house.features.read().collect()] == [1]
    assert house.quarantine.read().first().error_reason == CAST_REASON


def test_views_serve_sql(lake, spark):
    assert "lk_silver_changes" in lake.register_views("lk_")
    row = spark.sql(
        "SELECT count(*) n FROM lk_silver_changes s JOIN lk_predictions p ON s.udi = p.udi "
        "WHERE s._change_type IN ('insert', 'update_postimage') AND p.pred_pwf = ?",
        args=[1],
    ).first()
    assert row.n == 2


def test_train_and_score_go_beside_the_rules(lake, spark):
    path = scratch(spark, "model")
    assert lake.train(path, rounds=1, depth=1).count() == 5
    lake.score(path, DAY2)
    models = lake.predictions.read().groupBy("model_name").count()
    assert {r[0]: r[1] for r in models.collect()} == {"baseline_rule_engine": 4, "gbt_multioutput": 4}


def test_enforcing_run_fails_on_a_bad_value(spark, tmp_path):
    house = Lakehouse(spark, Config(scratch(spark, "lake"), quality="enforce"))
    house.ingest(write_files(tmp_path, "a.csv", line(1, torque="-3")), DAY1)
    with pytest.raises(Exception, match="row breaks rule invalid_torque_rows"):
        house.to_silver(DAY1)
    assert house.silver.last_version() == -1


@pytest.mark.skipif(not os.path.exists(SENSOR_FILE), reason="SENSOR_FILE names no file")
def test_numbers_of_the_sensor_file(spark):
    rows = read_raw(spark, SENSOR_FILE, DAY1)
    check = audit(rows).first()
    assert (check.total_rows, check.quality_status) == (10_000, "PASS")
    data = with_labels(rows)
    from wearline.functions.rules import FAILURE_RULES, flags

    flagged = rows.select(*flags(FAILURE_RULES))
    totals = flagged.agg(*[F.sum(f) for f in FAILURES]).first()
    assert tuple(totals) == (762, 4463, 608, 4, 1025)
    assert flagged.filter(" OR ".join(f"{f} = 1" for f in FAILURES)).count() == 5503
    risk = serving.risk(serving.health(data)).first()
    assert (round(risk.avg_tool_wear, 3), risk.max_tool_wear) == (107.951, 253)
    assert risk.risk_score == pytest.approx(42.668379446640316, abs=1e-9)
    assert serving.heat(data).count() == 8240
    ones = {r.failure_type: r.total_failures for r in serving.failure_distribution(data).collect()}
    assert ones == {"TWF": 46, "HDF": 115, "PWF": 95, "OSF": 98, "RNF": 19}
