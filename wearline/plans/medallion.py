"""The whole flow: raw files -> Bronze -> Silver -> quality -> Gold -> marks -> layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions.rules import QUALITY_RULES
from wearline.operators import gold, learn
from wearline.operators.changes import VERSION, apply_changes, new_images
from wearline.operators.control import GOLD_FLOW, Marks, mark_of
from wearline.operators.layout import gridded
from wearline.operators.quality import (
    audit_rows,
    enforce,
    quarantine_rows,
    silver_rows,
    split_valid,
    with_event_time,
)
from wearline.operators.upsert import latest_per_key
from wearline.schemas import (
    AUDIT,
    BRONZE,
    DAILY,
    DAILY_STATE,
    FEATURES,
    GROUP_KEYS,
    PREDICTION_KEYS,
    PREDICTIONS,
    QUARANTINE,
    SILVER,
    conform,
    with_labels,
)
from wearline.session import Moment, as_ts, no_rows, pin
from wearline.sources.files import (
    INGEST_NO,
    append_bronze,
    ingests,
    read_bronze,
    read_raw,
    replace,
)
from wearline.sources.tables import VersionedTable
from wearline.streaming import ingest
from wearline.streaming.ingest import drain

# Name of the flow that reads Bronze, and the clustering columns per table.
SILVER_FLOW = "silver_from_bronze"
CLUSTERING = {
    "silver": ["product_id", "log_ts"],
    "features": ["product_id", "event_date"],
    "predictions": ["product_id", "prediction_ts"],
}

_COPIES = T.StructType([T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class Config:
    """Where the flow keeps its tables and which of its choices are taken.

    ``quality`` is "audit" (count violations) or "enforce" (fail the load on one).
    ``silver_source`` is "new" (Bronze rows above the mark) or "all" (merge Bronze whole).
    ``stale`` is "keep" or "recompute", for groups that rows have left. ``bronze_schema`` holds
    for batch loads and streams alike: with ``BRONZE`` a value of the wrong type fails the
    load, with ``TEXT_BRONZE`` it is kept as text and goes to the quarantine later.
    """

    root: str
    bronze_schema: T.StructType = field(default_factory=lambda: BRONZE)
    quality: str = "audit"
    silver_source: str = "new"
    stale: str = "keep"
    skip_unchanged: bool = False
    snapshot_every: int = 64
    cluster: bool = True
    separator: str | None = ","


class Lakehouse:
    """The tables of one flow and its steps; each step can be run on its own."""

    def __init__(self, spark: SparkSession, config: Config) -> None:
        self.spark, self.config = spark, config
        root, every = config.root.rstrip("/"), config.snapshot_every
        self.root = root

        def keyed(name, schema, keys, partition_by=(), null_keys=False):
            path = f"{root}/{name}"
            return VersionedTable(
                spark, path, schema, keys, every, partition_by=partition_by, null_keys=null_keys
            )

        self.bronze = f"{root}/bronze"
        self.audits = f"{root}/quality_audit"
        self.silver = keyed("silver", SILVER, ["udi"], null_keys=True)
        self.quarantine = keyed("quarantine", QUARANTINE, ["raw_payload", "error_reason"])
        self.features = keyed("features", FEATURES, ["udi"], ["event_date"], null_keys=True)
        self.daily = keyed("daily", DAILY, GROUP_KEYS, ["event_date"])
        self.predictions = keyed("predictions", PREDICTIONS, PREDICTION_KEYS)
        self.daily_state = keyed("daily_state", DAILY_STATE, GROUP_KEYS, ["event_date"])
        self.control = Marks(spark, f"{root}/control")

    # -- marks -----------------------------------------------------------------

    def mark(self, name: str) -> int:
        return mark_of(self.control.read(), name).first()[0]

    # -- steps -----------------------------------------------------------------

    def ingest(self, source: str, run_ts: Moment = None) -> None:
        rows = read_raw(self.spark, source, run_ts, self.config.separator)
        append_bronze(conform(rows, self.config.bronze_schema), self.bronze)

    def new_bronze(self) -> tuple[DataFrame, DataFrame]:
        """Bronze rows to merge, and the mark that covers them.

        The mark is the number of the last ingest merged. Numbers only grow, whatever the run
        times, so nothing that is added later lies below it; ingests that finish meanwhile are
        left to the next run. Only the folders above the mark are read.
        """
        low = self.mark(SILVER_FLOW) if self.config.silver_source == "new" else -1
        high = ingests(self.spark, self.bronze).agg(F.max(INGEST_NO)).first()[0]
        done = self.spark.range(1).select(F.lit(high).cast("bigint").alias(VERSION))
        if high is None:
            return no_rows(self.spark, self.config.bronze_schema).drop("ingestion_date"), done
        bronze = read_bronze(self.spark, self.bronze, self.config.bronze_schema)
        rows = bronze.filter((F.col(INGEST_NO) > low) & (F.col(INGEST_NO) <= high))
        return rows.drop("ingestion_date", INGEST_NO), done

    def to_silver(self, run_ts: Moment = None) -> None:
        """Merge new Bronze rows into Silver; rows that are not valid go to quarantine."""
        config, run_ts = self.config, as_ts(run_ts)
        rows, done = self.new_bronze()
        valid, rejected = split_valid(rows)
        if config.quality == "enforce":
            valid = enforce(valid, QUALITY_RULES)
        newest = latest_per_key(valid, ["udi"], ["ingestion_ts"])
        self.silver.commit(
            silver_rows(newest, run_ts),
            run_ts,
            skip_unchanged=config.skip_unchanged,
            stamp_cols=["ingestion_ts", "source_file", "log_ts", "_silver_loaded_ts"],
            assume_unique=True,
        )
        self.quarantine.commit(
            quarantine_rows(rejected, run_ts), run_ts, ["_quarantine_ts"], assume_unique=True
        )
        self.control.advance(SILVER_FLOW, done, run_ts)

    def check_quality(self, run_ts: Moment = None) -> None:
        audit_rows(self.silver.read(), as_ts(run_ts)).write.mode("append").parquet(self.audits)

    def quality_audit(self) -> DataFrame:
        return self.spark.read.schema(AUDIT).parquet(self.audits)

    def to_gold(self, run_ts: Moment = None) -> None:
        """Bring features, daily aggregates and rule predictions up to the newest Silver.

        The range of versions is fixed at the start, so a Silver commit made meanwhile is
        neither half processed nor marked as done.
        """
        self._gold_up_to(self.silver.last_version(), as_ts(run_ts))

    def stream_gold(self, checkpoint: str, run_ts: Moment = None) -> None:
        """Let Gold follow the Silver commits that have come since the last drain, then stop.

        The stream is of finished commits, so a commit that failed half-way is never seen; each
        micro-batch reads the change folders of its versions only. The mark goes up with the
        batch, and every table refuses a range that it has committed, so a batch that is
        replayed, or a step of one that was cut short, changes nothing twice. Batch runs and
        streams share the mark and may take turns.
        """
        if self.silver.last_version() < 0:
            return

        def follow(batch: DataFrame, _: int) -> None:
            high = batch.agg(F.max(VERSION)).first()[0]
            if high is not None:
                self._gold_up_to(high, as_ts(run_ts))

        drain(self.silver.commits_stream(), checkpoint, follow)

    def _gold_up_to(self, high: int, run_ts: Column) -> None:
        low = self.mark(GOLD_FLOW)
        if high <= low:
            return
        feed = self.silver.changes(low + 1, high)
        stamp = {"writer": GOLD_FLOW, "batch": high}
        version = self.features.commit(gold.feature_rows(feed, run_ts), run_ts, assume_unique=True, **stamp)
        self._refresh_daily(feed, version, run_ts, stamp)
        # The features of the changed machines are the images just committed, so the feature
        # table is not read again to find them. Rows without a machine are not predicted.
        changed = new_images(self.features.changes(version, version)).filter(F.col("udi").isNotNull())
        self.predictions.commit(gold.rule_predictions(changed, run_ts), run_ts, assume_unique=True, **stamp)
        self.control.advance(GOLD_FLOW, self.spark.range(1).select(F.lit(high).cast("bigint").alias(VERSION)), run_ts)

    def _refresh_daily(self, feed: DataFrame, version: int, run_ts: Column, stamp: dict) -> None:
        """Daily aggregates of the affected groups, from the groups' state.

        The state takes up the feature changes of the versions it has not seen, so it is made from
        the whole log where there is none yet, and no feature row is read again after that.
        """
        seen = self.daily_state.last_batch(GOLD_FLOW)
        if version > seen:
            delta = pin(gold.daily_changes(self.features.changes(seen + 1, version)), path=f"{self.root}/work/delta")
            merged = pin(gold.merged_state(self.daily_state.read(), delta), path=f"{self.root}/work/merged")
            self.daily_state.commit(
                merged.filter("n > 0"),
                run_ts,
                assume_unique=True,
                gone=merged.filter("n = 0"),
                writer=GOLD_FLOW,
                batch=version,
            )
        groups = pin(gold.affected_groups(feed, self.config.stale), path=f"{self.root}/work/groups")
        state = self.daily_state.read().join(groups, GROUP_KEYS, "left_semi")
        refreshed = pin(gold.daily_of(state), path=f"{self.root}/work/refreshed")
        gone = gold.emptied_groups(groups, refreshed) if self.config.stale == "recompute" else None
        self.daily.commit(gold.daily_rows(refreshed, run_ts), run_ts, assume_unique=True, gone=gone, **stamp)

    def train(self, model_path: str, **settings) -> DataFrame:
        """Fit the five models on the feature table, save them, and return F1 per label."""
        rows = self.features.read()
        train, test = learn.stratified_split(rows, "machine_failure", "udi")
        model = learn.fit(train, **settings)
        learn.save(model, model_path)
        return pin(learn.evaluate(model, test), path=f"{model_path.rstrip('/')}_metrics")

    def score(self, model_path: str, run_ts: Moment = None) -> int:
        """Merge predictions of the saved models for every feature row."""
        run_ts = as_ts(run_ts)
        rows = self.features.read().filter(F.col("udi").isNotNull())
        scored = learn.score(learn.load(model_path), rows, run_ts)
        return self.predictions.commit(scored, run_ts, assume_unique=True)

    def register_views(self, prefix: str = "") -> list[str]:
        """Temporary views for SQL: each table, and ``<table>_changes`` for its feed."""
        tables = ["silver", "quarantine", "features", "daily", "predictions"]
        self.control.read().createOrReplaceTempView(f"{prefix}control")
        names = [f"{prefix}control"]
        for name in tables:
            table: VersionedTable = getattr(self, name)
            for view, rows in ((name, table.read()), (f"{name}_changes", table.changes())):
                rows.createOrReplaceTempView(prefix + view)
                names.append(prefix + view)
        return names

    def cluster(self, name: str, files: int | None = None, force: bool = False) -> bool:
        """Write a clustered copy of a table for readers; the table gets no new version.

        A copy is made when the table has a snapshot newer than the last copy, so it is
        rewritten as seldom as the snapshots are; ``force`` makes one of the newest state.
        """
        table: VersionedTable = getattr(self, name)
        version = table.last_version() if force else table.snapshot_version()
        if version <= self._clustered_version(name):
            return False
        rows = gridded(table.read(version), CLUSTERING[name], files)
        rows.write.mode("overwrite").parquet(f"{self.root}/clustered/{name}/version={version}")
        done = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
        done.write.mode("append").parquet(f"{self.root}/clustered/{name}_copies")
        return True

    def _clustered_version(self, name: str) -> int:
        try:
            copies = self.spark.read.schema(_COPIES).parquet(f"{self.root}/clustered/{name}_copies")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1
        return copies.agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]

    def read_clustered(self, name: str) -> DataFrame:
        """Newest state of a table: its clustered copy with the later changes applied."""
        table: VersionedTable = getattr(self, name)
        version = self._clustered_version(name)
        if version < 0:
            return table.read()
        path = f"{self.root}/clustered/{name}/version={version}"
        copy = self.spark.read.schema(table.schema).parquet(path)
        if version == table.last_version():
            return copy
        return apply_changes(copy, table.changes(version + 1), table.keys, table.null_keys)

    def ingest_stream(self, landing: str, checkpoint: str, run_ts: Moment = None) -> None:
        """Append the CSV files that have arrived in ``landing`` to Bronze, by their headers.

        They go to the same numbered folders as batch loads, as the same column types; further
        columns are kept beside the declared ones.
        """
        kinds = {f.name: f.dataType for f in self.config.bronze_schema}

        def prepare(rows: DataFrame) -> DataFrame:
            return rows.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in rows.columns])

        ingest.drain_to_bronze(
            ingest.stream_files(self.spark, landing),
            self.bronze,
            checkpoint,
            None if run_ts is None else as_ts(run_ts),
            f"{self.root}/stream_schema",
            prepare,
        )

    def load_features(self, source: str, path: str, run_ts: Moment = None) -> None:
        """Reload a plain feature table straight from raw files, dated by the run time."""
        rows = read_raw(self.spark, source, run_ts, self.config.separator)
        columns = [c for c in FEATURES.names if c != "_gold_loaded_ts"]
        replace(with_labels(with_event_time(rows)).select(*columns), path)

    def process(self, run_ts: Moment = None) -> None:
        """Everything behind Bronze."""
        run_ts = as_ts(run_ts)
        self.to_silver(run_ts)
        self.check_quality(run_ts)
        if self.config.cluster:
            self.cluster("silver")
        self.to_gold(run_ts)
        if self.config.cluster:
            self.cluster("features")
            self.cluster("predictions")

    def run(self, source: str, run_ts: Moment = None) -> None:
        """One whole run over the raw files below ``source``."""
        run_ts = as_ts(run_ts)
        self.ingest(source, run_ts)
        self.process(run_ts)
