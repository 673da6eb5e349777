"""Keyed tables kept as a change log with occasional snapshots, all plain parquet.

Below a table's path lie ``changes/_commit_version=N`` with the rows of commit N,
``state/version=N`` for the commits that were snapshot, and ``commits``, one row per
commit, appended last. A commit that failed half-way has no row there, so it is not seen,
and the next commit writes over it. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.changes import (
    AFTER,
    CHANGE,
    COMMIT_TS,
    DELETE,
    INSERT,
    VERSION,
    apply_changes,
    change_rows,
    deletions,
    new_images,
)
from wearline.schemas import conform
from wearline.session import Moment, as_ts, no_rows, pin

COMMITS = T.StructType(
    [
        T.StructField(VERSION, T.LongType()),
        T.StructField(COMMIT_TS, T.TimestampType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_deleted", T.LongType()),
        T.StructField("has_state", T.BooleanType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


class VersionedTable:
    """A table with upserts, a change feed and reads of past versions.

    ``null_keys=False`` promises that no row lacks a key. A snapshot is written once the
    changes since the last one reach ``snapshot_share`` of the table's rows, so rewriting the
    table costs a fixed multiple of the rows changed, but not before there are ``snapshot_rows``
    of them; or after ``snapshot_every`` commits.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        snapshot_every: int = 64,
        snapshot_share: float = 0.2,
        snapshot_rows: int = 1_000_000,
        partition_by: Sequence[str] = (),
        null_keys: bool = True,
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys = list(keys)
        self.snapshot_every, self.snapshot_share = snapshot_every, snapshot_share
        self.snapshot_rows = snapshot_rows
        self.partition_by, self.null_keys = list(partition_by), null_keys
        self._log_schema = T.StructType(
            [
                *schema.fields,
                T.StructField(CHANGE, T.StringType()),
                T.StructField(COMMIT_TS, T.TimestampType()),
                T.StructField(VERSION, T.LongType()),
            ]
        )

    # -- reading ---------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per commit; none where nothing was ever committed."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, COMMITS)

    def snapshot_version(self) -> int:
        """Version of the newest snapshot, -1 when there is none."""
        return self._heads()[1]

    def last_version(self) -> int:
        """Newest version, -1 before the first commit."""
        return self._heads()[0]

    def _heads(self, version: int | None = None) -> tuple[int, int]:
        """Newest version, and the newest snapshot at or below ``version``; -1 for none."""
        with_state = F.col("has_state")
        if version is not None:
            with_state = with_state & (F.col(VERSION) <= version)
        row = self.history().agg(F.max(VERSION), F.max(F.when(with_state, F.col(VERSION)))).first()
        return tuple(-1 if v is None else v for v in row)

    def version_at(self, ts: Moment) -> int:
        """Newest version committed at or before ``ts``; an earlier time is an error."""
        found = self.history().filter(F.col(COMMIT_TS) <= as_ts(ts)).agg(F.max(VERSION)).first()[0]
        if found is None:
            raise ValueError("the table has no version as old as the given time")
        return found

    def changes(self, start: int = 0, end: int | None = None) -> DataFrame:
        """Feed of versions ``start`` to ``end``; only the folders of these are read."""
        last = self.last_version()
        return self._changes(start, last if end is None else min(end, last))

    def _changes(self, start: int, end: int) -> DataFrame:
        start = max(start, 0)
        if end < start:
            return no_rows(self.spark, self._log_schema)
        rows = self.spark.read.schema(self._log_schema).parquet(f"{self.path}/changes")
        return rows.filter(F.col(VERSION).between(start, end))

    def read(self, version: int | None = None) -> DataFrame:
        """Table as of ``version`` (the newest by default).

        The closest snapshot at or below it, with the commits in between applied.
        """
        last, base = self._heads(version)
        if version is not None and not 0 <= version <= last:
            raise ValueError(f"version {version} is not in 0..{last}")
        return self._read(base, last if version is None else version)

    def _read(self, base: int, version: int) -> DataFrame:
        if version < 0:
            return no_rows(self.spark, self.schema)
        if base < 0:
            # The first commit holds inserts only, each key once.
            base, state = 0, new_images(self._changes(0, 0)).select(*self.schema.names)
        else:
            state = self._read_state(base)
        if base == version:
            return state
        return apply_changes(state, self._changes(base + 1, version), self.keys, self.null_keys)

    def read_at(self, ts: Moment) -> DataFrame:
        """Table as it stood at ``ts``."""
        return self.read(self.version_at(ts))

    def _read_state(self, version: int) -> DataFrame:
        path = f"{self.path}/state/version={version}"
        columns = [c for c in self.schema.names if c not in self.partition_by]
        stored = T.StructType(
            [self.schema[c] for c in columns] + [self.schema[c] for c in self.partition_by]
        )
        return self.spark.read.schema(stored).parquet(path).select(*self.schema.names)

    # -- writing ---------------------------------------------------------------

    def commit(
        self,
        source: DataFrame,
        ts: Moment = None,
        update_cols: Sequence[str] | None = None,
        skip_unchanged: bool = False,
        stamp_cols: Sequence[str] = (),
        assume_unique: bool = False,
        gone: DataFrame | None = None,
        writer: str | None = None,
        batch: int | None = None,
    ) -> int:
        """Upsert ``source`` and delete the keys in ``gone``; returns the new version.

        ``writer`` and ``batch`` name a stream's micro-batch: one that was committed
        before is left out, so a replayed batch changes nothing and gives its version again.
        """
        now = self._standing(writer, batch)
        if now["again"] is not None:
            return now["again"]
        # Commit times never fall: an older one is lifted to that of the last commit, so that every
        # version can be found by a time.
        ts = as_ts(ts) if now["newest"] is None else F.greatest(as_ts(ts), F.lit(now["newest"]))
        last, base = now["last"], now["base"]
        version = last + 1
        before, incoming = self._read(base, last), conform(source, self.schema)
        near = before
        if version > 0:
            incoming = self._stage(incoming)
            near = before.filter(self._key_range(incoming))
        rows = change_rows(
            near,
            incoming,
            self.keys,
            update_cols,
            skip_unchanged,
            stamp_cols,
            assume_unique,
            self.null_keys,
        )
        if gone is not None:
            # A key with a new image is not deleted by the same commit.
            gone = gone.select(*self.keys).join(incoming.select(*self.keys), self.keys, "left_anti")
            gone = pin(gone, "gone")
            rows = rows.unionByName(deletions(before.filter(self._key_range(gone)), gone, self.keys))
        counts = Observation()
        (
            rows.withColumn(COMMIT_TS, ts)
            .observe(
                counts,
                F.count_if(F.col(CHANGE) == INSERT).alias("inserted"),
                F.count_if(F.col(CHANGE) == AFTER).alias("updated"),
                F.count_if(F.col(CHANGE) == DELETE).alias("deleted"),
            )
            .write.mode("overwrite")
            .parquet(f"{self.path}/changes/{VERSION}={version}")
        )
        n = counts.get
        snapshot = self._snapshot_is_due(version, now, n)
        if snapshot:
            self._snapshot(before, version)
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias(VERSION),
            ts.alias(COMMIT_TS),
            F.lit(n["inserted"]).cast("bigint").alias("rows_inserted"),
            F.lit(n["updated"]).cast("bigint").alias("rows_updated"),
            F.lit(n["deleted"]).cast("bigint").alias("rows_deleted"),
            F.lit(snapshot).alias("has_state"),
            F.lit(writer).cast("string").alias("writer"),
            F.lit(batch).cast("bigint").alias("batch"),
        )
        row.write.mode("append").parquet(f"{self.path}/commits")
        return version

    def _stage(self, source: DataFrame) -> DataFrame:
        """Source rows written once: read several times below, and of known size to the
        planner, which broadcasts them when they are few."""
        path = f"{self.path}/staged"
        source.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def _key_range(self, source: DataFrame) -> Column:
        """Ranges of the first key and of the partition columns among the keys in ``source``:
        snapshots are sorted by key, so the scan of the target skips the files outside them."""
        columns = list(dict.fromkeys([self.keys[0], *[c for c in self.partition_by if c in self.keys]]))
        ends = source.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
        if None in ends:
            return F.lit(False)
        test = F.lit(True)
        for n, c in enumerate(columns):
            test = test & F.col(c).between(F.lit(ends[2 * n]), F.lit(ends[2 * n + 1]))
        return test

    def _standing(self, writer: str | None, batch: int | None) -> dict:
        """What a commit has to know of those before it, from one look at the history."""
        history = self.history()
        base = history.agg(F.max(F.when(F.col("has_state"), F.col(VERSION)))).scalar()
        since = F.when(F.col(VERSION) > F.coalesce(base, F.lit(-1)), F.col("rows_inserted") + F.col("rows_updated"))
        mine = (F.col("writer") == F.lit(writer)) & (F.col("batch") == F.lit(batch))
        row = history.agg(
            F.coalesce(F.max(VERSION), F.lit(-1)).alias("last"),
            F.coalesce(F.max(F.when(F.col("has_state"), F.col(VERSION))), F.lit(-1)).alias("base"),
            F.max(COMMIT_TS).alias("newest"),
            F.coalesce(F.sum(since), F.lit(0)).alias("changed"),
            F.coalesce(F.sum(F.col("rows_inserted") - F.col("rows_deleted")), F.lit(0)).alias("held"),
            F.max(F.when(mine, F.col(VERSION))).alias("again"),
        ).first()
        return row.asDict()

    def _snapshot_is_due(self, version: int, now: dict, counts: dict[str, int]) -> bool:
        if version - now["base"] >= self.snapshot_every:
            return True
        changed = now["changed"] + counts["inserted"] + counts["updated"]
        held = now["held"] + counts["inserted"] - counts["deleted"]
        return changed >= self.snapshot_rows and changed > self.snapshot_share * held

    def _snapshot(self, before: DataFrame, version: int) -> None:
        """Write the state after ``version``, sorted by key.

        Keys are unique but for NULL ones; a row hash spreads those over several files.
        """
        state = apply_changes(before, self._changes(version, version), self.keys, self.null_keys)
        if self.partition_by:
            state = state.hint("rebalance", *self.partition_by)
        else:
            state = state.repartitionByRange(*self.keys, F.xxhash64(*self.schema.names))
        writer = state.sortWithinPartitions(*self.partition_by, *self.keys).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/state/version={version}")

    def last_batch(self, writer: str) -> int:
        """The highest batch that ``writer`` has committed, -1 for none."""
        mine = self.history().filter(F.col("writer") == writer)
        return mine.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]

    def commits_stream(self) -> DataFrame:
        """The table's finished commits as a stream, a row each."""
        return self.spark.readStream.schema(COMMITS).parquet(f"{self.path}/commits")


def bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` written below ``path`` in ``buckets`` by key, each sorted, and read back as such: joins
    on the key need no exchange and no sort of this side, however large the other one is.

    A bucket is written by one task, so that it is one file; rows with a NULL key all lie in one.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
