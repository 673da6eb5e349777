"""File stream into Bronze, and micro-batches merged into a keyed table."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.quality import quarantine_rows, silver_rows, split_valid
from wearline.operators.upsert import latest_per_key
from wearline.schemas import RAW, SILVER_INPUT
from wearline.session import no_rows, pin
from wearline.sources.files import (
    append_bronze,
    header_lines,
    rows_by_header,
    text_schema,
    with_arrival,
)
from wearline.sources.tables import VersionedTable


TEXT_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW])


def stored_schema(
    spark: SparkSession, location: str, extra: Sequence[str] = ()
) -> T.StructType:
    """Stream schema kept below ``location``; columns in ``extra`` are added at its end.

    The kept schema only grows: files written before a column came read it as NULL.
    """
    try:
        rows = spark.read.parquet(location)
        newest = rows.agg(F.max_by("schema", "size")).first()[0]
        known = T.StructType.fromJson(json.loads(newest))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    old = text_schema() if known is None else known
    grown = T.StructType(
        old.fields + [T.StructField(c, T.StringType()) for c in extra if c not in old.names]
    )
    if known is None or len(grown) > len(known):
        row = spark.range(1).select(
            F.lit(len(grown)).alias("size"), F.lit(grown.json()).alias("schema")
        )
        row.write.mode("append").parquet(location)
    return grown


# The columns of Spark's source of whole files. Only the names are read.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: Files of a micro-batch at most, so that the driver never gets more headers than that.
FILES_PER_BATCH = 1_000


def stream_files(spark: SparkSession, landing: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream of the CSV files that arrive in ``landing``: their names, not their contents.

    A micro-batch is turned into rows by ``rows_of``, which reads each file by its own header.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing).select(F.col("_metadata.file_path").alias("source_file"))


def rows_of(batch: DataFrame, sep: str = ",") -> DataFrame:
    """Rows of the files of a micro-batch, as text, their columns found by header.

    Files may have their columns in any order, lack some (read as NULL, so that the gate
    refuses the rows) or have more (kept). A header that repeats a column or knows none is an
    error: such a file cannot be told from one without a header. The headers are read from the
    files' starts, then all lines in one scan.
    """
    spark = batch.sparkSession
    paths = [row.source_file for row in batch.collect()]
    if paths:
        found = rows_by_header(spark, header_lines(spark, paths), sep)
    else:
        found = no_rows(spark, T.StructType([*TEXT_RAW.fields, T.StructField("source_file", T.StringType())]))
    lacking = [n for n in TEXT_RAW.names if n not in found.columns]
    return found.withColumns({n: F.lit(None).cast("string") for n in lacking})


def drain_to_bronze(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    run_ts: Column | None = None,
    kept: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append everything that has arrived as numbered ingests, then stop.

    The checkpoint remembers the files. Columns not seen before are added to the schema kept
    at ``kept``, and ``prepare`` gives the rows their final form.
    """

    def land(batch: DataFrame, number: int) -> None:
        now = F.lit(datetime.now(timezone.utc)) if run_ts is None else run_ts
        rows = with_arrival(rows_of(batch), now)
        if kept is not None:
            known = {*TEXT_RAW.names, "source_file", "ingestion_ts", "log_ts", "ingestion_date"}
            stored_schema(batch.sparkSession, kept, [c for c in rows.columns if c not in known])
        append_bronze(rows if prepare is None else prepare(rows), path, f"stream:{checkpoint}", number)

    drain(stream, checkpoint, land)


def drain_to_table(
    stream: DataFrame,
    table: VersionedTable,
    prepare: Callable[[DataFrame], DataFrame],
    ts: Column,
    checkpoint: str,
    writer: str,
    quarantine: VersionedTable | None = None,
) -> None:
    """Upsert every micro-batch. ``prepare`` makes table rows, one per key.

    Rows that are not valid go to ``quarantine``. The batch number goes into the commits, so
    that a batch replayed after a failure is not merged again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = pin(with_arrival(rows_of(batch), ts), "batch")
        table.commit(prepare(rows), ts, assume_unique=True, writer=writer, batch=number)
        if quarantine is not None:
            refused = quarantine_rows(split_valid(rows)[1], ts)
            quarantine.commit(refused, ts, ["_quarantine_ts"], assume_unique=True, writer=writer, batch=number)

    drain(stream, checkpoint, merge)


def drain(stream: DataFrame, checkpoint: str, take: Callable[[DataFrame, int], None]) -> None:
    """Hand everything that has arrived to ``take`` in micro-batches, then stop."""
    (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(take)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def newest_silver(batch: DataFrame, run_ts: Column, order: Sequence[str] = ("log_ts",)) -> DataFrame:
    """Valid rows of a raw micro-batch, the newest per machine, as Silver rows.

    The rest goes to the quarantine of ``drain_to_table``.
    """
    also = [c for c in order if c not in SILVER_INPUT.names]
    valid, _ = split_valid(batch, also=also)
    return silver_rows(latest_per_key(valid, ["udi"], list(order)), run_ts)
