"""Raw sensor files in, append-only Bronze out."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.schemas import BRONZE, HEADERS, RAW_FILE, conform, snake_case
from wearline.session import Moment, as_ts, no_rows

SEPARATORS = [",", ";", "\t", "|"]


def text_schema(extra: Sequence[str] = ()) -> T.StructType:
    """The raw header with every column as text, plus columns added at its end."""
    names = [*HEADERS, *extra]
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def with_arrival(df: DataFrame, run_ts: Column) -> DataFrame:
    """Ingestion columns. ``df`` carries ``source_file`` from its scan."""
    return df.withColumns({"ingestion_ts": run_ts, "log_ts": run_ts}).withColumn(
        "ingestion_date", F.to_date("ingestion_ts")
    )


def header_lines(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, str]]:
    """(file, first line) of every file that has one, reading no more than the start of each.

    Every file begins a partition of its own, and a task stops after its first lines, so the
    reader never gets to the rest of a file. Files that lie together in a partition all the same
    are read again on their own. The driver gets a row per file: callers hand over one file, or
    as many as a micro-batch has at most.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    left = {row[0] for row in spark.read.format("binaryFile").load(paths).select("_metadata.file_path").collect()}
    found: dict[str, str] = {}
    while left:
        lines = apart.read.text(sorted(left)).select(
            "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start")
        )
        heads = lines.mapInArrow(_first_line, "source_file string, value string").collect()
        if not heads:
            # The rest has no line at all.
            break
        found |= {row.source_file: row.value for row in heads}
        left -= found.keys()
    return sorted(found.items())


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows and batch.column("start")[0].as_py() == 0:
            yield batch.slice(0, 1).select(["source_file", "value"])
        if batch.num_rows:
            return


def separator_of(spark: SparkSession, path: str) -> str:
    """The separator that splits the first line of all files into the raw header."""
    found = {_separator(header, path) for _, header in header_lines(spark, path)}
    if len(found) != 1:
        raise ValueError(f"cannot read {path}: its files have {len(found)} different separators")
    return found.pop()


def rows_by_header(spark: SparkSession, headers: list[tuple[str, str]], sep: str = ",") -> DataFrame:
    """Rows of CSV files, all as text, their columns found by each file's own header.

    One scan and one plan for all files: the lines are split once, and the header of a line's file,
    a broadcast map of names to places, says which part is which column. The plan grows with the
    number of different columns only. Lines equal to their file's header are headers too.
    """
    names: dict[str, None] = {}
    rows, width = [], 1
    for path, header in headers:
        line = header.lstrip("\ufeff").rstrip("\r")
        own = [HEADERS.get(n.strip(), n.strip()) for n in next(csv.reader([line], delimiter=sep), [])]
        if len(set(own)) < len(own) or not set(own) & set(HEADERS.values()):
            raise ValueError(f"cannot read {path}: its header is {line!r}")
        names |= dict.fromkeys(own)
        width = max(width, len(own))
        rows.append((path, header, {n: i for i, n in enumerate(own)}))
    table = spark.createDataFrame(rows, "source_file string, header string, places map<string,int>")
    lines = spark.read.text([path for path, _ in headers]).select("value", F.col("_metadata.file_path").alias("source_file"))
    parts = ", ".join(f"c{i} string" for i in range(width))
    split = F.from_csv(F.rtrim(F.col("value"), F.lit("\r")), parts, {"sep": sep})
    known = lines.join(F.broadcast(table), "source_file").filter((F.col("value") != F.col("header")) & (F.trim("value") != ""))
    fields = known.withColumn("fields", split).select(
        "source_file", "places", F.array(*[F.col("fields")[f"c{i}"] for i in range(width)]).alias("fields")
    )
    # A column that a file lacks has no place, and a place beyond the line no value.
    value = lambda n: F.get("fields", F.col("places")[n])
    return fields.select(*[value(n).alias(n) for n in names], "source_file")


def _separator(line: str | None, path: str) -> str:
    header = (line or "").lstrip("\ufeff").rstrip("\r")
    tried = []
    for sep in SEPARATORS:
        lacking = sorted(set(HEADERS) - {h.strip('"') for h in header.split(sep)})
        if not lacking:
            return sep
        tried.append(f"separator {sep!r}: missing {', '.join(lacking)}")
    raise ValueError(f"cannot read {path}: " + " | ".join(tried))


def read_raw(
    spark: SparkSession, path: str, run_ts: Moment = None, sep: str | None = ","
) -> DataFrame:
    """Typed Bronze rows of the raw CSV files below ``path``.

    The header is checked against the schema and a value of the wrong type fails the job.
    ``sep=None`` finds the separator from the first line.
    """
    rows = (
        spark.read.schema(RAW_FILE)
        .options(header=True, sep=sep or separator_of(spark, path))
        .options(enforceSchema=False, mode="FAILFAST")
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return conform(with_arrival(snake_case(rows), as_ts(run_ts)), BRONZE)


INGEST_NO = "ingest_no"
INGESTS = T.StructType(
    [
        T.StructField(INGEST_NO, T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


def ingests(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished ingest of a Bronze folder."""
    try:
        return spark.read.schema(INGESTS).parquet(f"{path.rstrip('/')}_ingests")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, INGESTS)


def append_bronze(df: DataFrame, path: str, writer: str | None = None, batch: int | None = None) -> int:
    """Add rows as the next numbered ingest of a Bronze folder; returns its number.

    Batch loads and streams write the same way, one writer at a time. A number counts once it
    is in the list of ingests, which is written last: what a failed ingest left is replaced by
    the next one. ``writer`` and ``batch`` name a stream's micro-batch; one that was finished
    before is left out.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    done = ingests(spark, path)
    mine = (F.col("writer") == F.lit(writer)) & (F.col("batch") == F.lit(batch))
    last, again = done.agg(F.max(INGEST_NO), F.max(F.when(mine, F.col(INGEST_NO)))).first()
    if writer is not None and again is not None:
        return again
    number = 0 if last is None else last + 1
    df.write.mode("overwrite").partitionBy("ingestion_date").parquet(f"{path}/{INGEST_NO}={number}")
    row = spark.range(1).select(
        F.lit(number).cast("bigint").alias(INGEST_NO),
        F.lit(writer).cast("string").alias("writer"),
        F.lit(batch).cast("bigint").alias("batch"),
    )
    row.write.mode("append").parquet(f"{path}_ingests")
    return number


def read_bronze(
    spark: SparkSession, path: str, schema: T.StructType | None = BRONZE, merge: bool = False
) -> DataFrame:
    """Bronze rows of finished ingests, with the ingest's number.

    A declared schema reads columns that older files lack as NULL; ``merge`` collects the
    columns from the files instead.
    """
    last = ingests(spark, path).agg(F.max(INGEST_NO)).first()[0]
    reader = spark.read
    if merge:
        reader = reader.option("mergeSchema", True)
    elif schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(INGEST_NO, T.LongType())]))
    return reader.parquet(path).filter(F.col(INGEST_NO) <= (-1 if last is None else last))


def replace(df: DataFrame, path: str) -> None:
    """Truncate and reload a plain table."""
    df.write.mode("overwrite").parquet(path)
