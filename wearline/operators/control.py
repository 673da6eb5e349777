"""Progress marks: the last processed version of each named flow."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.changes import CHANGE, NEW_IMAGES, VERSION
from wearline.operators.upsert import insert_absent
from wearline.schemas import CONTROL, conform
from wearline.session import no_rows

# Flow name and the mark it starts from.
GOLD_FLOW = "gold_from_silver_cdf"
UNSTARTED = -1


class Marks:
    """Marks kept as a list that is only added to, one small file per step: a flow's mark is its
    highest one, so a step that is repeated changes nothing."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """The newest row of each flow."""
        try:
            rows = self.spark.read.schema(CONTROL).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = no_rows(self.spark, CONTROL)
        newest = [F.max(c).alias(c) for c in CONTROL.names[1:]]
        return rows.groupBy(CONTROL.names[0]).agg(*newest)

    def advance(self, name: str, processed: DataFrame, run_ts: Column) -> None:
        """Add the flow's row for the highest processed version; a first one where it has none."""
        mine = self.read().filter(F.col("pipeline_name") == name)
        mine = insert_absent(mine, first_mark(self.spark, name, run_ts), ["pipeline_name"], null_keys=False)
        advance_mark(mine, name, processed, run_ts).coalesce(1).write.mode("append").parquet(self.path)


def first_mark(spark: SparkSession, name: str, run_ts: Column) -> DataFrame:
    """One-row frame with the starting mark of a flow."""
    row = spark.range(1).select(
        F.lit(name).alias("pipeline_name"),
        F.lit(UNSTARTED).cast("bigint").alias("last_silver_commit_version"),
        run_ts.alias("last_run_ts"),
    )
    return conform(row, CONTROL)


def mark_of(control: DataFrame, name: str) -> DataFrame:
    """One row, one column: the mark of a flow, the starting mark when it has none."""
    marks = control.filter(F.col("pipeline_name") == name)
    highest = F.coalesce(F.max("last_silver_commit_version"), F.lit(UNSTARTED).cast("bigint"))
    return marks.agg(highest.alias("mark"))


def changes_above_mark(log: DataFrame, control: DataFrame, name: str) -> DataFrame:
    """New images above the flow's mark."""
    above = F.col(VERSION) > mark_of(control, name).scalar()
    return log.filter(F.col(CHANGE).isin(NEW_IMAGES) & above)


def advance_mark(control: DataFrame, name: str, processed: DataFrame, run_ts: Column) -> DataFrame:
    """Control rows with the flow moved to the highest processed version.

    Nothing processed leaves the version as it was; other flows are not touched.
    """
    high = processed.agg(F.max(VERSION).alias("high")).scalar()
    mine = F.col("pipeline_name") == name
    version = F.col("last_silver_commit_version")
    return control.withColumns(
        {
            "last_silver_commit_version": F.when(mine, F.coalesce(high, version)).otherwise(version),
            "last_run_ts": F.when(mine, run_ts).otherwise(F.col("last_run_ts")),
        }
    )
