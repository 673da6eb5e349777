"""Session settings and the shared folder that jobs write scratch data to."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wearline")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only on a ``local`` master, where all tasks share one machine, may it be a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not is_one_machine(context.master):
            raise ValueError(f"set spark.checkpoint.dir: executors of {context.master} share no local folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wearline-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/wearline-{label}-{uuid.uuid4().hex}"


Moment = Column | datetime | str | None


def as_ts(value: Moment = None) -> Column:
    """Run time as a column; ``None`` means now, fixed here so that all uses agree."""
    if value is None:
        return F.lit(datetime.now(timezone.utc))
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """Empty frame that the optimizer knows to be empty."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*nulls).filter(F.lit(False))


def pin(df: DataFrame, label: str = "pinned", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or over ``path``, and read it back.

    Cuts the lineage, survives lost executors, and tells the planner the true size.
    """
    path = path or scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
