"""Audit queries over change feeds and past states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.operators.changes import (
    CHANGE,
    COMMIT_TS,
    META,
    VERSION,
    as_of_query,
    changes,
    new_images,
)
from wearline.schemas import FAILURES, MEASURES

PREDICTED = [f"pred_{f}" for f in FAILURES]
SILVER_HISTORY = [
    *META,
    "udi",
    "product_id",
    "machine_type",
    *MEASURES,
    "machine_failure",
    *FAILURES,
]
PREDICTION_HISTORY = [
    *META,
    "udi",
    "product_id",
    "prediction_ts",
    *PREDICTED,
    "model_name",
    "model_version",
    "prediction_score",
]


def change_history(log: DataFrame, columns: list[str], start: int = 0) -> DataFrame:
    """Feed by version and key.

    The other columns are sorted on last: rows of one commit without a key would else be
    equal, and equal sort keys cannot be split over range partitions.
    """
    lead = [VERSION, "udi", CHANGE]
    rest = [c for c in columns if c not in lead]
    return changes(log, start).select(*columns).orderBy(*lead, *rest)


def any_failure() -> Column:
    """True when a prediction row flags at least one failure."""
    test = F.col(PREDICTED[0]) == 1
    for name in PREDICTED[1:]:
        test = test | (F.col(name) == 1)
    return test


def audit_pairs(
    silver_log: DataFrame, prediction_log: DataFrame, silver_start: int = 0, gold_start: int = 0
) -> DataFrame:
    """Every new Silver image beside every new prediction image of the same machine.

    Both feeds are cut to the columns of the report and to their start versions before the
    join. A commit holds one new image per machine, so no machine has more rows on either
    side than there are commits; rows without a machine match nothing.
    """
    silver = new_images(changes(silver_log, silver_start)).select(
        F.col(VERSION).alias("silver_version"),
        F.col(COMMIT_TS).alias("silver_commit_ts"),
        "udi",
        "product_id",
        *MEASURES,
    )
    gold = new_images(changes(prediction_log, gold_start)).select(
        F.col(VERSION).alias("gold_version"),
        F.col(COMMIT_TS).alias("gold_commit_ts"),
        "udi",
        "product_id",
        *PREDICTED,
        "model_name",
        "model_version",
    )
    return silver.join(gold, ["udi", "product_id"]).select(
        "silver_version",
        "silver_commit_ts",
        "gold_version",
        "gold_commit_ts",
        "udi",
        "product_id",
        *MEASURES,
        *PREDICTED,
        "model_name",
        "model_version",
    )


#: Seconds of a time slice: a machine's commits within one meet in one task.
SLICE = 86_400


def current_predictions(
    silver_log: DataFrame,
    prediction_log: DataFrame,
    silver_start: int = 0,
    gold_start: int = 0,
    seconds: float = SLICE,
) -> DataFrame:
    """Each new Silver image with the prediction that was current for it: the first one
    committed at its time or later, before the machine's next image. NULL where none was.

    One row per Silver image, whatever the number of commits. Both feeds are merged by machine and
    time slice, so a machine with very many commits is spread over its slices; what an image does not
    find in its own slice is carried on from the first image and prediction of the slices behind
    it, one row each. Images without a machine match nothing and are not shuffled. Of predictions by
    several models at one time the first by name counts.
    """
    machine = ["udi", "product_id"]
    kinds = {"silver": MEASURES, "gold": [*PREDICTED, "model_name", "model_version"]}
    logs = {"silver": (silver_log, silver_start), "gold": (prediction_log, gold_start)}
    sides = [
        new_images(changes(*logs[kind])).select(
            *machine,
            F.col(COMMIT_TS).alias("at"),
            F.lit(order).alias("side"),
            F.struct(F.col(VERSION).alias("version"), F.col(COMMIT_TS).alias("ts"), *columns).alias(kind),
        )
        for order, (kind, columns) in enumerate(kinds.items())
    ]
    nameless = sides[0].filter("udi IS NULL OR product_id IS NULL").withColumn("_gold", F.lit(None).cast(sides[1].schema["gold"].dataType))
    slice_of = F.floor(F.unix_micros(F.col("at").cast("timestamp")) / F.lit(seconds * 1_000_000))
    events = sides[0].unionByName(sides[1], allowMissingColumns=True).filter("udi IS NOT NULL AND product_id IS NOT NULL")
    events = events.withColumn("slice", slice_of)
    order = ["at", "side", "gold.model_name", "gold.model_version"]
    later = Window.partitionBy(*machine, "slice").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    found = events.withColumns(
        {
            "_gold": F.first("gold", ignorenulls=True).over(later),
            "_next": F.first("silver.ts", ignorenulls=True).over(later),
        }
    ).filter("side = 0")
    # The first of each kind in every slice, then in all slices behind it.
    firsts = events.groupBy(*machine, "slice").agg(
        F.min(F.when(F.col("side") == 1, F.struct("at", "gold.model_name", "gold.model_version", "gold"))).alias("_g"),
        F.min(F.when(F.col("side") == 0, F.col("at"))).alias("_s"),
    )
    behind = Window.partitionBy(*machine).orderBy("slice").rowsBetween(1, Window.unboundedFollowing)
    carried = firsts.select(
        *machine,
        "slice",
        F.first("_g.gold", ignorenulls=True).over(behind).alias("_later_gold"),
        F.first("_s", ignorenulls=True).over(behind).alias("_later_next"),
    )
    merged = found.join(carried, [*machine, "slice"]).withColumns(
        {
            "_gold": F.coalesce("_gold", "_later_gold"),
            "_next": F.coalesce("_next", "_later_next"),
        }
    )
    current = F.when(F.col("_next").isNull() | (F.col("_gold.ts") < F.col("_next")), F.col("_gold"))
    columns = [*machine, "silver", "_gold"]
    every = merged.withColumn("_gold", current).select(*columns).unionByName(nameless.select(*columns))
    return every.select(
        F.col("silver.version").alias("silver_version"),
        F.col("silver.ts").alias("silver_commit_ts"),
        F.col("_gold.version").alias("gold_version"),
        F.col("_gold.ts").alias("gold_commit_ts"),
        *machine,
        *[F.col(f"silver.{c}").alias(c) for c in kinds["silver"]],
        *[F.col(f"_gold.{c}").alias(c) for c in kinds["gold"]],
    )


def newest_first(pairs: DataFrame) -> DataFrame:
    """Pairs by commit time, newest first.

    One commit may hold most of the rows, so the key and versions are sorted on too: equal
    sort keys cannot be split over range partitions.
    """
    return pairs.orderBy(F.desc("gold_commit_ts"), "udi", "silver_version", "gold_version")


def first_failure_time(predictions: DataFrame) -> DataFrame:
    """One row, one column: time of the earliest prediction of any failure."""
    return predictions.filter(any_failure()).agg(F.min("prediction_ts").alias("first_pred_ts"))


def state_before_first_failure(
    silver_log: DataFrame, keys: list[str], predictions: DataFrame, null_keys: bool = True
) -> DataFrame:
    """Silver as it stood when a failure was first predicted."""
    state = as_of_query(silver_log, keys, first_failure_time(predictions), null_keys)
    return state.filter(F.col("product_id").isNotNull())
