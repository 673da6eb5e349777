"""Feature rows, daily aggregates and rule predictions derived from Silver changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.functions.rules import FAILURE_RULES, RULE_MODEL, Rule, flags
from wearline.operators.changes import AFTER, BEFORE, CHANGE, DELETE, INSERT, VERSION, new_images
from wearline.operators.upsert import latest_per_key
from wearline.schemas import (
    DAILY,
    DAILY_STATE,
    FAILURES,
    FEATURES,
    GROUP_KEYS,
    MEASURES,
    conform,
    with_labels,
)

_FEATURE_INPUT = [
    "udi",
    "product_id",
    "machine_type",
    "event_date",
    "event_hour",
    *MEASURES,
    "machine_failure",
    *FAILURES,
]


def feature_rows(feed: DataFrame, run_ts: Column) -> DataFrame:
    """Feature rows of a Silver feed: the newest image of each ``udi``."""
    images = new_images(feed).select(VERSION, *_FEATURE_INPUT)
    newest = latest_per_key(images, ["udi"], [VERSION]).drop(VERSION)
    return conform(with_labels(newest).withColumn("_gold_loaded_ts", run_ts), FEATURES)


def daily(features: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Count, averages and failure totals per product, machine type and day."""
    return features.groupBy(*GROUP_KEYS, *extra_keys).agg(
        F.count(F.lit(1)).alias("total_registros"),
        *[F.avg(m).alias(f"avg_{m}") for m in MEASURES],
        *[F.sum(f"{f}_label").cast("bigint").alias(f"total_{f}") for f in FAILURES],
    )


#: Sums are decimals, so that what leaves a group takes away exactly what it had added.
EXACT = "decimal(28,10)"


def daily_changes(feed: DataFrame) -> DataFrame:
    """What a feed of feature changes adds to the state of each group.

    Old images count against their group and new ones for theirs, so a row that moves is taken
    from one group and given to the other. The state of a group is the number of its rows, the
    sum and the number of each measure, and the failure totals; all of them add up.
    """
    kinds = {INSERT: 1, AFTER: 1, BEFORE: -1, DELETE: -1}
    sign = F.lit(0)
    for kind, value in kinds.items():
        sign = F.when(F.col(CHANGE) == kind, value).otherwise(sign)
    rows = feed.withColumn("_sign", sign)
    own = F.col("_sign")
    return rows.groupBy(*GROUP_KEYS).agg(
        F.sum(own).cast("bigint").alias("n"),
        *[F.sum(F.col(m).cast(EXACT) * own.cast("decimal(1,0)")).cast("decimal(38,10)").alias(f"sum_{m}") for m in MEASURES],
        *[F.sum(F.when(F.col(m).isNotNull(), own)).cast("bigint").alias(f"n_{m}") for m in MEASURES],
        *[F.sum(F.col(f"{f}_label") * own).cast("bigint").alias(f"total_{f}") for f in FAILURES],
    )


def merged_state(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The new state of the groups in ``delta``; a group that is empty has 0 rows.

    Only the states of these groups are read, no feature row. ``delta`` is pinned by the caller.
    """
    own = state.join(delta.select(*GROUP_KEYS), GROUP_KEYS, "left_semi").select(*DAILY_STATE.names)
    both = own.unionByName(conform(delta, DAILY_STATE))
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).cast(DAILY_STATE[c].dataType).alias(c) for c in DAILY_STATE.names if c not in GROUP_KEYS]
    return both.groupBy(*GROUP_KEYS).agg(*sums)


def daily_of(state: DataFrame) -> DataFrame:
    """The daily aggregates that a state stands for."""
    mean = lambda m: F.col(f"sum_{m}").cast("double") / F.nullif(F.col(f"n_{m}"), F.lit(0))
    return state.filter("n > 0").select(
        *GROUP_KEYS,
        F.col("n").alias("total_registros"),
        *[mean(m).alias(f"avg_{m}") for m in MEASURES],
        *[f"total_{f}" for f in FAILURES],
    )


def affected_groups(feed: DataFrame, stale: str = "keep") -> DataFrame:
    """Distinct groups that a Silver feed touches.

    ``keep`` looks at new images only, so a group that a row has left is not seen;
    ``recompute`` looks at old images too.
    """
    kinds = {"keep": [INSERT, AFTER], "recompute": [INSERT, AFTER, BEFORE, DELETE]}[stale]
    return feed.filter(F.col(CHANGE).isin(kinds)).select(*GROUP_KEYS).distinct()


def refresh_groups(features: DataFrame, groups: DataFrame) -> DataFrame:
    """Aggregates of the given groups only, over all their feature rows.

    The features are cut down to the groups before they are aggregated. ``groups`` is pinned
    by the caller, so the planner knows its size: a small one is broadcast, and with a larger
    one the adaptive join splits a group that holds most of the rows.
    """
    return daily(features.join(groups, GROUP_KEYS, "left_semi"))


def emptied_groups(groups: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Affected groups that have no feature rows left."""
    return groups.join(refreshed.select(*GROUP_KEYS), GROUP_KEYS, "left_anti")


def daily_rows(refreshed: DataFrame, run_ts: Column) -> DataFrame:
    return conform(refreshed.withColumn("_gold_agg_loaded_ts", run_ts), DAILY)


def of_changed_keys(features: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the feed. NULL keys match nothing.

    A feed that is small on disk is broadcast by the planner; with a larger one a hot key of
    ``features`` is split by the adaptive join.
    """
    return features.join(feed.select(*keys), list(keys), "left_semi").select(*features.columns)


def rule_predictions(
    features: DataFrame,
    run_ts: Column,
    rules: Sequence[Rule] = FAILURE_RULES,
    model: tuple[str, str, float] = RULE_MODEL,
    also: Sequence[str] = (),
) -> DataFrame:
    """Predictions of the rule baseline, one row per feature row; ``also`` keeps columns."""
    name, model_version, score = model
    return features.select(
        "udi",
        "product_id",
        run_ts.alias("prediction_ts"),
        *flags(rules, "pred_"),
        F.lit(name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(float(score)).alias("prediction_score"),
        run_ts.alias("_pred_loaded_ts"),
        *also,
    )
