"""Aggregates behind the dashboard; each takes the feature or Silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.schemas import failure_columns

# Filter choice that stands for "all", risk bands, bins of the density.
ALL = "Todos"
RISK_BANDS = [(35.0, "low"), (70.0, "medium"), (100.0, "high")]
BINS = 30


def chosen(product: str | None = None, machine_type: str | None = None) -> Column:
    """Both optional filters as one predicate; ``None`` or the "all" choice drops a filter."""
    test = F.lit(True)
    for column, value in (("product_id", product), ("machine_type", machine_type)):
        if value is not None and value != ALL:
            test = test & (F.col(column) == F.lit(value))
    return test


def health(df: DataFrame, product: str | None = None, machine_type: str | None = None) -> DataFrame:
    wear = F.col("tool_wear_min")
    return df.filter(chosen(product, machine_type)).agg(
        F.coalesce(F.avg(wear), F.lit(0.0)).alias("avg_tool_wear"),
        F.coalesce(F.max(wear), F.lit(0)).alias("max_tool_wear"),
        F.count(F.lit(1)).alias("total_records"),
    )


def risk(health_row: DataFrame) -> DataFrame:
    """Wear risk in percent of the largest wear seen, and its band."""
    scale = F.greatest(F.col("max_tool_wear").cast("double"), F.lit(1.0))
    score = F.least(F.lit(100.0), F.col("avg_tool_wear") / scale * 100)
    band = F.lit(RISK_BANDS[-1][1])
    for limit, name in reversed(RISK_BANDS[:-1]):
        band = F.when(F.col("risk_score") < limit, name).otherwise(band)
    return health_row.withColumn("risk_score", score).withColumn("risk_band", band)


def heat(df: DataFrame, product: str | None = None, machine_type: str | None = None) -> DataFrame:
    """Frequency of each (air temperature, torque) pair at one decimal. NULLs form groups."""
    return (
        df.filter(chosen(product, machine_type))
        .groupBy(
            F.round("air_temperature_k", 1).alias("air_temperature_k"),
            F.round("torque_nm", 1).alias("torque_nm"),
        )
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def ordered_heat(heat_rows: DataFrame) -> DataFrame:
    return heat_rows.orderBy("air_temperature_k", "torque_nm")


def binned(heat_rows: DataFrame, bins: int = BINS) -> DataFrame:
    """Frequencies summed over a grid of ``bins`` equal-width bins per axis.

    The frequencies are a fine grid that adds up; the bounds come from the same grid, so the
    table is scanned and shuffled once and both read the result of that shuffle.
    """
    axes = {"air_temperature_k": "air_bin", "torque_nm": "torque_bin"}
    known = heat_rows.dropna(subset=list(axes))
    # The bounds' plan needs the frequency too: else it would not be the same grid.
    limits = known.agg(
        F.struct(
            *[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))],
            F.sum("frequency").alias("total"),
        )
    ).scalar()
    placed = known.withColumn("_limits", limits)
    for axis, name in axes.items():
        lo, hi = F.col(f"_limits.lo_{axis}"), F.col(f"_limits.hi_{axis}")
        share = F.when(hi > lo, (F.col(axis) - lo) / (hi - lo) * bins).otherwise(0.0)
        placed = placed.withColumn(name, F.least(F.lit(bins - 1), F.floor(share).cast("int")))
    # The total is no less than any frequency; this keeps it in the bounds' plan.
    return placed.filter(F.col("_limits.total") >= F.col("frequency")).groupBy(*axes.values()).agg(F.sum("frequency").alias("frequency"))


def failure_distribution(
    df: DataFrame, product: str | None = None, machine_type: str | None = None
) -> DataFrame:
    """Total per failure type as five rows, from a single pass over the table."""
    columns = failure_columns(df)
    totals = df.filter(chosen(product, machine_type)).agg(
        *[
            F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name.upper())
            for name, column in columns.items()
        ]
    )
    return totals.unpivot([], [n.upper() for n in columns], "failure_type", "total_failures")


def summary(df: DataFrame, product: str | None = None, machine_type: str | None = None) -> DataFrame:
    """Rows, distinct products, distinct types.

    Rows are first combined per (product, type), so the exact distinct counts, which need
    each row once per counted column, run over the pairs and not over the table.
    """
    pairs = (
        df.filter(chosen(product, machine_type))
        .groupBy("product_id", "machine_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_distinct("product_id").alias("total_products"),
        F.count_distinct("machine_type").alias("total_types"),
    )


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a filter column, sorted, without NULL."""
    return df.select(column).distinct().dropna().orderBy(column)


def top_match(
    df: DataFrame,
    wanted: tuple[str, str],
    prefer: Sequence[tuple[str, str]],
    ties: Sequence[str],
) -> DataFrame:
    """First row whose column equals ``wanted``, by preferred values, then by ``ties``.

    All comparisons ignore case.
    """

    def equals(column: str, value: str) -> Column:
        return F.lower(column) == F.lower(F.lit(value))

    ranks = [F.when(equals(column, value), 0).otherwise(1) for column, value in prefer]
    return df.filter(equals(*wanted)).orderBy(*ranks, *ties).limit(1)


def first_rows(df: DataFrame, order: Sequence[str], n: int = 1000) -> DataFrame:
    """The ``n`` first rows of the ordered report."""
    return df.orderBy(*order).limit(n)
