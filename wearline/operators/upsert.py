"""Keyed upserts as joins: latest row per key, upsert, insert-if-absent, delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def has_null(keys: Sequence[str]) -> Column:
    """True when any key column is NULL; such a row matches no other row."""
    test = F.col(keys[0]).isNull()
    for key in keys[1:]:
        test = test | F.col(key).isNull()
    return test


def split_null_keys(
    df: DataFrame, keys: Sequence[str], null_keys: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a whole key, and rows without one.

    NULL keys all hash to one partition, so they are kept away from every keyed shuffle.
    A caller whose keys are never NULL passes ``null_keys=False``; the second part is then
    ``None`` and the input is read once.
    """
    if not null_keys:
        return df, None
    return df.filter(~has_null(keys)), df.filter(has_null(keys))


def _union(first: DataFrame, *rest: DataFrame | None) -> DataFrame:
    for df in rest:
        if df is not None:
            first = first.unionByName(df)
    return first


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    null_keys: bool = True,
    ties: bool = True,
) -> DataFrame:
    """One row per key: largest ``order``, ties settled by the remaining columns.

    ``ties=False`` leaves these out, for an ``order`` that has no ties within a key.

    A rank filtered to 1 is limited in each task before the shuffle too, so a key that
    holds a large share of the rows sends one row per task. Rows with a NULL key stay.
    """
    whole, without = split_null_keys(df, keys, null_keys)
    rest = [c for c in df.columns if ties and c not in keys and c not in order]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in [*order, *rest]])
    ranked = whole.withColumn("_rank", F.row_number().over(newest_first))
    return _union(ranked.filter(F.col("_rank") == 1).drop("_rank"), without)


def refuse_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, failing at run time when a key occurs twice. Keys must not be NULL."""
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(F.lit(0).alias("_"), *rest)).alias("_row")
    )
    message = F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys)))
    single = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(single).select(
        *[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    assume_unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """State after merging ``source`` into ``target``.

    Matched rows take the source values (only ``update_cols`` when given), unmatched source
    rows are inserted whole. A key that occurs twice in ``source`` is an error; pass
    ``assume_unique`` when the source was already reduced. NULL keys never match.
    """
    columns = target.columns
    tgt, tgt_null = split_null_keys(target, keys, null_keys)
    src, src_null = split_null_keys(source.select(*columns), keys, null_keys)
    changed = src if assume_unique else refuse_duplicates(src, keys)
    if update_cols is None:
        kept = tgt.join(src.select(*keys), list(keys), "left_anti").select(*columns)
        return _union(kept, changed, tgt_null, src_null)
    patch = changed.select(*keys, F.struct(*columns).alias("_new"))
    patched = tgt.join(patch, list(keys), "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in update_cols
            else F.col(c)
            for c in columns
        ]
    )
    return _union(patched, insertable(tgt, changed, keys), tgt_null, src_null)


def insertable(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks. Both sides hold whole keys."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """Target plus the source rows whose key it lacks; matched rows are left alone."""
    tgt, _ = split_null_keys(target, keys, null_keys)
    src, src_null = split_null_keys(source.select(*target.columns), keys, null_keys)
    return _union(target, insertable(tgt, src, keys), src_null)
