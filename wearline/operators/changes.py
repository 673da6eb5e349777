"""Change feed: rows a commit adds to the log, and tables read back from that log.

A log holds the table's columns plus ``_change_type``, ``_commit_version`` and
``_commit_timestamp``. A commit holds at most one new image per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.operators.upsert import (
    _union,
    latest_per_key,
    refuse_duplicates,
    split_null_keys,
)

CHANGE, VERSION, COMMIT_TS = "_change_type", "_commit_version", "_commit_timestamp"
META = [CHANGE, VERSION, COMMIT_TS]
# The change types of a feed.
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"
NEW_IMAGES = [INSERT, AFTER]


def _image(change: str, row: Column) -> Column:
    return F.struct(F.lit(change).alias("change"), row.alias("row"))


def _spread(df: DataFrame, images: Column, *extra: Column) -> DataFrame:
    """One output row per image in the array column ``images``."""
    one = df.select(F.explode(images).alias("_i"), *extra)
    rest = [c for c in one.columns if c != "_i"]
    return one.select("_i.row.*", F.col("_i.change").alias(CHANGE), *rest)


def change_rows(
    before: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    skip_unchanged: bool = False,
    stamp_cols: Sequence[str] = (),
    assume_unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Changes that an upsert of ``source`` makes: an insert, or a pre- and a postimage.

    The target is cut to the source's keys first. A small source is broadcast for that by
    the planner and the target is not shuffled at all; otherwise both sides are already
    partitioned by key for the join that follows. ``skip_unchanged`` leaves out matched
    rows whose values, ``stamp_cols`` aside, stay the same.
    """
    columns = before.columns
    tgt, _ = split_null_keys(before, keys, null_keys)
    src, src_null = split_null_keys(source.select(*columns), keys, null_keys)
    touched = tgt.join(src.select(*keys), list(keys), "left_semi")
    single = src if assume_unique else refuse_duplicates(src, keys)
    row = F.struct(*columns)
    pair = single.select(*keys, row.alias("_new")).join(
        touched.select(*keys, row.alias("_old")), list(keys), "left"
    )
    old, new = F.col("_old"), F.col("_new")
    after = new
    if update_cols is not None:
        taken = [*keys, *update_cols]
        after = F.struct(*[(new if c in taken else old)[c].alias(c) for c in columns])
    images = F.when(old.isNull(), F.array(_image(INSERT, new)))
    if skip_unchanged:
        watched = [c for c in columns if c not in stamp_cols]
        same = F.struct(*[after[c].alias(c) for c in watched]).eqNullSafe(
            F.struct(*[old[c].alias(c) for c in watched])
        )
        images = images.when(same, F.array().cast(_images_type(before)))
    images = images.otherwise(F.array(_image(BEFORE, old), _image(AFTER, after)))
    inserted = None if src_null is None else src_null.withColumn(CHANGE, F.lit(INSERT))
    return _union(_spread(pair, images), inserted)


def _images_type(df: DataFrame) -> str:
    row = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in df.schema)
    return f"array<struct<change: string, row: struct<{row}>>>"


def deletions(before: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete images of the rows of ``before`` whose key is in ``gone``."""
    doomed = before.join(gone.select(*keys), list(keys), "left_semi").select(*before.columns)
    return doomed.withColumn(CHANGE, F.lit(DELETE))


def log_of_versions(
    rows: DataFrame,
    keys: Sequence[str],
    version_col: str,
    commit_ts: Column,
    null_keys: bool = True,
) -> DataFrame:
    """Log of upserting ``rows`` version by version, computed in one pass.

    ``rows`` holds at most one row per key and version, so a key has no more rows than
    there are versions. ``commit_ts`` is an expression over the version column.
    """
    columns = [c for c in rows.columns if c != version_col]
    whole, without = split_null_keys(rows, keys, null_keys)
    order = Window.partitionBy(*keys).orderBy(version_col)
    new = F.struct(*columns)
    pair = whole.withColumns({"_new": new, "_old": F.lag(new).over(order)})
    images = F.when(
        F.col("_old").isNull(), F.array(_image(INSERT, F.col("_new")))
    ).otherwise(F.array(_image(BEFORE, F.col("_old")), _image(AFTER, F.col("_new"))))
    version = F.col(version_col).cast("bigint").alias(VERSION)
    log = _spread(pair, images, version, commit_ts.alias(COMMIT_TS))
    if without is None:
        return log
    return log.unionByName(
        without.select(*columns, F.lit(INSERT).alias(CHANGE), version, commit_ts.alias(COMMIT_TS))
    )


def changes(log: DataFrame, start: int = 0) -> DataFrame:
    """Feed from version ``start`` on."""
    return log.filter(F.col(VERSION) >= start)


def changes_between(log: DataFrame, low: int, high: int) -> DataFrame:
    """Feed above ``low`` up to and including ``high``."""
    return log.filter((F.col(VERSION) > low) & (F.col(VERSION) <= high))


def new_images(log: DataFrame) -> DataFrame:
    return log.filter(F.col(CHANGE).isin(NEW_IMAGES))


def newest_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str], null_keys: bool = True) -> DataFrame:
    """The row of each key with the largest ``order``: one aggregate that is combined in each task
    before its only exchange, without a window. Rows without a key stay."""
    whole, without = split_null_keys(rows, keys, null_keys)
    row = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return _union(whole.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(row).select("_row.*"), without)


def _state(log: DataFrame, keys: Sequence[str], null_keys: bool) -> DataFrame:
    images = log.filter(F.col(CHANGE).isin(INSERT, AFTER, DELETE))
    last = newest_of(images, keys, [VERSION], null_keys)
    return last.filter(F.col(CHANGE) != DELETE).drop(*META)


def state_of_versions(
    rows: DataFrame,
    keys: Sequence[str],
    version_col: str,
    version: int,
    order: Sequence[str] = (),
    null_keys: bool = True,
) -> DataFrame:
    """Table after upserting the versions of ``rows`` up to ``version``, each reduced to the largest
    ``order`` per key (ties by the remaining columns), without making their log.

    The bound is applied before anything else, and neither images nor versions are told apart on
    the way: the newest row of a key is the state.
    """
    rest = [c for c in rows.columns if c not in (*keys, version_col, *order)]
    bounded = rows.filter(F.col(version_col) <= version)
    return newest_of(bounded, keys, [version_col, *order, *rest], null_keys).drop(version_col)


def as_of_version(
    log: DataFrame, keys: Sequence[str], version: int, null_keys: bool = True
) -> DataFrame:
    """Table as it stood after commit ``version``."""
    return _state(log.filter(F.col(VERSION) <= version), keys, null_keys)


def as_of_timestamp(
    log: DataFrame, keys: Sequence[str], ts: Column, null_keys: bool = True
) -> DataFrame:
    """Table as it stood at ``ts``; the column may be a constant or a scalar subquery."""
    return _state(log.filter(F.col(COMMIT_TS) <= ts), keys, null_keys)


def as_of_query(
    log: DataFrame, keys: Sequence[str], moment: DataFrame, null_keys: bool = True
) -> DataFrame:
    """Table at the time held by the one-row, one-column frame ``moment``."""
    return as_of_timestamp(log, keys, moment.scalar(), null_keys)


def apply_changes(
    state: DataFrame, log: DataFrame, keys: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """``state`` after the changes of ``log``, which all come later than it."""
    images = log.filter(F.col(CHANGE).isin(INSERT, AFTER, DELETE))
    whole, without = split_null_keys(images, keys, null_keys)
    tgt, tgt_null = split_null_keys(state, keys, null_keys)
    kept = tgt.join(whole.select(*keys), list(keys), "left_anti").select(*state.columns)
    last = latest_per_key(whole, keys, [VERSION], null_keys=False, ties=False)
    last = last.filter(F.col(CHANGE) != DELETE)
    fresh = None if without is None else without.select(*state.columns)
    return _union(kept, last.select(*state.columns), tgt_null, fresh)


def history(log: DataFrame) -> DataFrame:
    """One row per commit: when it happened and how many rows it touched."""
    return log.groupBy(VERSION, COMMIT_TS).agg(
        F.count_if(F.col(CHANGE) == INSERT).alias("rows_inserted"),
        F.count_if(F.col(CHANGE) == AFTER).alias("rows_updated"),
        F.count_if(F.col(CHANGE) == DELETE).alias("rows_deleted"),
    )
