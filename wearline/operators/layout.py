"""Clustered layout: rows close in the given columns end up in the same files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """The same rows, ranged over files by whole values of ``columns`` and sorted by them.

    The ranges end on a row hash, so that a value held by a large share of the rows is spread
    over several files. Files and row groups then hold narrow ranges of the first column and,
    within one value of it, of the next, which a filter on both can skip.
    """
    order = [*columns, F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
    return ranged.sortWithinPartitions(*columns)


#: Rows that the grid's bounds are taken from; they decide where rows lie, never which.
SAMPLE = 10_000


def gridded(df: DataFrame, columns: Sequence[str], files: int | None = None, rows_per_file: int = 1_000_000) -> DataFrame:
    """The same rows, dealt out to files by a grid over two columns, and sorted by them.

    Each column is cut at quantiles into about as many parts as the root of the number of files, so
    that a filter on either column skips all but one part, and a filter on both all but a cell. Cells are
    walked to and fro; small neighbours share a file and a cell that is too large gets several,
    dealt out by a row hash, so files are filled to about one size whatever the values' shares.
    NULL lies in the lowest part.
    """
    if files is None:
        files = max(1, -(-df.count() // rows_per_file))
    sides = max(1, math.isqrt(files))
    some = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(SAMPLE).collect()
    cell, cells = F.lit(0), 1
    for column in columns:
        values = sorted(v for v in (row[column] for row in some) if v is not None)
        bounds = sorted({values[len(values) * i // sides] for i in range(1, sides)}) if values else []
        part = F.lit(0)
        for bound in bounds:
            part = part + F.coalesce((F.col(column) >= F.lit(bound)).cast("int"), F.lit(0))
        part = F.when(cell % 2 == 1, F.lit(len(bounds)) - part).otherwise(part)
        cell, cells = cell * (len(bounds) + 1) + part, cells * (len(bounds) + 1)
    # A row for each cell, less than files.
    counts = dict(df.groupBy(cell.alias("cell")).count().collect())
    room = max(1, -(-sum(counts.values()) // files))
    first, parts, file, filled = [], [], 0, 0
    for own in (counts.get(i, 0) for i in range(cells)):
        if filled and filled + own > 1.25 * room:
            file, filled = file + 1, 0
        first.append(file)
        parts.append(max(1, round(own / room)))
        filled += own
        if parts[-1] > 1:
            file, filled = file + parts[-1], 0
    number = file + (1 if filled or not file else 0)
    at = lambda numbers: F.array(*map(F.lit, numbers))[cell]
    spread = F.pmod(F.xxhash64(*df.columns), at(parts)).cast("int")
    return df.repartitionById(number, at(first) + spread).sortWithinPartitions(*columns)
