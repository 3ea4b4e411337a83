"""Putting one-row results next to other rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate (always exactly one row) to every row of ``df``.

    A scalar subquery: Spark computes the row once and ships it as a literal, so
    there is neither a join nor an unpartitioned window.
    """
    row = one_row.select(F.struct(*one_row.columns).alias("row")).scalar()
    return df.select("*", *[row.getField(name).alias(name) for name in one_row.columns])


def side_by_side(*one_rows: DataFrame) -> DataFrame:
    """Columns of several frames of at most one row as a single row.

    The rows are stacked with nulls in the columns they lack, and ``max`` picks the
    one value of each column: no join, and every frame runs in parallel. A frame
    without a row leaves its columns null.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_rows)
    return stacked.agg(*[F.max(f"`{name}`").alias(name) for name in stacked.columns])


def stack(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)
