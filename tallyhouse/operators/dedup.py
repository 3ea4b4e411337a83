"""Keep-first de-duplication without a per-key window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(
    df: DataFrame, keys: dict[str, Column] | Sequence[str], order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """The first row of each key, as whole rows in the columns of ``df``.

    First means smallest by ``order_by``, then by the remaining columns in their
    order, nulls first. That order is total up to identical rows, so the survivor
    does not depend on partitioning. ``min`` of a struct aggregates on the map
    side: however many copies a key has, each task sends on at most one of them.
    Key columns that are plain columns of ``df`` travel as keys only. ``copies`` names a further
    column with the number of rows of the key.
    """
    by = keys if isinstance(keys, dict) else {name: F.col(name) for name in keys}
    plain = [name for name in by if name in df.columns]
    carried = [*order_by, *[n for n in df.columns if n not in order_by and n not in plain]]
    grouped = df.groupBy(*[column.alias(name) for name, column in by.items()]).agg(
        F.min(F.struct(*carried)).alias("_first"), *([F.count("*").alias(copies)] if copies else [])
    )
    return grouped.select(
        *[n if n in plain else F.col("_first").getField(n).alias(n) for n in df.columns],
        *([copies] if copies else []),
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    """Exact number of key tuples; tuples that contain nulls count as well."""
    return F.count_distinct(F.struct(*[df[name] for name in keys]))
