"""Dense surrogate keys for dimensions of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.session import materialise

# monotonically_increasing_id() keeps the partition number above bit 33 and the
# row's position in its partition below it.
_POSITION_BITS = 33


def with_dense_key(dim: DataFrame, natural_key: str, key_name: str) -> DataFrame:
    """Number the rows 1..n in natural-key order, as the first column.

    Rows are range-partitioned and sorted in parallel, then written once: range
    bounds are sampled, so a recomputed partition could otherwise hold other rows
    than the one that was counted. The only single-partition step runs over one
    row per partition, which is also all that is broadcast.
    """
    ranged = (
        dim.repartitionByRange(natural_key)
        .sortWithinPartitions(natural_key)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialise(ranged, f"ranged-{key_name}").withColumn(
        "_part", F.shiftright("_place", _POSITION_BITS)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position + 1).alias(key_name), *dim.columns
    )
