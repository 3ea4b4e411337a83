"""Orphan counts and table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.frames import stack
from tallyhouse.schemas import CONTRACTS, DIMENSION_KEYS, Contract
from tallyhouse.session import materialise

ORPHAN_NAMES = {
    "dim_product": "orphaned_products",
    "dim_customer": "orphaned_customers",
    "dim_time": "orphaned_times",
    "dim_country": "orphaned_countries",
}
# The check catalogue and the check script leave the country out; the load gate does not.
CHECKED_DIMENSIONS = ("dim_product", "dim_customer", "dim_time")


def _unmatched(rows: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Key values of ``rows`` without a row in ``dim``, with how often each occurs.

    Counting per key first leaves one row per key and task to shuffle, so neither
    a hot key nor a mass of null keys ever meets the join.
    """
    uses = rows.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("uses"))
    return uses.join(dim.select(F.col(key).alias("key")), "key", "left_anti")


def orphan_counts(
    fact: DataFrame, dims: dict[str, DataFrame], names=tuple(ORPHAN_NAMES)
) -> DataFrame:
    """One row: per dimension, fact rows whose key has no dimension row; null keys count too.

    All dimensions go through one scan of the fact's keys and one anti-join of
    (dimension, key) pairs, counted before they meet it.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dim"), F.col(DIMENSION_KEYS[name]).cast("long").alias("key"))
            for name in names
        ]
    )
    uses = fact.select(F.inline(pairs)).groupBy("dim", "key").agg(F.count("*").alias("uses"))
    known = stack(
        [
            dims[name].select(
                F.lit(name).alias("dim"), F.col(DIMENSION_KEYS[name]).cast("long").alias("key")
            )
            for name in names
        ]
    )
    lost = uses.join(known, ["dim", "key"], "left_anti")
    return lost.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("dim") == name, F.col("uses"))), F.lit(0)).alias(
                ORPHAN_NAMES[name]
            )
            for name in names
        ]
    )


def orphans(fact: DataFrame, dimension: str, dim: DataFrame) -> DataFrame:
    """Orphan count of one dimension."""
    return orphan_counts(fact, {dimension: dim}, (dimension,))


def _long(table: str, one_row: DataFrame, value: str, columns: list[str]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.col(name).cast("long").alias(value),
            )
            for name in columns
        ]
    )
    return one_row.select(F.inline(rows))


def null_violations(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Nulls per column declared NOT NULL, one scan per table."""
    parts = []
    for table, df in tables.items():
        columns = list(contracts[table].not_null)
        if columns:
            counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            parts.append(_long(table, counts, "null_count", columns))
    return stack(parts)


def width_violations(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Texts longer than their declared width, one scan per table."""
    parts = []
    for table, df in tables.items():
        widths = contracts[table].widths
        if widths:
            counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in widths.items()])
            parts.append(_long(table, counts, "too_long", list(widths)))
    return stack(parts)


def unique_violations(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Per table: keys that occur more than once, and the rows beyond the first.

    As in SQL, a key with a null in it is never a duplicate.
    """
    parts = []
    for table, df in tables.items():
        keys = list(contracts[table].unique)
        if keys:
            sizes = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
            parts.append(
                sizes.where("n > 1")
                .agg(
                    F.count("*").alias("repeated_keys"),
                    F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
                )
                .select(
                    F.lit(table).alias("table_name"),
                    F.lit(", ".join(keys)).alias("key_columns"),
                    "repeated_keys",
                    "extra_rows",
                )
            )
    return stack(parts)


def reference_violations(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Non-null references that point nowhere. Null references are allowed here."""
    parts = []
    for table, df in tables.items():
        for column, target in contracts[table].references.items():
            used = df.where(F.col(column).isNotNull())
            lost = _unmatched(used, column, tables[target], DIMENSION_KEYS[target])
            parts.append(
                lost.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("violations")).select(
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit(target).alias("references_table"),
                    "violations",
                )
            )
    return stack(parts)


def lost_references(rows: DataFrame, references: dict[str, str], dimensions: dict[str, DataFrame]) -> DataFrame:
    """``(column, key)``: the references of ``rows``, by column and dimension, that are not null and point nowhere.

    One scan of the reference columns; equal references are merged by each task before they are shuffled.
    """
    long = lambda name: F.col(name).cast("long").alias("key")
    used = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), long(c)) for c in references])))
    known = stack([dimensions[d].select(F.lit(c).alias("column"), long(DIMENSION_KEYS[d])) for c, d in references.items()])
    return used.dropna().distinct().join(known, ["column", "key"], "left_anti")


def with_refusals(
    rows: DataFrame, contract: Contract, dimensions: dict[str, DataFrame] | None = None,
    order_by: str | None = None, name: str = "reasons",
) -> DataFrame:
    """``rows`` with the reasons, as an array of texts, why a table under ``contract`` refuses them.

    Nulls and widths are read off the row itself. With ``dimensions``, a reference that is not null and
    points nowhere is a reason; null references are allowed. The references that point nowhere are found first and written,
    so that Spark knows how few they are and need not shuffle the rows for look-ups in the dimensions. With ``order_by``, a unique column of ``rows``,
    the first acceptable row of a key stays and later ones are refused; keys that contain a null never repeat.
    """
    reasons = [F.when(F.col(c).isNull(), f"{c} is null") for c in contract.not_null if c in rows.columns]
    reasons += [F.when(F.length(c) > n, f"{c} is longer than {n}") for c, n in contract.widths.items() if c in rows.columns]
    if dimensions and contract.references:
        lost = materialise(lost_references(rows, contract.references, dimensions), "lost-references")
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        for column, target in contract.references.items():
            gone = lost.where(F.col("column") == column).select(F.col("key").cast(kinds[column]).alias(column), F.lit(True).alias(f"_{column}"))
            rows = rows.join(gone, column, "left")
            reasons.append(F.when(F.col(f"_{column}"), f"{column} is not in {target}"))
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull()) if reasons else F.array().cast("array<string>")
    judged = rows.withColumn(name, found).drop(*[f"_{c}" for c in contract.references])
    if order_by is None or not contract.unique:
        return judged
    keys = list(contract.unique)
    # One row per key and task is shuffled to find the first ones; the join meets keys that repeat only.
    first = judged.where(F.size(name) == 0).dropna(subset=keys).groupBy(*keys).agg(
        F.min(order_by).alias("_first"), F.count("*").alias("_n")
    )
    repeated = materialise(first.where("_n > 1").drop("_n"), "repeated-keys")
    later = (F.size(name) == 0) & (F.col(order_by) > F.col("_first"))
    told = F.when(later, F.array(F.lit(f"{', '.join(keys)} repeats"))).otherwise(F.col(name))
    return judged.join(repeated, keys, "left").withColumn(name, told).drop("_first")
