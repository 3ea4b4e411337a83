"""Landed transaction files and their canonical and staging shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.schemas import CANONICAL_NAMES, LANDING, REQUIRED_COLUMNS, STAGING, STAGING_NAMES

NULL_TEXT = "\\N"


def scan_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    extra: T.StructType | None = None,
) -> DataFrame:
    """All columns of the landed files in declared types, found by name and never by place.

    ``extra`` adds source columns beyond the sheet's own, such as a line position
    that decides which copy of a duplicate comes first. A required column that is
    missing, or a value that does not fit its type, fails the read; other columns
    that are missing are null.
    """
    if fmt == "csv":
        # An empty field is null; a quoted empty field is an empty text. All files must
        # have the header of the first.
        options = {"header": True, "mode": "FAILFAST", "nullValue": NULL_TEXT, "enforceSchema": False}
        found = spark.read.options(**options).csv(path)
    else:
        found = spark.read.format(fmt).load(path)
    needed = [n for n in LANDING.names if CANONICAL_NAMES.get(n, n) in REQUIRED_COLUMNS]
    missing = [n for n in [*needed, *(extra.names if extra else [])] if n not in found.columns]
    if missing:
        raise ValueError(f"The landed files lack columns: {missing}")
    fields = LANDING.fields + (extra.fields if extra else [])
    return found.select(*[_typed(found, field) for field in fields])


def _typed(found: DataFrame, field: T.StructField) -> Column:
    """The column in its declared type; whole numbers may arrive as ``13085.0``."""
    if field.name not in found.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value = found[field.name]
    if found.schema[field.name].dataType != field.dataType and isinstance(field.dataType, T.IntegralType):
        number = value.cast("decimal(38,6)")
        odd = F.concat(F.lit(f"{field.name} is not a whole number: "), value.cast("string"))
        value = F.when(number.isNull() | (number == F.floor(number)), number).otherwise(F.raise_error(odd))
    return value.cast(field.dataType).alias(field.name)


def canonical_columns(df: DataFrame) -> DataFrame:
    """Rename the source headers; names that are absent are ignored."""
    return df.withColumnsRenamed(CANONICAL_NAMES)


def require_columns(df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged, or name the required columns it lacks."""
    missing = [name for name in REQUIRED_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"Columns that must be there are not: {missing}")
    return df


def stage_projection(df: DataFrame) -> DataFrame:
    """Exactly the eight staging columns, in their stored types."""
    kinds = {field.name: field.dataType for field in STAGING.fields}
    return df.select(
        *[F.col(name).cast(kinds[stored]).alias(stored) for name, stored in STAGING_NAMES.items()]
    )


def staging_valid_rows(staged: DataFrame) -> DataFrame:
    """Staged rows that can enter the warehouse. The filters reach the Parquet reader."""
    return staged.where(
        F.col("customer_id").isNotNull()
        & F.col("stock_code").isNotNull()
        & F.col("invoice_date").isNotNull()
    )
