"""Building the star schema from the staging table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.frames import side_by_side
from tallyhouse.functions.stamps import ntz
from tallyhouse.operators.dimensions import country_rows, customer_rows, product_rows, time_rows
from tallyhouse.operators.fact import fact_rows
from tallyhouse.operators.keys import with_dense_key
from tallyhouse.schemas import DIMENSION_KEYS, NATURAL_KEYS, STAGING
from tallyhouse.session import Relay, new_folder, small_splits, together
from tallyhouse.sources.landing import staging_valid_rows
from tallyhouse.sources.tables import load_dimension, load_fact


@dataclass(frozen=True)
class Star:
    """The written star schema."""

    time: DataFrame
    country: DataFrame
    product: DataFrame
    customer: DataFrame
    fact: DataFrame

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {
            "dim_time": self.time,
            "dim_country": self.country,
            "dim_product": self.product,
            "dim_customer": self.customer,
        }

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {**self.dimensions, "fact_sales": self.fact}


def build_star(
    staged: DataFrame, root: str | None = None, as_of: datetime | None = None
) -> Star:
    """Write four dimensions and the fact below ``root`` and return them as read back.

    Each table is written once and read by everything after it, so later stages
    see measured sizes and lost executors cost no rebuild of earlier ones.
    """
    root = root or new_folder(staged.sparkSession, "star")
    usable = staging_valid_rows(staged).select(*STAGING.names)

    def dimension(table: str, rows: DataFrame) -> DataFrame:
        keyed = with_dense_key(rows, NATURAL_KEYS[table], DIMENSION_KEYS[table])
        return load_dimension(keyed, table, f"{root}/{table}", as_of=as_of).frame

    def country_then_customer() -> tuple[DataFrame, DataFrame]:
        country = dimension("dim_country", country_rows(usable))
        return country, dimension("dim_customer", customer_rows(usable, country))

    built = together(
        time=lambda: dimension("dim_time", time_rows(usable)),
        product=lambda: dimension("dim_product", product_rows(usable)),
        places=country_then_customer,
    )
    time, product = built["time"], built["product"]
    country, customer = built["places"]
    relay = Relay(staged.sparkSession, "fact-step")
    with small_splits(staged.sparkSession):
        rows = fact_rows(usable, time, country, product, customer, relay.step)
    fact = load_fact(rows, f"{root}/fact_sales", as_of=as_of).frame
    relay.end()
    return Star(time, country, product, customer, fact)


def build_stats(staged: DataFrame, star: Star, as_of: datetime | None = None) -> DataFrame:
    """One row: rows staged, rows per dimension, fact rows."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    stats = side_by_side(
        rows(staging_valid_rows(staged), "staging_rows"),
        rows(star.time, "dim_time_rows"),
        rows(star.country, "dim_country_rows"),
        rows(star.product, "dim_product_rows"),
        rows(star.customer, "dim_customer_rows"),
        rows(star.fact, "fact_rows"),
    )
    return stats if as_of is None else stats.withColumn("completion_time", ntz(as_of))
