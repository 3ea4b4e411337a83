"""Line-level business expressions, shared by cleaning and by the fact build."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyhouse.schemas import AMOUNT

# Fixed values of the business rules.
HIGH_QUANTITY = 1000
EXTREME_QUANTITY = 10000
RETURN_PREFIX = "C"
AMOUNT_TOLERANCE = "0.01"


def bad_price(price: Column) -> Column:
    """Price missing, zero or negative."""
    return F.coalesce(price <= 0, F.lit(True))


def high_quantity(quantity: Column) -> Column:
    """Quantity above the limit; a missing quantity is not flagged."""
    return F.coalesce(quantity > HIGH_QUANTITY, F.lit(False))


def cancelled(invoice: Column) -> Column:
    """Invoice number carries the (case-sensitive) cancellation prefix."""
    return F.coalesce(F.startswith(invoice.cast("string"), F.lit(RETURN_PREFIX)), F.lit(False))


def returned(invoice: Column, quantity: Column) -> Column:
    """Cancellation invoice or negative quantity; never null."""
    return cancelled(invoice) | F.coalesce(quantity < 0, F.lit(False))


def line_amount(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(AMOUNT)


def amount_is_off(amount: Column, quantity: Column, price: Column) -> Column:
    """Stored amount differs from quantity x price by more than the tolerance."""
    return F.abs(amount - quantity * price) > F.lit(AMOUNT_TOLERANCE).cast("decimal(3,2)")
