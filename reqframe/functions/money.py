"""Exact decimal costs. Prices are per token with 15 fraction digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(18,15)"
COST = "decimal(38,15)"


def cost(prompt: Column, completion: Column, input_price: Column, output_price: Column) -> Column:
    """Row cost, NULL when a price is missing; missing token counts are 0.

    ``DECIMAL(18,15) * DECIMAL(18,0)`` is exactly ``DECIMAL(37,15)``. A BIGINT factor would be
    widened to 20 digits and cost fraction digits.
    """

    def part(tokens: Column, price: Column) -> Column:
        return price.cast(PRICE) * F.coalesce(tokens, F.lit(0)).cast("decimal(18,0)")

    return (part(prompt, input_price) + part(completion, output_price)).cast(COST)


def cost_text(amount: Column | str) -> Column:
    """Plain decimal text with all 15 fraction digits, as reports carry it."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.call_function("format_number", amount, F.lit("0.000000000000000"))
