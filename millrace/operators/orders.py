"""Raw orders to checked orders, and the daily mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.expectations import Rule, keep_valid

ORDER_RULES = [
    Rule("valid_price", "o_totalprice > 0", drop=True),
    Rule("valid_order_key", "o_orderkey IS NOT NULL", drop=True),
    Rule("known_status", "o_orderstatus IN ('F','O','P')"),
]

MONEY = "decimal(18,2)"


def land_orders(orders: DataFrame, source_system: str, ingest_time: Column | None = None) -> DataFrame:
    """Orders as they came, with when and where from. No business logic."""
    return orders.withColumns(
        {
            "ingest_time": F.current_timestamp() if ingest_time is None else ingest_time,
            "source_system": F.lit(source_system),
        }
    )


def order_status(code: Column) -> Column:
    return F.when(code == "F", "Fulfilled").when(code == "O", "Open").otherwise("Unknown")


def normalize_orders(orders: DataFrame) -> DataFrame:
    """Add the readable status, and hold prices as exact decimals so that sums do not depend on their order."""
    return orders.withColumns(
        {"order_status": order_status(F.col("o_orderstatus")), "o_totalprice": F.col("o_totalprice").cast(MONEY)}
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    return normalize_orders(keep_valid(orders, ORDER_RULES))


def daily_sales(orders: DataFrame) -> DataFrame:
    return orders.groupBy(
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
        F.dayofmonth("o_orderdate").alias("order_day"),
    ).agg(
        F.sum("o_totalprice").cast(MONEY).alias("total_sales"),
        F.count("o_orderkey").alias("order_count"),
    )


def first_days(mart: DataFrame, n: int) -> DataFrame:
    """The earliest ``n`` days of the mart."""
    return mart.orderBy("order_year", "order_month", "order_day").limit(n)
