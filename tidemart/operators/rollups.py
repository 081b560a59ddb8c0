"""Per-order totals shared by the order fact and the payment reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import money_sum


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        money_sum(F.col("price")).alias("items_price_total"),
        money_sum(F.col("freight_value")).alias("freight_total"),
        money_sum(F.col("item_total_value")).alias("items_grand_total"),
    )


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_record_count"),
        money_sum(F.col("payment_value")).alias("payment_total"),
    )


def event_type_count(event_type: str):
    return F.count_if(F.col("event_type") == event_type)
