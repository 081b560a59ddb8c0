"""Dimensions: natural attributes plus a hash key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import date_key, or_unknown, surrogate_key


def dim_campaign(mapping: DataFrame) -> DataFrame:
    """One row per campaign: best mapping quality, then latest activity, then the smallest texts."""
    texts = ("ads_campaign_name", "utm_campaign", "source", "medium", "channel")
    rank = F.when(F.col("mapping_quality") == "high", 0).when(F.col("mapping_quality") == "medium", 1).otherwise(2)
    best = Window.partitionBy("campaign_id").orderBy(
        rank,
        F.col("last_seen_date").desc_nulls_last(),
        F.col("first_seen_date").asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in texts],
    )
    return (
        mapping.withColumn("_rank", F.row_number().over(best))
        .filter("_rank = 1")
        .select(
            surrogate_key(F.col("campaign_id")).alias("campaign_key"),
            "campaign_id",
            *texts,
            "mapping_quality",
            "first_seen_date",
            "last_seen_date",
        )
    )


def dim_channel(mapping: DataFrame) -> DataFrame:
    parts = mapping.select(
        or_unknown(F.col("channel")).alias("channel_name"),
        or_unknown(F.col("source")).alias("source"),
        or_unknown(F.col("medium")).alias("medium"),
    ).distinct()
    key = surrogate_key(F.col("channel_name"), F.col("source"), F.col("medium"))
    return parts.select(key.alias("channel_key"), "channel_name", "source", "medium")


def customer_lookup(customers: DataFrame) -> DataFrame:
    """Only what the facts need of a customer: the key and the zip prefix."""
    return customers.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"), "customer_id", "customer_zip_code_prefix"
    )


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    history = orders.groupBy("customer_id").agg(
        F.min("order_purchase_date").alias("first_order_date"),
        F.count("order_id").alias("total_orders"),  # order_id is unique in the clean table
    )
    total = F.coalesce("total_orders", F.lit(0))
    return customers.join(history, "customer_id", "left").select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "first_order_date",
        total.alias("total_orders"),
        F.when(total > 1, "repeat").when(total == 1, "new").otherwise("unknown").alias("customer_type"),
    )


def dim_date(orders: DataFrame, web: DataFrame, ads: DataFrame) -> DataFrame:
    """Calendar of all days with an order, a web event or an ad."""
    days = [
        orders.select(F.col("order_purchase_date").alias("full_date")),
        web.select(F.col("event_date").alias("full_date")),
        ads.select(F.col("campaign_date").alias("full_date")),
    ]
    day = F.col("full_date")
    return (
        reduce(DataFrame.unionByName, days)
        .filter(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
        )
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """The clean table already has one row per (zip, city, state), so no further dedupe is needed."""
    key = surrogate_key(F.col("zip_code_prefix"), or_unknown(F.col("city")), or_unknown(F.col("state")))
    return geolocation.select(
        key.alias("geolocation_key"),
        "zip_code_prefix",
        "city",
        "state",
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )


def product_lookup(products: DataFrame) -> DataFrame:
    return products.select(surrogate_key(F.col("product_id")).alias("product_key"), "product_id")


def dim_product(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        surrogate_key(F.col("seller_id")).alias("seller_key"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )
