"""Data preparation: from orders to web events and daily ads counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import hash_bucket, or_unknown, session_id
from tidemart.operators.rollups import event_type_count
from tidemart.operators.skew import HotKeys, spread_join
from tidemart.sources.campaigns import CAMPAIGNS, campaign_lookup

# Web event time text, with a literal Z.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Event kind, id part, seconds before the purchase. The offsets are the shortest ones the source uses.
EVENT_KINDS = (("view_product", "view", 1800), ("add_to_cart", "cart", 300), ("purchase", "purchase", 0))

# Ads counters per web event. The last three stand for random factors of the source.
CLICKS_PER_VIEW = 0.28
IMPRESSIONS_PER_VIEW = 12
COST_PER_CLICK = "0.75"
COST_PER_CONVERSION = "2.00"

# Channel label by utm source; any other source is Email.
CHANNEL_LABELS = {"google": "Google", "facebook": "Facebook", "instagram": "Instagram", "tiktok": "TikTok"}
OTHER_CHANNEL = "Email"


def payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum(F.col("payment_value").cast("decimal(18,4)")).cast("double").alias("payment_value"),
        F.max("payment_type").alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
    )


def order_item_base(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    translation: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One row per order item with its order, customer, product, payment and English category."""
    hot = hot or {}
    item = ["order_id", "order_item_id"]
    dated = orders.filter(F.col("order_purchase_timestamp").isNotNull())
    bought = dated.join(payment_rollup(payments), "order_id", "left")
    placed = spread_join(
        bought,
        customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state"),
        "customer_id",
        hot.get("customer_id"),
        ["order_id"],
        "inner",
    )
    described = spread_join(
        products,
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        hot.get("product_category_name"),
        ["product_id"],
    )
    # The items meet their products first: a product is narrower than an order with its customer and payment, and the rows
    # of the first join are moved again for the second one.
    named = spread_join(items, described, "product_id", hot.get("product_id"), item)
    lines = spread_join(named, placed, "order_id", hot.get("order_id"), item, "inner")
    keys = ["product_id", "order_id"]
    return lines.select(*keys, *[c for df in (items, placed, described) for c in df.columns if c not in keys])


def with_campaign(base: DataFrame) -> DataFrame:
    """Assigns one of the fixed campaigns by the hash of the English category name."""
    named = base.withColumn("product_category_name_en", or_unknown(F.col("product_category_name_english")))
    bucket = hash_bucket(F.col("product_category_name_en"), len(CAMPAIGNS))
    lookup = F.broadcast(campaign_lookup(base.sparkSession))  # six fixed rows
    return named.withColumn("campaign_bucket", bucket).join(lookup, "campaign_bucket", "left")


def expand_to_events(base: DataFrame) -> DataFrame:
    """View, cart and purchase event of every item, in one pass over the items."""
    purchase = F.col("order_purchase_timestamp").cast("timestamp")
    kinds = [
        F.struct(
            F.lit(kind).alias("event_type"),
            F.concat_ws("_", F.lit("evt"), F.lit(part), "order_id", F.col("order_item_id").cast("string")).alias(
                "event_id"
            ),
            F.timestamp_seconds(F.unix_timestamp(purchase) - before).alias("event_time_ts"),
        )
        for kind, part, before in EVENT_KINDS
    ]
    tags = ("referrer", "utm_source", "utm_medium", "utm_campaign", "campaign_id", "store_channel")
    return base.select("*", F.explode(F.array(*kinds)).alias("event")).select(
        "event.event_id",
        F.date_format("event.event_time_ts", EVENT_TIME_FORMAT).alias("event_time"),
        session_id(F.col("customer_unique_id"), F.col("order_id"), F.col("product_id")).alias("session_id"),
        F.col("customer_unique_id").alias("user_id"),
        "event.event_type",
        "product_id",
        "order_id",
        F.lit(1).alias("quantity"),
        F.col("price").cast("double").alias("price_at_event"),
        F.concat(F.lit("/product/"), "product_id").alias("page_url"),
        *tags,
    )


def campaign_name(campaign_id: Column) -> Column:
    """Display name; ids outside the fixed list take the last one."""
    *listed, last = CAMPAIGNS
    label = F
    for c in listed:
        label = label.when(campaign_id == c.campaign_id, c.campaign_name)
    return label.otherwise(last.campaign_name)


def channel_name(utm_source: Column) -> Column:
    label = F
    for source, name in CHANNEL_LABELS.items():
        label = label.when(utm_source == source, name)
    return label.otherwise(OTHER_CHANNEL)


def campaign_day_counts(events: DataFrame) -> DataFrame:
    """Views, additions to the cart and purchases per day, campaign and tags."""
    return events.groupBy(
        F.to_date("event_time").alias("date"), "campaign_id", "utm_campaign", "utm_source", "utm_medium"
    ).agg(
        event_type_count("view_product").alias("views"),
        event_type_count("add_to_cart").alias("adds"),
        event_type_count("purchase").alias("conversions"),
    )


def rollup_ads_daily(events: DataFrame) -> DataFrame:
    """Daily ads counters per campaign and tags, derived from web events with a timestamp ``event_time``."""
    counts = campaign_day_counts(events)
    clicks = F.greatest(F.floor(F.col("views") * CLICKS_PER_VIEW) + F.col("adds"), F.col("conversions") + 1)
    cost = F.col("clicks") * F.lit(COST_PER_CLICK).cast("decimal(4,2)") + F.col("conversions") * F.lit(
        COST_PER_CONVERSION
    ).cast("decimal(4,2)")
    return counts.withColumn("clicks", clicks).select(
        "date",
        "campaign_id",
        campaign_name(F.col("campaign_id")).alias("campaign_name"),
        channel_name(F.col("utm_source")).alias("channel"),
        F.col("utm_source").alias("source"),
        F.col("utm_medium").alias("medium"),
        F.greatest(F.col("views") * IMPRESSIONS_PER_VIEW, F.col("clicks") + 10).alias("impressions"),
        "clicks",
        "conversions",
        F.round(cost, 2).cast("double").alias("cost"),
        F.lit("USD").alias("currency"),
    )
