"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import date_key, flag, guarded_ratio, or_unknown, surrogate_key
from tidemart.operators.rollups import event_type_count, order_item_totals, order_payment_totals
from tidemart.operators.skew import HotKeys, Slots, spread_join

# Order totals. Wide enough for an order with a very large number of items.
MONEY = "decimal(18,2)"

ORDER_TIMES = (
    "order_purchase_ts", "order_approved_at", "order_delivered_carrier_ts",
    "order_delivered_customer_ts", "order_estimated_delivery_ts",
)


# What a fact can show of a place besides its key. It comes with the zip lookup, so no fact is joined by place.
PLACE_COLUMNS = ("place_city", "place_state")


def one_place_per_zip(geolocation: DataFrame) -> DataFrame:
    """The place with the smallest city, then state, for each zip prefix."""
    place = F.struct("city", "state", "geolocation_key")
    return geolocation.groupBy("zip_code_prefix").agg(F.min(place).alias("p")).select("zip_code_prefix", "p.*")


def with_places(
    df: DataFrame, zip_column: str, geolocation: DataFrame, spread_by: str, hot: Slots | None, geo_per_zip: bool
) -> DataFrame:
    """Adds ``geolocation_key``, ``place_city`` and ``place_state`` by zip prefix.

    A zip prefix that covers several cities gives one row per city, which is the defined result. Resolving places
    on the customer or seller table, before the facts join it, moves no fact row by zip.
    """
    places = one_place_per_zip(geolocation) if geo_per_zip else geolocation
    places = places.select(F.col("zip_code_prefix").alias(zip_column), "geolocation_key", F.col("city").alias("place_city"), F.col("state").alias("place_state"))
    return spread_join(df, places, zip_column, hot, [spread_by])


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    geolocation: DataFrame,
    hot: HotKeys | None = None,
    geo_per_zip: bool = False,
    show_place: bool = False,
) -> DataFrame:
    """Order-level values, payment totals and delivery columns.

    ``customers`` needs customer_key, customer_id and the zip prefix; ``hot`` may hold the measured hot keys of
    ``customer_id`` (orders) and ``customer_zip_code_prefix`` (customers).
    """
    hot = hot or {}
    who = with_places(
        customers.select("customer_key", "customer_id", "customer_zip_code_prefix"),
        "customer_zip_code_prefix",
        geolocation,
        "customer_id",
        hot.get("customer_zip_code_prefix"),
        geo_per_zip,
    )
    valued = orders.join(order_item_totals(items), "order_id", "left").join(
        order_payment_totals(payments), "order_id", "left"
    )
    joined = spread_join(valued, who, "customer_id", hot.get("customer_id"), ["order_id"])
    zero = F.lit(0)

    def money(name: str) -> Column:
        return F.round(F.coalesce(F.col(name), zero.cast("decimal(28,4)")), 2)

    paid, ordered = (F.coalesce(F.col(c), zero) for c in ("payment_total", "items_grand_total"))
    return joined.select(
        "order_id",
        date_key(F.col("order_purchase_date")).alias("order_date_key"),
        "customer_key",
        "customer_id",
        F.col("geolocation_key").alias("customer_geolocation_key"),
        "order_status",
        F.coalesce("item_count", zero).alias("item_count"),
        money("items_price_total").cast(MONEY).alias("items_price_total"),
        money("freight_total").cast(MONEY).alias("freight_total"),
        money("items_grand_total").cast(MONEY).alias("gross_order_value"),
        F.coalesce("payment_record_count", zero).alias("payment_record_count"),
        money("payment_total").cast(MONEY).alias("payment_total"),
        F.round(paid - ordered, 2).cast("double").alias("difference_amount"),
        flag(F.col("order_status") == "delivered").alias("is_delivered"),
        flag(F.col("order_status") == "canceled").alias("is_canceled"),
        "delivery_delay_days",
        *ORDER_TIMES,
        *(PLACE_COLUMNS if show_place else ()),
    )


def fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    geolocation: DataFrame,
    hot: HotKeys | None = None,
    geo_per_zip: bool = False,
    show_place: bool = False,
) -> DataFrame:
    """Item-level values with product, seller and seller place.

    ``products`` needs product_key and product_id; ``sellers`` the key, id and zip prefix. ``hot`` may hold the
    measured hot keys of the three item columns and of ``seller_zip_code_prefix``.
    """
    hot = hot or {}
    sold_by = with_places(
        sellers.select("seller_key", "seller_id", "seller_zip_code_prefix"),
        "seller_zip_code_prefix",
        geolocation,
        "seller_id",
        hot.get("seller_zip_code_prefix"),
        geo_per_zip,
    )
    item = ["order_id", "order_item_id"]
    joined = items.select(
        *item, "product_id", "seller_id", "price", "freight_value", "item_total_value", "shipping_limit_ts"
    )
    lookups = {
        "order_id": orders.select("order_id", "order_purchase_date", "order_status"),
        "product_id": products.select("product_key", "product_id"),
        "seller_id": sold_by,
    }
    for key, lookup in lookups.items():
        joined = spread_join(joined, lookup, key, hot.get(key), item)
    return joined.select(
        *item,
        date_key(F.col("order_purchase_date")).alias("order_date_key"),
        "product_key",
        "product_id",
        "seller_key",
        "seller_id",
        F.col("geolocation_key").alias("seller_geolocation_key"),
        "price",
        "freight_value",
        F.round(F.col("item_total_value").cast("decimal(18,4)"), 2).cast("decimal(12,2)").alias("item_total_value"),
        "shipping_limit_ts",
        "order_status",
        *(PLACE_COLUMNS if show_place else ()),
    )


def _days_between(start: str, end: str) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def fact_order_logistics(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    geolocation: DataFrame,
    as_of: Column | None = None,
    hot: HotKeys | None = None,
    geo_per_zip: bool = False,
    show_place: bool = False,
) -> DataFrame:
    """Delivery lead times and flags per order. ``as_of`` is the day that decides what is still open and late."""
    hot = hot or {}
    today = F.current_date() if as_of is None else as_of
    who = with_places(
        customers.select("customer_key", "customer_id", "customer_zip_code_prefix"),
        "customer_zip_code_prefix",
        geolocation,
        "customer_id",
        hot.get("customer_zip_code_prefix"),
        geo_per_zip,
    )
    parties = items.groupBy("order_id").agg(
        F.count_distinct("seller_id").alias("seller_count"),
        F.count_distinct("product_id").alias("product_count"),
    )
    joined = spread_join(
        orders.join(parties, "order_id", "left"), who, "customer_id", hot.get("customer_id"), ["order_id"]
    )
    wait = F.unix_timestamp("order_approved_at") - F.unix_timestamp("order_purchase_ts")
    delay = _days_between("order_estimated_delivery_ts", "order_delivered_customer_ts")
    open_late = F.col("order_delivered_customer_ts").isNull() & (today > F.to_date("order_estimated_delivery_ts"))
    return joined.select(
        "order_id",
        date_key(F.col("order_purchase_date")).alias("order_date_key"),
        "customer_key",
        "customer_id",
        F.col("geolocation_key").alias("customer_geolocation_key"),
        "order_status",
        *ORDER_TIMES,
        F.coalesce("seller_count", F.lit(0)).alias("seller_count"),
        F.coalesce("product_count", F.lit(0)).alias("product_count"),
        F.round(wait / F.lit(3600.0), 2).alias("approval_lead_time_hours"),
        _days_between("order_approved_at", "order_delivered_carrier_ts").alias("handover_lead_time_days"),
        _days_between("order_delivered_carrier_ts", "order_delivered_customer_ts").alias("last_mile_lead_time_days"),
        _days_between("order_purchase_ts", "order_delivered_customer_ts").alias("delivery_lead_time_days"),
        delay.alias("delivery_delay_days"),
        flag(F.col("order_status") == "delivered").alias("is_delivered"),
        flag(F.col("order_status") == "canceled").alias("is_canceled"),
        flag(open_late).alias("is_open_late"),
        flag(delay > 0).alias("is_late_delivery"),
        *(PLACE_COLUMNS if show_place else ()),
    )


def fact_marketing_spend_daily(ads: DataFrame, campaigns: DataFrame) -> DataFrame:
    keys = campaigns.select("campaign_id", "campaign_key")
    return ads.join(keys, "campaign_id", "left").select(
        date_key(F.col("campaign_date")).alias("date_key"),
        "campaign_key",
        "campaign_id",
        "campaign_name",
        "channel",
        "source",
        "medium",
        "impressions",
        "clicks",
        "conversions",
        "cost",
        "currency",
        F.round("ctr", 4).cast("decimal(6,4)").alias("ctr"),
        F.round("cvr", 4).cast("decimal(6,4)").alias("cvr"),
        F.round("cpc", 2).cast("decimal(10,2)").alias("cpc"),
    )


def fact_web_funnel_daily(
    web: DataFrame, campaigns: DataFrame, channels: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Daily funnel per campaign, channel and device.

    The channel of an event follows from its campaign's channel, source and medium (``unknown`` where missing), so
    events look up only the campaign; the rolled-up rows then check which channels exist. The two distinct counts
    are spread by session and user before they meet in their group.
    """
    attributes = [F.col("channel"), F.col("source"), F.col("medium")]
    lookup = campaigns.select(
        "campaign_id", "campaign_key", surrogate_key(*[or_unknown(c) for c in attributes]).alias("channel_key")
    )
    no_campaign = surrogate_key(*[F.lit("unknown")] * len(attributes))
    events = web.select("event_id", "event_date", "event_type", "session_id", "user_id", "campaign_id", "device")
    keyed = spread_join(events, lookup, "campaign_id", (hot or {}).get("campaign_id"), ["event_id"])
    daily = keyed.groupBy(
        "event_date",
        "campaign_key",
        F.coalesce("channel_key", no_campaign).alias("wanted_key"),
        or_unknown(F.col("device")).alias("device"),
    ).agg(
        event_type_count("view_product").alias("view_product_count"),
        event_type_count("add_to_cart").alias("add_to_cart_count"),
        event_type_count("purchase").alias("purchase_event_count"),
        F.count_distinct("session_id").alias("session_count"),
        F.count_distinct("user_id").alias("user_count"),
    )
    known = channels.select("channel_key")
    return daily.join(known, daily["wanted_key"] == known["channel_key"], "left").select(
        date_key(F.col("event_date")).alias("date_key"),
        "campaign_key",
        "channel_key",
        "device",
        "view_product_count",
        "add_to_cart_count",
        "purchase_event_count",
        "session_count",
        "user_count",
        guarded_ratio(F.col("purchase_event_count"), F.col("view_product_count")).alias("funnel_conversion_rate"),
    )
