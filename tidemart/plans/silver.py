"""Cleaned entities: one declaration per source, plus product enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.functions import or_unknown
from tidemart.operators.cleaning import CleanSpec, Field, clean, stamp
from tidemart.operators.skew import Slots, spread_join

# Accepted domains.
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing", "shipped", "delivered", "unavailable", "canceled",
)
EVENT_TYPES = ("view_product", "add_to_cart", "purchase")


def one_of(column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{column} IN ({listed})"


def optional_from_zero(column: str) -> str:
    return f"{column} IS NULL OR {column} >= 0"


CATEGORY_TRANSLATION = CleanSpec(
    source="bronze_category_translation",
    key=("product_category_name",),
    fields=(
        Field("product_category_name", required=True),
        Field("product_category_name_english", required=True),
    ),
)

CUSTOMERS = CleanSpec(
    source="bronze_customers",
    key=("customer_id",),
    fields=(
        Field("customer_id", required=True),
        Field("customer_unique_id", required=True),
        Field("customer_zip_code_prefix", "int", required=True),
        Field("customer_city"),
        Field("customer_state", fold="upper"),
    ),
)

GEOLOCATION = CleanSpec(
    source="bronze_geolocation",
    key=("zip_code_prefix", "city", "state"),
    fields=(
        Field("zip_code_prefix", "int", source="geolocation_zip_code_prefix", required=True),
        Field("geolocation_lat", "double", required=True),
        Field("geolocation_lng", "double", required=True),
        Field("city", source="geolocation_city"),
        Field("state", source="geolocation_state", fold="upper", required=True),
    ),
    rules=("geolocation_lat BETWEEN -90 AND 90", "geolocation_lng BETWEEN -180 AND 180"),
)

ORDERS = CleanSpec(
    source="bronze_orders",
    key=("order_id",),
    fields=(
        Field("order_id", required=True),
        Field("customer_id", required=True),
        Field("order_status", fold="lower"),
        Field("order_purchase_ts", "timestamp", source="order_purchase_timestamp", required=True),
        Field("order_approved_at", "timestamp"),
        Field("order_delivered_carrier_ts", "timestamp", source="order_delivered_carrier_date"),
        Field("order_delivered_customer_ts", "timestamp", source="order_delivered_customer_date"),
        Field("order_estimated_delivery_ts", "timestamp", source="order_estimated_delivery_date"),
    ),
    rules=(one_of("order_status", ORDER_STATUSES),),
    derived={
        "order_purchase_date": "to_date(order_purchase_ts)",
        "order_approved_date": "to_date(order_approved_at)",
        "delivery_delay_days": "datediff(to_date(order_delivered_customer_ts), to_date(order_estimated_delivery_ts))",
    },
)

ORDER_ITEMS = CleanSpec(
    source="bronze_order_items",
    key=("order_id", "order_item_id"),
    fields=(
        Field("order_id", required=True),
        Field("order_item_id", "int", required=True),
        Field("product_id", required=True),
        Field("seller_id", required=True),
        Field("shipping_limit_ts", "timestamp", source="shipping_limit_date"),
        Field("price", "double", required=True),
        Field("freight_value", "double", required=True),
    ),
    rules=("price >= 0", "freight_value >= 0"),
    derived={"item_total_value": "price + freight_value"},
)

ORDER_PAYMENTS = CleanSpec(
    source="bronze_payments",
    key=("order_id", "payment_sequential"),
    fields=(
        Field("order_id", required=True),
        Field("payment_sequential", "int", required=True),
        Field("payment_type", fold="lower", required=True),
        Field("payment_installments", "int"),
        Field("payment_value", "double", required=True),
    ),
    rules=(optional_from_zero("payment_installments"), "payment_value >= 0"),
)

ORDER_REVIEWS = CleanSpec(
    source="bronze_reviews",
    key=("review_id",),
    fields=(
        Field("review_id", required=True),
        Field("order_id", required=True),
        Field("review_score", "int", required=True),
        Field("review_comment_title"),
        Field("review_comment_message"),
        Field("review_creation_ts", "timestamp", source="review_creation_date"),
        Field("review_answer_ts", "timestamp", source="review_answer_timestamp"),
    ),
    rules=("review_score BETWEEN 1 AND 5",),
)

PRODUCT_MEASURES = (
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)

PRODUCTS = CleanSpec(
    source="bronze_products",
    key=("product_id",),
    fields=(
        Field("product_id", required=True),
        Field("product_category_name"),
        Field("product_name_length", "int", source="product_name_lenght"),
        Field("product_description_length", "int", source="product_description_lenght"),
        Field("product_photos_qty", "int"),
        *[Field(m, "double") for m in PRODUCT_MEASURES],
    ),
    rules=tuple(optional_from_zero(m) for m in ("product_photos_qty", *PRODUCT_MEASURES)),
)

SELLERS = CleanSpec(
    source="bronze_sellers",
    key=("seller_id",),
    fields=(
        Field("seller_id", required=True),
        Field("seller_zip_code_prefix", "int", required=True),
        Field("seller_city"),
        Field("seller_state", fold="upper", required=True),
    ),
)

WEB_IDS = ("event_id", "session_id", "user_id", "product_id", "order_id")


def web_fields(marketing_blank_is_null: bool) -> tuple[Field, ...]:
    """The web columns. The quarantine keeps blank marketing text as it is, the clean table turns it into NULL."""

    def loose(name: str, fold: str = "keep") -> Field:
        return Field(name, fold=fold, blank_is_null=marketing_blank_is_null)

    return (
        *[Field(name) for name in WEB_IDS],
        Field("event_time", "timestamp"),
        Field("event_type", fold="lower"),
        Field("quantity", "int"),
        Field("price_at_event", "double"),
        loose("page_url"),
        loose("referrer"),
        loose("utm_source", "lower"),
        loose("utm_medium", "lower"),
        loose("utm_campaign", "lower"),
        loose("campaign_id"),
        loose("device", "lower"),
        loose("browser", "lower"),
        loose("store_channel", "lower"),
    )


WEB_EVENTS = CleanSpec(
    source="bronze_web_events",
    key=("event_id",),
    fields=web_fields(marketing_blank_is_null=True),
    rules=(
        "event_id IS NOT NULL",
        "event_time IS NOT NULL",
        "session_id IS NOT NULL",
        one_of("event_type", EVENT_TYPES),
        "event_type <> 'purchase' OR order_id IS NOT NULL",
        "quantity IS NULL OR quantity > 0",
        optional_from_zero("price_at_event"),
    ),
    derived={
        "event_date": "to_date(event_time)",
        "event_hour": "hour(event_time)",
        "normalized_channel": "coalesce(utm_source, referrer, store_channel)",
    },
)

# Counters are bigint: one campaign day can pass 2^31 impressions at the sizes this is built for.
ADS_CAMPAIGNS = CleanSpec(
    source="bronze_ads_campaigns",
    key=("campaign_date", "campaign_id"),
    fields=(
        Field("campaign_date", "date", source="date", required=True),
        Field("campaign_id", required=True),
        Field("campaign_name", required=True),
        Field("channel", fold="lower"),
        Field("source", fold="lower"),
        Field("medium", fold="lower"),
        Field("impressions", "bigint", required=True),
        Field("clicks", "bigint", required=True),
        Field("conversions", "bigint", required=True),
        Field("cost", "double", required=True),
        Field("currency", fold="upper"),
    ),
    rules=(
        "impressions >= 0",
        "clicks >= 0",
        "conversions >= 0",
        "cost >= 0",
        "clicks <= impressions",
        "conversions <= clicks",
    ),
    derived={
        "ctr": "CASE WHEN impressions > 0 THEN clicks / impressions END",
        "cvr": "CASE WHEN clicks > 0 THEN conversions / clicks END",
        "cpc": "CASE WHEN clicks > 0 THEN cost / clicks END",
    },
)

# Clean table -> how it is made from its bronze source.
CLEAN_TABLES: dict[str, CleanSpec] = {
    "silver_category_translation": CATEGORY_TRANSLATION,
    "silver_customers": CUSTOMERS,
    "silver_geolocation": GEOLOCATION,
    "silver_orders": ORDERS,
    "silver_order_items": ORDER_ITEMS,
    "silver_order_payments": ORDER_PAYMENTS,
    "silver_order_reviews": ORDER_REVIEWS,
    "silver_products": PRODUCTS,
    "silver_sellers": SELLERS,
    "silver_web_events": WEB_EVENTS,
    "silver_ads_campaigns": ADS_CAMPAIGNS,
}


def clean_table(name: str, raw: DataFrame) -> DataFrame:
    return clean(raw, CLEAN_TABLES[name])


def products_enriched(products: DataFrame, translation: DataFrame, hot: Slots | None = None) -> DataFrame:
    """Products with the English category name, ``unknown`` where there is none."""
    names = translation.select("product_category_name", "product_category_name_english")
    joined = spread_join(products, names, "product_category_name", hot, ["product_id"])
    english = or_unknown(joined["product_category_name_english"])
    return stamp(
        joined.withColumn("product_category_name_english", english),
        "silver_products + silver_category_translation",
    )
