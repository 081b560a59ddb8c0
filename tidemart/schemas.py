"""Column types of the eleven sources, as they lie in the landing files and in the bronze tables."""

from __future__ import annotations

# Nine CSV sources. The misspelt product columns are in the files.
CSV_SOURCES: dict[str, str] = {
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
        "customer_state string"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, "
        "geolocation_state string"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
        "price double, freight_value double"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value double"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
        "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double"
    ),
    "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}

# Two JSON sources. Times and dates are text until they are parsed on ingest.
WEB_EVENTS_JSON = (
    "event_id string, event_time string, session_id string, user_id string, event_type string, product_id string, "
    "order_id string, quantity int, price_at_event double, page_url string, referrer string, utm_source string, "
    "utm_medium string, utm_campaign string, campaign_id string, device string, browser string, "
    "store_channel string"
)
ADS_JSON = (
    "date string, campaign_id string, campaign_name string, channel string, source string, medium string, "
    "impressions bigint, clicks bigint, conversions bigint, cost double, currency string"
)

# Typed bronze targets of the two JSON sources.
BRONZE_WEB_EVENTS = (
    WEB_EVENTS_JSON.replace("event_time string", "event_time timestamp")
    + ", ingestion_time timestamp, source_file string"
)
BRONZE_ADS = ADS_JSON.replace("date string", "date date") + ", ingestion_time timestamp, source_api string"
