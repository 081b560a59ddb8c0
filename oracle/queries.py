"""SQL for each named query."""

from __future__ import annotations

from oracle.tables import TABLES, ads_rollup, kpi, sales_marketing, statement, web_columns

REASONS = """CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN event_time IS NULL THEN 'invalid_or_missing_event_time'
 WHEN session_id IS NULL THEN 'missing_session_id'
 WHEN event_type NOT IN ('view_product','add_to_cart','purchase') THEN 'invalid_event_type'
 WHEN event_type = 'purchase' AND order_id IS NULL THEN 'purchase_missing_order_id'
 WHEN quantity <= 0 THEN 'invalid_quantity' WHEN price_at_event < 0 THEN 'invalid_price_at_event' {more} END"""


def quarantine(more: str = "") -> str:
    columns = ", ".join(web_columns(keep_blank=True))
    return f"""SELECT * FROM (SELECT *, {REASONS.format(more=more)} AS error_reason
 FROM (SELECT {columns}, ingestion_time, source_file FROM b_web)) WHERE error_reason IS NOT NULL"""


def orphans(check: str, table: str, alias: str, column: str, target: str, record: str) -> str:
    return f"""SELECT '{check}' AS check_name, '{table}' AS source_table, {record} AS record_key,
 s.{column} AS missing_reference_key, '{column}_not_found' AS issue_type
FROM {alias} s LEFT JOIN (SELECT DISTINCT {column} FROM {target}) t ON s.{column} = t.{column}
WHERE t.{column} IS NULL AND s.{column} IS NOT NULL"""


ITEM = "s.order_id || '-' || order_item_id"
CHECKS = (
    ("orders_to_customers", "silver_orders", "s_orders", "customer_id", "s_customers", "order_id"),
    ("order_items_to_orders", "silver_order_items", "s_order_items", "order_id", "s_orders", ITEM),
    ("order_items_to_products", "silver_order_items", "s_order_items", "product_id", "s_products", ITEM),
    ("order_items_to_sellers", "silver_order_items", "s_order_items", "seller_id", "s_sellers", ITEM),
    ("payments_to_orders", "silver_order_payments", "s_payments", "order_id", "s_orders",
     "s.order_id || '-' || payment_sequential"),
    ("reviews_to_orders", "silver_order_reviews", "s_reviews", "order_id", "s_orders", "review_id"),
    ("web_events_to_orders", "silver_web_events", "s_web", "order_id", "s_orders", "event_id"),
    ("web_events_to_products", "silver_web_events", "s_web", "product_id", "s_products", "event_id"),
)

FACT_ORDERS = "SELECT * EXCLUDE (zip_code_prefix) FROM f_orders"

ONE_PLACE_ROWS = """SELECT * FROM f_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY place_city NULLS FIRST, place_state NULLS FIRST) = 1"""
ONE_PLACE = f"SELECT * EXCLUDE (zip_code_prefix, has_customer) FROM ({ONE_PLACE_ROWS})"

FACT_ITEMS = """
SELECT i.order_id, order_item_id, CAST(strftime(order_purchase_date, '%Y%m%d') AS INT) AS order_date_key,
 i.product_id, p.product_id IS NOT NULL AS has_product, i.seller_id, s.seller_id IS NOT NULL AS has_seller,
 place_city, place_state, price, freight_value,
 CAST(round(CAST(item_total_value AS DECIMAL(18,4)), 2) AS DECIMAL(12,2)) AS item_total_value, shipping_limit_ts,
 order_status
FROM s_order_items i LEFT JOIN s_orders o ON i.order_id = o.order_id
LEFT JOIN s_products p ON i.product_id = p.product_id LEFT JOIN s_sellers s ON i.seller_id = s.seller_id
LEFT JOIN geo_of_zip ON seller_zip_code_prefix = zip_code_prefix"""


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INT)"


LATE = days("order_estimated_delivery_ts", "order_delivered_customer_ts")
LOGISTICS = f"""
SELECT f.order_id, order_date_key, f.customer_id, has_customer, place_city, place_state, order_status,
 order_purchase_ts, order_approved_at, order_delivered_carrier_ts, order_delivered_customer_ts,
 order_estimated_delivery_ts, coalesce(seller_count, 0) AS seller_count, coalesce(product_count, 0) AS product_count,
 CAST(round(CAST(date_diff('second', order_purchase_ts, order_approved_at) / 3600.0::DOUBLE AS DECIMAL(38,8)), 2)
  AS DOUBLE) AS approval_lead_time_hours,
 {days("order_approved_at", "order_delivered_carrier_ts")} AS handover_lead_time_days,
 {days("order_delivered_carrier_ts", "order_delivered_customer_ts")} AS last_mile_lead_time_days,
 {days("order_purchase_ts", "order_delivered_customer_ts")} AS delivery_lead_time_days,
 {LATE} AS delivery_delay_days, is_delivered, is_canceled,
 CASE WHEN order_delivered_customer_ts IS NULL AND DATE '2001-06-30' > CAST(order_estimated_delivery_ts AS DATE)
  THEN 1 ELSE 0 END AS is_open_late,
 CASE WHEN {LATE} > 0 THEN 1 ELSE 0 END AS is_late_delivery
FROM f_orders f LEFT JOIN (SELECT order_id, count(DISTINCT seller_id) AS seller_count,
 count(DISTINCT product_id) AS product_count FROM s_order_items GROUP BY order_id) n ON f.order_id = n.order_id"""

MART_KPI = f"""
SELECT date_key, campaign_id, channel, impressions, clicks, cost AS ad_spend, sessions, add_to_carts, purchase_events,
 orders, revenue, {kpi("clicks", "impressions", 4)} AS ctr, {kpi("cost", "clicks", 2)} AS cpc,
 {kpi("cost", "impressions", 2, " * 1000")} AS cpm, {kpi("add_to_carts", "sessions", 4)} AS session_to_cart_rate,
 {kpi("purchase_events", "add_to_carts", 4)} AS cart_to_purchase_rate,
 {kpi("purchase_events", "sessions", 4)} AS session_to_purchase_rate, {kpi("revenue", "orders", 2)} AS aov,
 {kpi("revenue", "cost", 4)} AS roas, {kpi("cost", "orders", 2)} AS cost_per_order
FROM m_sales"""

# Averages of cents are rounded half up in whole numbers.
MART_CUSTOMER = """
SELECT g.place_city, g.place_state, c.customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
 coalesce(total_orders, 0) AS total_orders, coalesce(CAST(total_revenue AS DOUBLE), 0.0) AS total_revenue,
 coalesce(CAST((CAST(total_revenue * 100 AS BIGINT) * 2 + n) // (2 * n) AS DOUBLE) / 100, 0.0) AS avg_order_value,
 CAST(coalesce(delivered_order_count, 0) AS BIGINT) AS delivered_order_count,
 CAST(coalesce(canceled_order_count, 0) AS BIGINT) AS canceled_order_count, first_order_date_key,
 last_order_date_key, CAST(round(CAST(avg_review_score AS DECIMAL(38,8)), 2) AS DOUBLE) AS avg_review_score,
 coalesce(review_count, 0) AS review_count, CASE WHEN total_orders > 1 THEN 1 ELSE 0 END AS is_repeat_customer,
 CASE WHEN total_revenue >= 500 THEN 'high_value' WHEN total_revenue >= 200 THEN 'mid_value'
  WHEN total_revenue > 0 THEN 'low_value' ELSE 'no_purchase' END AS customer_segment
FROM s_customers c
LEFT JOIN (SELECT customer_id, place_city AS city, place_state AS state, count(DISTINCT order_id) AS total_orders,
 sum(payment_total) AS total_revenue, count(*) AS n, sum(is_delivered) AS delivered_order_count,
 sum(is_canceled) AS canceled_order_count, min(order_date_key) AS first_order_date_key,
 max(order_date_key) AS last_order_date_key FROM f_orders WHERE has_customer GROUP BY 1, 2, 3) m
 ON c.customer_id = m.customer_id
LEFT JOIN (SELECT customer_id, avg(review_score) AS avg_review_score, count(review_id) AS review_count
 FROM s_orders o LEFT JOIN s_reviews r ON o.order_id = r.order_id GROUP BY customer_id) r
 ON c.customer_id = r.customer_id
LEFT JOIN geo_of_zip g ON customer_zip_code_prefix = g.zip_code_prefix"""

ONE_GEO = """(SELECT * FROM geo_of_zip QUALIFY row_number() OVER (PARTITION BY zip_code_prefix
 ORDER BY place_city NULLS FIRST, place_state NULLS FIRST) = 1)"""
MART_CUSTOMER_ONE_PLACE = MART_CUSTOMER.replace("FROM f_orders WHERE", f"FROM ({ONE_PLACE_ROWS}) WHERE").replace(
    "LEFT JOIN geo_of_zip g", f"LEFT JOIN {ONE_GEO} g"
)

KEYS = " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, count(*) AS row_count, count(*) AS key_count FROM {table}"
    for name, table in (
        ("dim_campaign", "d_campaign"),
        ("dim_channel", "d_channel"),
        ("dim_customer", "s_customers"),
        ("dim_geolocation", "s_geolocation"),
        ("dim_product", "s_products"),
        ("dim_seller", "s_sellers"),
    )
)

ROLLUP = """SELECT order_id, CAST(sum(CAST(payment_value AS DECIMAL(18,4))) AS DOUBLE) AS payment_value,
 max(payment_type) AS payment_type, max(payment_installments) AS payment_installments FROM b_payments GROUP BY order_id"""

BASE = f"""
SELECT o.* EXCLUDE (ingestion_time, source_file), customer_unique_id, customer_city, customer_state,
 i.* EXCLUDE (order_id, ingestion_time, source_file), p.* EXCLUDE (product_id, ingestion_time, source_file),
 pay.* EXCLUDE (order_id), t.product_category_name_english
FROM b_orders o JOIN (SELECT * REPLACE (trim(customer_id) AS customer_id) FROM b_customers) c
 ON o.customer_id = c.customer_id JOIN b_order_items i ON o.order_id = i.order_id
LEFT JOIN b_products p ON i.product_id = p.product_id LEFT JOIN ({ROLLUP}) pay ON o.order_id = pay.order_id
LEFT JOIN s_categories t ON p.product_category_name = t.product_category_name
WHERE order_purchase_timestamp IS NOT NULL"""

SESSION = "'sess_' || substring(md5(concat_ws('||', customer_unique_id, order_id, product_id)), 1, 12) AS session_id"

EVENTS = f"""
SELECT concat_ws('_', 'evt', part, order_id, order_item_id) AS event_id,
 strftime(order_purchase_timestamp - to_seconds(before), '%Y-%m-%dT%H:%M:%SZ') AS event_time, {SESSION},
 customer_unique_id AS user_id, event_type, product_id, order_id, 1 AS quantity, price AS price_at_event,
 '/product/' || product_id AS page_url
FROM ({BASE}), (VALUES ('view_product', 'view', 1800), ('add_to_cart', 'cart', 300), ('purchase', 'purchase', 0))
 AS k(event_type, part, before)"""

LABELS = f"""SELECT campaign_id, utm_source, campaign_name, channel, count(*) AS event_count
FROM (SELECT campaign_id, utm_source, CASE campaign_id WHEN 'cmp_001' THEN 'Search - Electronics'
  WHEN 'cmp_002' THEN 'Social - Home & Living' WHEN 'cmp_003' THEN 'Retargeting - Marketplace'
  WHEN 'cmp_004' THEN 'CRM - High Intent' WHEN 'cmp_005' THEN 'Search - Fashion' ELSE 'Social - Baby & Toys' END
  AS campaign_name, CASE utm_source WHEN 'google' THEN 'Google' WHEN 'facebook' THEN 'Facebook'
  WHEN 'instagram' THEN 'Instagram' WHEN 'tiktok' THEN 'TikTok' ELSE 'Email' END AS channel FROM s_web) GROUP BY ALL"""

# The blank event ids are one key of the raw table; its latest row has the highest other columns in their order.
WEB_ORDER = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in (
        "event_time", "session_id", "user_id", "event_type", "product_id", "order_id", "quantity", "price_at_event",
        "page_url", "referrer", "utm_source", "utm_medium", "utm_campaign", "campaign_id", "device", "browser",
        "store_channel",
    )
)
LATEST_WEB = f"""SELECT * FROM b_web
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY coalesce(event_time < ingestion_time, false) DESC, {WEB_ORDER}) = 1"""
LATEST_ADS = """SELECT * FROM b_ads WHERE date IS NOT NULL AND campaign_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY date, campaign_id ORDER BY campaign_name DESC NULLS LAST,
 channel DESC NULLS LAST, source DESC NULLS LAST, medium DESC NULLS LAST, impressions DESC NULLS LAST,
 clicks DESC NULLS LAST, conversions DESC NULLS LAST, cost DESC NULLS LAST, currency DESC NULLS LAST) = 1"""
WEB_COPIES = "SELECT event_id, coalesce(event_time < ingestion_time, false) AS is_late FROM b_web"

# Columns of the nine CSV sources as they land.
CSV_TABLES = {
    "customers": ("b_customers", "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"),
    "geolocation": ("b_geolocation", "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state"),
    "orders": ("b_orders", "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"),
    "order_items": ("b_order_items", "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
    "payments": ("b_payments", "order_id payment_sequential payment_type payment_installments payment_value"),
    "reviews": ("b_reviews", "review_id order_id review_score review_comment_title review_comment_message review_creation_date review_answer_timestamp"),
    "products": ("b_products", "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm"),
    "sellers": ("b_sellers", "seller_id seller_zip_code_prefix seller_city seller_state"),
    "category_translation": ("b_categories", "product_category_name product_category_name_english"),
}


def csv_summary() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{source}' AS source, (SELECT count(*) FROM {table}) AS row_count, '{c}' AS column_name,
 count({c}) AS "values", count(DISTINCT {c}) AS distinct_values FROM {table}"""
        for source, (table, columns) in CSV_TABLES.items()
        for c in columns.split()
    )


FINAL: dict[str, str] = {
    "clean_categories": "SELECT * FROM s_categories",
    "clean_customers": "SELECT * FROM s_customers",
    "clean_geolocation": "SELECT * FROM s_geolocation",
    "clean_orders": "SELECT * FROM s_orders",
    "clean_order_items": "SELECT * FROM s_order_items",
    "clean_payments": "SELECT * FROM s_payments",
    "clean_reviews": "SELECT * FROM s_reviews",
    "clean_products": "SELECT * FROM s_products",
    "clean_sellers": "SELECT * FROM s_sellers",
    "clean_web_events": "SELECT * FROM s_web",
    "clean_ads": "SELECT * FROM s_ads",
    "products_enriched": "SELECT * FROM s_products_enriched",
    "bridge_identity": "SELECT * FROM identity",
    "bridge_campaign": "SELECT * FROM mapping",
    "quarantine_web": quarantine(),
    "quarantine_web_strict": quarantine("WHEN event_type IS NULL THEN 'missing_event_type'"),
    "reconcile_orders": """
SELECT order_id, order_status, order_purchase_date, item_count, payment_record_count,
 CAST(items_price_total AS DOUBLE) AS items_price_total, CAST(freight_total AS DOUBLE) AS freight_total,
 CAST(items_grand_total AS DOUBLE) AS items_grand_total, CAST(payment_total AS DOUBLE) AS payment_total,
 CAST(difference AS DOUBLE) AS difference_amount,
 CASE WHEN item_count = 0 AND payment_record_count = 0 THEN 'missing_items_and_payments'
  WHEN item_count = 0 THEN 'missing_items' WHEN payment_record_count = 0 THEN 'missing_payments'
  WHEN abs(difference) <= 0.01 THEN 'matched' ELSE 'mismatched' END AS reconciliation_status
FROM (SELECT *, round(payment_total - items_grand_total, 2) AS difference
 FROM (SELECT o.order_id, order_status, order_purchase_date, coalesce(item_count, 0) AS item_count,
  coalesce(payment_record_count, 0) AS payment_record_count, coalesce(items_price_total, 0) AS items_price_total,
  coalesce(freight_total, 0) AS freight_total, coalesce(items_grand_total, 0) AS items_grand_total,
  coalesce(payment_total, 0) AS payment_total
  FROM s_orders o LEFT JOIN item_totals USING (order_id) LEFT JOIN payment_totals USING (order_id)))""",
    "referential_issues": " UNION ALL ".join(orphans(*c) for c in CHECKS),
    "dim_campaign": "SELECT * FROM d_campaign",
    "dim_channel": "SELECT * FROM d_channel",
    "dim_customer": "SELECT * FROM d_customer",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
 CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
 CAST(weekofyear(d) AS INT) AS week_of_year, CAST(day(d) AS INT) AS day_of_month,
 CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name
FROM (SELECT order_purchase_date AS d FROM s_orders UNION SELECT event_date FROM s_web UNION
 SELECT campaign_date FROM s_ads) WHERE d IS NOT NULL""",
    "dim_geolocation": "SELECT zip_code_prefix, city, state, geolocation_lat AS latitude, geolocation_lng AS longitude FROM s_geolocation",
    "dim_product": "SELECT * EXCLUDE (ingestion_time, source_file) FROM s_products_enriched",
    "dim_seller": "SELECT * EXCLUDE (ingestion_time, source_file) FROM s_sellers",
    "surrogate_key_check": KEYS,
    "fact_orders": FACT_ORDERS,
    "fact_orders_one_place": ONE_PLACE,
    "fact_order_items": FACT_ITEMS,
    "fact_logistics": LOGISTICS,
    "fact_spend": "SELECT *, campaign_id IN (SELECT campaign_id FROM d_campaign) AS has_campaign FROM f_spend",
    "fact_funnel": "SELECT * FROM f_funnel",
    "mart_sales_marketing": "SELECT * FROM m_sales",
    "mart_counted_once": sales_marketing("funnel_once", "attributed_once"),
    "mart_kpi": MART_KPI,
    "mart_customer": MART_CUSTOMER,
    "prep_payment_rollup": ROLLUP,
    "prep_item_base": BASE,
    "prep_session_id": f"SELECT order_id, order_item_id, product_id, {SESSION} FROM ({BASE})",
    "prep_expand_events": EVENTS,
    "prep_ads_rollup": ads_rollup("s_web"),
    "prep_labels": LABELS,
    "ingest_csv_append": "SELECT * EXCLUDE (ingestion_time, source_file) FROM b_orders",
    "ingest_json_upsert_web": f"SELECT * EXCLUDE (ingestion_time, source_file) FROM ({LATEST_WEB})",
    "ingest_json_upsert_web_at_once": f"SELECT * EXCLUDE (ingestion_time, source_file) FROM ({LATEST_WEB})",
    "ingest_json_upsert_ads": f"SELECT * EXCLUDE (ingestion_time, source_api) REPLACE (cost + 1 AS cost) FROM ({LATEST_ADS})",
    "ingest_csv_all": csv_summary(),
    "ingest_csv_headers": """SELECT * EXCLUDE (ingestion_time, source_file),
 CASE WHEN seller_zip_code_prefix % 3 = 2 THEN 'n' || seller_id END AS seller_note FROM b_sellers""",
    "read_csv_all": csv_summary(),
    "prep_campaign_days": """SELECT CAST(event_time AS DATE) AS date, campaign_id, utm_campaign, utm_source, utm_medium,
 count(*) FILTER (event_type = 'view_product') AS views, count(*) FILTER (event_type = 'add_to_cart') AS adds,
 count(*) FILTER (event_type = 'purchase') AS conversions FROM s_web GROUP BY 1, 2, 3, 4, 5""",
    "hash_bucket": """SELECT product_category_name_english, count(*) AS product_count, 1 AS bucket_count, true AS in_range
FROM s_products_enriched GROUP BY 1""",
    "hash_sample": f"""SELECT CAST(least(count(*), 1500) AS BIGINT) AS sample_rows,
 CAST(least(count(*), 1500) AS BIGINT) AS known_rows FROM ({BASE})""",
    "mart_customer_one_place": MART_CUSTOMER_ONE_PLACE,
    "ingest_late_update": f"""SELECT 0 AS batch_id, count(*) AS log_rows, count(*) FILTER (NOT late) AS current_rows
FROM (SELECT max(is_late) AS late FROM ({WEB_COPIES}) GROUP BY event_id HAVING NOT min(is_late))
UNION ALL SELECT 1, count(DISTINCT event_id), count(DISTINCT event_id) FROM ({WEB_COPIES}) WHERE is_late""",
    "sink_json_layout": """SELECT campaign_id, count(*) AS row_count, true AS within_limit FROM b_web
GROUP BY campaign_id""",
}


# The tables a row came from.
RECORD_SOURCES = {
    "clean_categories": "bronze_category_translation",
    "clean_customers": "bronze_customers",
    "clean_geolocation": "bronze_geolocation",
    "clean_orders": "bronze_orders",
    "clean_order_items": "bronze_order_items",
    "clean_payments": "bronze_payments",
    "clean_reviews": "bronze_reviews",
    "clean_products": "bronze_products",
    "clean_sellers": "bronze_sellers",
    "clean_web_events": "bronze_web_events",
    "clean_ads": "bronze_ads_campaigns",
    "products_enriched": "silver_products + silver_category_translation",
    "bridge_identity": "silver_web_events + silver_customers",
    "bridge_campaign": "silver_web_events + silver_ads_campaigns",
    "quarantine_web": "bronze_web_events",
    "quarantine_web_strict": "bronze_web_events",
    "reconcile_orders": "silver_order_items + silver_order_payments",
}
FINAL |= {name: f"SELECT *, '{source}' AS record_source FROM ({FINAL[name]})" for name, source in RECORD_SOURCES.items()}

# Splitting keys changes no result.
FINAL |= {
    f"split_{name}": FINAL[same]
    for name, same in (
        ("fact_orders", "fact_orders"), ("fact_order_items", "fact_order_items"), ("fact_logistics", "fact_logistics"),
        ("fact_funnel", "fact_funnel"), ("bridge_identity", "bridge_identity"), ("item_base", "prep_item_base"),
        ("referential_issues", "referential_issues"), ("mart_customer", "mart_customer"),
    )
}


# The tables after both ingests of the incremental queries: one web row per event, the cost of some days changed.
AFTER_LATE_ROWS = {
    "raw_web": TABLES["b_web"],
    "raw_ads": TABLES["b_ads"].replace("b_web", "raw_web"),
    "b_web": LATEST_WEB.replace("b_web", "raw_web"),
    "b_ads": f"SELECT * REPLACE (CASE WHEN day(date) <= 2 THEN cost + 1 ELSE cost END AS cost) FROM ({LATEST_ADS.replace('b_ads', 'raw_ads')})",
}
INCREMENTAL = {"incremental_bridge": "bridge_campaign", "incremental_spend": "fact_spend", "incremental_funnel": "fact_funnel"}


def oracle_statements() -> dict[str, str]:
    late = {name: statement(FINAL[same], AFTER_LATE_ROWS) for name, same in INCREMENTAL.items()}
    return {name: statement(sql) for name, sql in FINAL.items()} | late
