"""The same datasets in SQL, for DuckDB: one named query per table, written from the definitions.

``statement(final)`` puts the named queries that ``final`` needs in front of it.
"""

from __future__ import annotations

import re

ARRIVED = "TIMESTAMP '2024-03-01 00:00:00'"

TABLES: dict[str, str] = {}


def statement(final: str, other: dict[str, str] | None = None) -> str:
    """``final`` with the WITH clause it needs; ``other`` adds tables, or defines some of them in another way."""
    tables, needed = TABLES | (other or {}), []

    def visit(sql: str) -> None:
        for name in tables:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(tables[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in needed) + "\n" + final


# ---- bronze ---------------------------------------------------------------------------------------------------

TABLES["places"] = "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey"

TABLES["campaigns"] = """
SELECT * FROM (VALUES
 ('cmp_001','Search - Electronics','google_ads','google','cpc','search_electronics','website'),
 ('cmp_002','Social - Home & Living','facebook_ads','facebook','paid_social','social_home_living','website'),
 ('cmp_003','Retargeting - Marketplace','instagram_ads','instagram','display','retargeting_marketplace','website'),
 ('cmp_004','CRM - High Intent','email','newsletter','email','crm_high_intent','website'),
 ('cmp_005','Search - Fashion','google_ads','google','cpc','search_fashion','website'),
 ('cmp_006','Social - Baby & Toys','tiktok_ads','tiktok','paid_social','social_baby_toys','mobile_app'))
 AS t(c_id, c_label, c_referrer, c_source, c_medium, c_campaign, c_store)"""

TABLES["b_customers"] = f"""
SELECT ' ' || c_custkey AS customer_id, CAST(c_custkey // 10 AS VARCHAR) AS customer_unique_id,
 CAST(c_nationkey * 10 + c_custkey % 10 AS INT) AS customer_zip_code_prefix, n_name AS customer_city,
 lower(r_name) AS customer_state, {ARRIVED} AS ingestion_time, 'customers' AS source_file
FROM customer LEFT JOIN places ON c_nationkey = n_nationkey"""

TABLES["b_geolocation"] = f"""
SELECT CAST(c_nationkey * 10 + c_custkey % 10 AS INT) AS geolocation_zip_code_prefix,
 CASE WHEN c_custkey % 40 = 7 THEN 95.0 ELSE c_nationkey * 3 - 40 + (c_custkey % 7) / 8.0::DOUBLE END::DOUBLE
  AS geolocation_lat,
 CASE WHEN c_custkey % 40 = 9 THEN -181 ELSE c_nationkey * 7 - 90 END::DOUBLE AS geolocation_lng,
 CASE WHEN c_nationkey % 5 = 0 AND (c_custkey // 10) % 2 = 1 THEN n_name || ' II '
  WHEN c_custkey % 90 = 11 THEN '  ' ELSE n_name END AS geolocation_city,
 CASE WHEN c_custkey % 40 = 13 THEN ' ' ELSE r_name END AS geolocation_state,
 {ARRIVED} + to_hours(CAST(c_custkey % 24 AS INT)) AS ingestion_time, 'geolocation' AS source_file
FROM customer LEFT JOIN places ON c_nationkey = n_nationkey"""

TABLES["b_orders"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
 CASE WHEN o_orderkey % 61 = 60 THEN 'x' || o_custkey
  WHEN o_custkey % 25 = 3 OR (o_custkey % 25 = 4 AND o_orderkey % 8 <> 0)
  THEN CAST(o_custkey - o_custkey % 25 AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
 CASE WHEN o_orderkey % 97 = 13 THEN ' CANCELED' WHEN o_orderkey % 211 = 17 THEN 'lost'
  WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END
  AS order_status,
 o_orderdate AS order_purchase_timestamp,
 o_orderdate + to_hours(CAST(o_orderkey % 48 AS INT)) AS order_approved_at,
 CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + to_days(CAST(o_orderkey % 5 + 1 AS INT)) END
  AS order_delivered_carrier_date,
 CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 20 + 3 AS INT)) END
  AS order_delivered_customer_date,
 o_orderdate + to_days(14) AS order_estimated_delivery_date,
 {ARRIVED} AS ingestion_time, 'orders' AS source_file
FROM orders"""

TABLES["b_order_items"] = """
SELECT CASE WHEN l_orderkey % 60 = 59 THEN 'x' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
 l_linenumber AS order_item_id,
 CASE WHEN l_partkey % 50 = 49 THEN 'x' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
 CASE WHEN l_suppkey % 10 = 9 THEN 'x' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS seller_id,
 l_shipdate AS shipping_limit_date,
 CASE WHEN l_orderkey % 83 = 5 THEN -l_extendedprice ELSE l_extendedprice END AS price,
 l_extendedprice * l_tax AS freight_value, l_shipdate AS ingestion_time, 'order_items' AS source_file
FROM lineitem"""

TABLES["b_payments"] = f"""
SELECT CASE WHEN o_orderkey % 60 = 59 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
 1 AS payment_sequential,
 CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 2 = 0 THEN 'Credit_Card ' ELSE 'boleto' END
  AS payment_type,
 CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE CAST(o_orderkey % 12 AS INT) END AS payment_installments,
 CASE WHEN o_custkey % 10 = 7 THEN floor(o_totalprice / 100) / 100
  WHEN o_custkey % 10 = 8 THEN floor(o_totalprice / 200) / 100
  WHEN o_orderkey % 3 = 0 AND item_total IS NOT NULL
  THEN CAST(CAST(item_total AS DECIMAL(18,2)) AS DOUBLE) ELSE o_totalprice END AS payment_value,
 {ARRIVED} AS ingestion_time, 'payments' AS source_file
FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice + l_extendedprice * l_tax AS DECIMAL(18,4)))
 AS item_total FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""

TABLES["b_reviews"] = f"""
SELECT 'r' || (o_orderkey - CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END) AS review_id,
 CASE WHEN o_orderkey % 60 = 59 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
 CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 29 = 1 THEN 6
  ELSE CAST(substring(o_orderpriority, 1, 1) AS INT) END AS review_score,
 CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE ' ' || o_orderpriority END AS review_comment_title,
 CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderstatus END AS review_comment_message,
 o_orderdate + to_days(20) AS review_creation_date,
 CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS review_answer_timestamp,
 {ARRIVED} + to_hours(CAST(o_orderkey % 24 AS INT)) AS ingestion_time, 'reviews' AS source_file
FROM orders"""

TABLES["b_products"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
 CASE WHEN p_partkey % 31 = 2 THEN ' ' ELSE lower(p_type) END AS product_category_name,
 CAST(length(p_name) AS INT) AS product_name_lenght,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(length(p_brand) AS INT) END AS product_description_lenght,
 CASE WHEN p_partkey % 71 = 3 THEN -1 ELSE CAST(p_partkey % 6 AS INT) END AS product_photos_qty,
 CASE WHEN p_partkey % 73 = 4 THEN -1 ELSE p_size * 100 END::DOUBLE AS product_weight_g,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size * 1.5 END::DOUBLE AS product_length_cm,
 (p_size * 0.5)::DOUBLE AS product_height_cm, (p_size * 2)::DOUBLE AS product_width_cm,
 {ARRIVED} AS ingestion_time, 'products' AS source_file
FROM part"""

TABLES["b_sellers"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey * 10 + s_suppkey % 10 AS INT)
  AS seller_zip_code_prefix,
 CASE WHEN s_suppkey % 8 = 1 THEN '' ELSE n_name END AS seller_city,
 CASE WHEN s_suppkey % 13 = 7 THEN NULL ELSE lower(r_name) END AS seller_state,
 {ARRIVED} AS ingestion_time, 'sellers' AS source_file
FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey"""

TABLES["b_categories"] = f"""
SELECT lower(p_type) || ' ' AS product_category_name,
 CASE WHEN p_type = 'MEDIUM' THEN '  ' ELSE upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) END
  AS product_category_name_english,
 {ARRIVED} + to_hours(CAST(p_partkey % 24 AS INT)) AS ingestion_time, 'category_translation' AS source_file
FROM part"""

TABLES["b_web"] = """
SELECT CASE WHEN event_id % 101 = 0 THEN '  ' ELSE CAST(event_id AS VARCHAR) END AS event_id,
 CASE WHEN event_id % 101 = 1 THEN NULL ELSE date_trunc('second', ts) END AS event_time,
 CASE WHEN event_id % 101 = 2 THEN '' ELSE 's' || user_id || '-' || CAST(ts AS DATE) END AS session_id,
 CASE WHEN event_id % 97 = 3 THEN ' ' ELSE CAST(user_id AS VARCHAR) END AS user_id,
 CASE WHEN event_type = 'view' THEN ' View_Product ' WHEN event_type = 'signup' THEN 'view_product'
  WHEN event_type = 'click' THEN 'add_to_cart' WHEN event_type = 'purchase' THEN 'purchase'
  WHEN event_id % 2 = 1 THEN 'error' END AS event_type,
 CASE WHEN event_id % 107 = 9 THEN 'x' || event_id ELSE CAST(event_id % 200 AS VARCHAR) END AS product_id,
 CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 13 = 3 THEN NULL
  WHEN event_id % 103 = 5 THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END END AS order_id,
 CASE WHEN event_id % 20 = 7 THEN 0 WHEN event_id % 20 = 8 THEN NULL ELSE CAST(1 + event_id % 3 AS INT) END AS quantity,
 CASE WHEN event_id % 31 = 11 THEN -1.0::DOUBLE ELSE value + copy END AS price_at_event,
 '/product/' || (event_id % 200) AS page_url, c_referrer AS referrer,
 CASE WHEN event_id % 11 = 5 THEN ' ' ELSE upper(c_source) END AS utm_source, c_medium AS utm_medium,
 CASE WHEN event_id % 17 = 6 THEN NULL ELSE c_campaign END AS utm_campaign, c_id AS campaign_id,
 CASE WHEN event_id % 3 = 0 THEN ' Mobile ' WHEN event_id % 3 = 1 THEN 'desktop' END AS device,
 CASE WHEN event_id % 4 = 0 THEN 'Chrome' WHEN event_id % 4 = 1 THEN 'safari ' ELSE 'firefox' END AS browser,
 coalesce(c_store, 'website') AS store_channel,
 date_trunc('second', ts) + to_hours(copy) AS ingestion_time, 'web_events' AS source_file
FROM (SELECT *, unnest(CASE WHEN event_id % 50 = 4 THEN [0, 1] ELSE [0] END) AS copy FROM events)
LEFT JOIN campaigns ON event_id % 7 < 6 AND c_id = 'cmp_00' || (1 + event_id % 7)"""


def ads_rollup(source: str) -> str:
    """Daily counters per campaign and tags over ``source``, whose event types are already folded."""
    return f"""
SELECT date, campaign_id,
 CASE campaign_id WHEN 'cmp_001' THEN 'Search - Electronics' WHEN 'cmp_002' THEN 'Social - Home & Living'
  WHEN 'cmp_003' THEN 'Retargeting - Marketplace' WHEN 'cmp_004' THEN 'CRM - High Intent'
  WHEN 'cmp_005' THEN 'Search - Fashion' ELSE 'Social - Baby & Toys' END AS campaign_name,
 CASE utm_source WHEN 'google' THEN 'Google' WHEN 'facebook' THEN 'Facebook' WHEN 'instagram' THEN 'Instagram'
  WHEN 'tiktok' THEN 'TikTok' ELSE 'Email' END AS channel,
 utm_source AS source, utm_medium AS medium, greatest(views * 12, clicks + 10) AS impressions, clicks, conversions,
 CAST(round(clicks * 0.75 + conversions * 2.00, 2) AS DOUBLE) AS cost, 'USD' AS currency
FROM (SELECT *, CAST(greatest(floor(views * 0.28::DOUBLE) + adds, conversions + 1) AS BIGINT) AS clicks
 FROM (SELECT CAST(event_time AS DATE) AS date, campaign_id, utm_campaign, utm_source, utm_medium,
  count(*) FILTER (event_type = 'view_product') AS views, count(*) FILTER (event_type = 'add_to_cart') AS adds,
  count(*) FILTER (event_type = 'purchase') AS conversions
  FROM {source} GROUP BY ALL))"""


TABLES["b_ads"] = f"""
SELECT date, CASE WHEN campaign_id = 'cmp_006' THEN 'cmp_900 ' ELSE campaign_id END AS campaign_id, campaign_name,
 channel, source, medium, CASE WHEN day(date) = 13 THEN clicks - 1 ELSE impressions END AS impressions, clicks,
 CASE WHEN day(date) = 17 THEN clicks + 1 ELSE conversions END AS conversions, cost, ' usd' AS currency,
 CAST(date + 1 AS TIMESTAMP) AS ingestion_time, 'ads_api' AS source_api
FROM ({ads_rollup('''(SELECT * REPLACE (nullif(lower(trim(event_type)), '') AS event_type,
 nullif(lower(trim(utm_source)), '') AS utm_source) FROM b_web)''')})"""

# ---- silver ---------------------------------------------------------------------------------------------------


def text(name: str, source: str = "", fold: str = "", keep_blank: bool = False) -> str:
    value = f"trim({source or name}, ' ')"
    value = value if keep_blank else f"nullif({value}, '')"
    return f"{fold}({value}) AS {name}" if fold else f"{value} AS {name}"


def cleaned(bronze: str, columns: list[str], key: str, where: str, derived: str = "", audit: str = "source_file") -> str:
    """Projection, rules, then the latest row per key; equal times are settled by the other columns, highest first."""
    names = [c.rsplit(" AS ", 1)[-1] for c in columns]
    keys = [k.strip() for k in key.split(",")]
    rest = [n for n in names if n not in keys] + [audit]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ingestion_time", *rest])
    extra = f", {derived}" if derived else ""
    return f"""
SELECT *{extra} FROM (SELECT {", ".join(columns)}, ingestion_time, {audit} FROM {bronze})
WHERE {where} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


TABLES["s_categories"] = cleaned(
    "b_categories",
    [text("product_category_name"), text("product_category_name_english")],
    "product_category_name",
    "product_category_name IS NOT NULL AND product_category_name_english IS NOT NULL",
)
TABLES["s_customers"] = cleaned(
    "b_customers",
    [
        text("customer_id"), text("customer_unique_id"), "customer_zip_code_prefix", text("customer_city"),
        text("customer_state", fold="upper"),
    ],
    "customer_id",
    "customer_id IS NOT NULL AND customer_unique_id IS NOT NULL AND customer_zip_code_prefix IS NOT NULL",
)
TABLES["s_geolocation"] = cleaned(
    "b_geolocation",
    [
        "geolocation_zip_code_prefix AS zip_code_prefix", "geolocation_lat", "geolocation_lng",
        text("city", "geolocation_city"), text("state", "geolocation_state", "upper"),
    ],
    "zip_code_prefix, city, state",
    "zip_code_prefix IS NOT NULL AND state IS NOT NULL AND abs(geolocation_lat) <= 90 AND abs(geolocation_lng) <= 180",
)
TABLES["s_orders"] = cleaned(
    "b_orders",
    [
        text("order_id"), text("customer_id"), text("order_status", fold="lower"),
        "order_purchase_timestamp AS order_purchase_ts", "order_approved_at",
        "order_delivered_carrier_date AS order_delivered_carrier_ts",
        "order_delivered_customer_date AS order_delivered_customer_ts",
        "order_estimated_delivery_date AS order_estimated_delivery_ts",
    ],
    "order_id",
    "order_id IS NOT NULL AND customer_id IS NOT NULL AND order_purchase_ts IS NOT NULL AND order_status IN "
    "('created','approved','invoiced','processing','shipped','delivered','unavailable','canceled')",
    "CAST(order_purchase_ts AS DATE) AS order_purchase_date, CAST(order_approved_at AS DATE) AS order_approved_date, "
    "CAST(date_diff('day', CAST(order_estimated_delivery_ts AS DATE), CAST(order_delivered_customer_ts AS DATE)) "
    "AS INT) AS delivery_delay_days",
)
TABLES["s_order_items"] = cleaned(
    "b_order_items",
    [
        text("order_id"), "order_item_id", text("product_id"), text("seller_id"),
        "shipping_limit_date AS shipping_limit_ts", "price", "freight_value",
    ],
    "order_id, order_item_id",
    "order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL "
    "AND price >= 0 AND freight_value >= 0",
    "price + freight_value AS item_total_value",
)
TABLES["s_payments"] = cleaned(
    "b_payments",
    [text("order_id"), "payment_sequential", text("payment_type", fold="lower"), "payment_installments", "payment_value"],
    "order_id, payment_sequential",
    "order_id IS NOT NULL AND payment_sequential IS NOT NULL AND payment_type IS NOT NULL "
    "AND coalesce(payment_installments, 0) >= 0 AND payment_value >= 0",
)
TABLES["s_reviews"] = cleaned(
    "b_reviews",
    [
        text("review_id"), text("order_id"), "review_score", text("review_comment_title"),
        text("review_comment_message"), "review_creation_date AS review_creation_ts",
        "review_answer_timestamp AS review_answer_ts",
    ],
    "review_id",
    "review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5",
)
TABLES["s_products"] = cleaned(
    "b_products",
    [
        text("product_id"), text("product_category_name"), "product_name_lenght AS product_name_length",
        "product_description_lenght AS product_description_length", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "product_id",
    "product_id IS NOT NULL AND coalesce(product_weight_g, 0) >= 0 AND coalesce(product_length_cm, 0) >= 0 "
    "AND coalesce(product_height_cm, 0) >= 0 AND coalesce(product_width_cm, 0) >= 0 "
    "AND coalesce(product_photos_qty, 0) >= 0",
)
TABLES["s_sellers"] = cleaned(
    "b_sellers",
    [text("seller_id"), "seller_zip_code_prefix", text("seller_city"), text("seller_state", fold="upper")],
    "seller_id",
    "seller_id IS NOT NULL AND seller_zip_code_prefix IS NOT NULL AND seller_state IS NOT NULL",
)


def web_columns(keep_blank: bool) -> list[str]:
    loose = [("page_url", ""), ("referrer", ""), ("utm_source", "lower"), ("utm_medium", "lower"),
             ("utm_campaign", "lower"), ("campaign_id", ""), ("device", "lower"), ("browser", "lower"),
             ("store_channel", "lower")]
    return [
        *[text(c) for c in ("event_id", "session_id", "user_id", "product_id", "order_id")],
        "event_time",
        text("event_type", fold="lower"),
        "quantity",
        "price_at_event",
        *[text(c, fold=f, keep_blank=keep_blank) for c, f in loose],
    ]


TABLES["s_web"] = cleaned(
    "b_web",
    web_columns(False),
    "event_id",
    "event_id IS NOT NULL AND event_time IS NOT NULL AND session_id IS NOT NULL "
    "AND event_type IN ('view_product','add_to_cart','purchase') AND coalesce(quantity, 1) > 0 "
    "AND coalesce(price_at_event, 0) >= 0 AND (event_type <> 'purchase' OR order_id IS NOT NULL)",
    "CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INT) AS event_hour, "
    "coalesce(utm_source, referrer, store_channel) AS normalized_channel",
)
TABLES["s_ads"] = cleaned(
    "b_ads",
    [
        "date AS campaign_date", text("campaign_id"), text("campaign_name"), text("channel", fold="lower"),
        text("source", fold="lower"), text("medium", fold="lower"), "impressions", "clicks", "conversions", "cost",
        text("currency", fold="upper"),
    ],
    "campaign_date, campaign_id",
    "campaign_date IS NOT NULL AND campaign_id IS NOT NULL AND campaign_name IS NOT NULL AND impressions >= 0 "
    "AND clicks >= 0 AND conversions >= 0 AND cost >= 0 AND clicks <= impressions AND conversions <= clicks",
    "CASE WHEN impressions > 0 THEN clicks / impressions END AS ctr, "
    "CASE WHEN clicks > 0 THEN conversions / clicks END AS cvr, CASE WHEN clicks > 0 THEN cost / clicks END AS cpc",
    audit="source_api",
)
TABLES["s_products_enriched"] = """
SELECT p.*, coalesce(product_category_name_english, 'unknown') AS product_category_name_english
FROM s_products p LEFT JOIN (SELECT product_category_name, product_category_name_english FROM s_categories) t
USING (product_category_name)"""

TABLES["identity"] = """
SELECT user_id AS website_user_id, customer_unique_id, customer_id, min(event_time) AS first_seen_at,
 max(event_time) AS last_seen_at, count(DISTINCT session_id) AS session_count, count(*) AS event_count,
 'web.user_id = customers.customer_unique_id' AS match_rule, true AS is_current
FROM s_web JOIN s_customers ON user_id = customer_unique_id GROUP BY user_id, customer_unique_id, customer_id"""

TABLES["mapping"] = """
SELECT *, CASE WHEN ads_campaign_name IS NOT NULL AND utm_campaign IS NOT NULL THEN 'high'
  WHEN ads_campaign_name IS NOT NULL OR utm_campaign IS NOT NULL THEN 'medium' ELSE 'low' END AS mapping_quality,
 'campaign_id direct match' AS match_rule
FROM (SELECT coalesce(w.campaign_id, a.campaign_id) AS campaign_id, campaign_name AS ads_campaign_name, utm_campaign,
  coalesce(utm_source, source) AS source, coalesce(utm_medium, medium) AS medium, channel,
  min(coalesce(event_date, campaign_date)) AS first_seen_date, max(coalesce(event_date, campaign_date)) AS last_seen_date
 FROM s_web w FULL JOIN s_ads a ON w.campaign_id = a.campaign_id
 WHERE coalesce(w.campaign_id, a.campaign_id) IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6)"""

TABLES["item_totals"] = """
SELECT order_id, count(*) AS item_count, sum(CAST(price AS DECIMAL(18,4))) AS items_price_total,
 sum(CAST(freight_value AS DECIMAL(18,4))) AS freight_total,
 sum(CAST(item_total_value AS DECIMAL(18,4))) AS items_grand_total FROM s_order_items GROUP BY order_id"""

TABLES["payment_totals"] = """
SELECT order_id, count(*) AS payment_record_count, sum(CAST(payment_value AS DECIMAL(18,4))) AS payment_total
FROM s_payments GROUP BY order_id"""

# ---- gold -----------------------------------------------------------------------------------------------------

TABLES["d_campaign"] = """
SELECT campaign_id, ads_campaign_name, utm_campaign, source, medium, channel, mapping_quality, first_seen_date,
 last_seen_date FROM mapping
QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY
 CASE mapping_quality WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, last_seen_date DESC NULLS LAST,
 first_seen_date NULLS LAST, ads_campaign_name NULLS LAST, utm_campaign NULLS LAST, source NULLS LAST,
 medium NULLS LAST, channel NULLS LAST) = 1"""

TABLES["d_channel"] = """
SELECT DISTINCT coalesce(channel, 'unknown') AS channel_name, coalesce(source, 'unknown') AS source,
 coalesce(medium, 'unknown') AS medium FROM mapping"""

TABLES["d_customer"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, first_order_date,
 coalesce(n, 0) AS total_orders,
 CASE WHEN n > 1 THEN 'repeat' WHEN n = 1 THEN 'new' ELSE 'unknown' END AS customer_type
FROM s_customers LEFT JOIN (SELECT customer_id, min(order_purchase_date) AS first_order_date,
 count(DISTINCT order_id) AS n FROM s_orders GROUP BY customer_id) USING (customer_id)"""

TABLES["geo_of_zip"] = "SELECT zip_code_prefix, city AS place_city, state AS place_state FROM s_geolocation"

TABLES["f_orders"] = """
SELECT o.order_id, CAST(strftime(order_purchase_date, '%Y%m%d') AS INT) AS order_date_key, o.customer_id,
 c.customer_id IS NOT NULL AS has_customer, zip_code_prefix, place_city, place_state, order_status,
 coalesce(item_count, 0) AS item_count,
 CAST(round(coalesce(items_price_total, 0), 2) AS DECIMAL(18,2)) AS items_price_total,
 CAST(round(coalesce(freight_total, 0), 2) AS DECIMAL(18,2)) AS freight_total,
 CAST(round(coalesce(items_grand_total, 0), 2) AS DECIMAL(18,2)) AS gross_order_value,
 coalesce(payment_record_count, 0) AS payment_record_count,
 CAST(round(coalesce(payment_total, 0), 2) AS DECIMAL(18,2)) AS payment_total,
 CAST(round(coalesce(payment_total, 0) - coalesce(items_grand_total, 0), 2) AS DOUBLE) AS difference_amount,
 CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
 CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled, delivery_delay_days,
 order_purchase_ts, order_approved_at, order_delivered_carrier_ts, order_delivered_customer_ts,
 order_estimated_delivery_ts
FROM s_orders o LEFT JOIN item_totals USING (order_id) LEFT JOIN payment_totals USING (order_id)
LEFT JOIN s_customers c ON o.customer_id = c.customer_id
LEFT JOIN geo_of_zip ON customer_zip_code_prefix = zip_code_prefix"""

TABLES["f_spend"] = """
SELECT CAST(strftime(campaign_date, '%Y%m%d') AS INT) AS date_key, campaign_id, campaign_name, s_ads.channel,
 s_ads.source, s_ads.medium, impressions, clicks, conversions, cost, currency,
 CAST(round(CAST(ctr AS DECIMAL(38,8)), 4) AS DECIMAL(6,4)) AS ctr,
 CAST(round(CAST(cvr AS DECIMAL(38,8)), 4) AS DECIMAL(6,4)) AS cvr,
 CAST(round(CAST(cpc AS DECIMAL(38,8)), 2) AS DECIMAL(10,2)) AS cpc
FROM s_ads LEFT JOIN (SELECT campaign_id FROM d_campaign) USING (campaign_id)"""

TABLES["f_funnel"] = """
SELECT date_key, campaign_id, channel_name, source, medium, device, view_product_count, add_to_cart_count,
 purchase_event_count, session_count, user_count,
 CASE WHEN view_product_count > 0 THEN purchase_event_count / view_product_count END AS funnel_conversion_rate
FROM (SELECT CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key, d.campaign_id, h.channel_name, h.source, h.medium,
  coalesce(device, 'unknown') AS device, count(*) FILTER (event_type = 'view_product') AS view_product_count,
  count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart_count,
  count(*) FILTER (event_type = 'purchase') AS purchase_event_count,
  count(DISTINCT session_id) AS session_count, count(DISTINCT user_id) AS user_count
 FROM s_web w LEFT JOIN d_campaign d ON w.campaign_id = d.campaign_id
 LEFT JOIN d_channel h ON coalesce(d.channel, 'unknown') = h.channel_name AND coalesce(d.source, 'unknown') = h.source
  AND coalesce(d.medium, 'unknown') = h.medium
 GROUP BY 1, 2, 3, 4, 5, 6)"""

TABLES["attributed"] = """
SELECT CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key, d.campaign_id, count(DISTINCT w.order_id) AS orders,
 sum(payment_total) AS revenue
FROM s_web w LEFT JOIN f_orders f ON w.order_id = f.order_id LEFT JOIN d_campaign d ON w.campaign_id = d.campaign_id
WHERE event_type = 'purchase' AND w.order_id IS NOT NULL GROUP BY 1, 2"""

TABLES["attributed_once"] = """
SELECT date_key, campaign_id, count(DISTINCT order_id) AS orders, sum(payment_total) AS revenue
FROM (SELECT DISTINCT CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key, d.campaign_id, w.order_id, payment_total
 FROM s_web w LEFT JOIN (SELECT DISTINCT order_id, payment_total FROM f_orders) f ON w.order_id = f.order_id
 LEFT JOIN d_campaign d ON w.campaign_id = d.campaign_id
 WHERE event_type = 'purchase' AND w.order_id IS NOT NULL) GROUP BY 1, 2"""

TABLES["funnel_sum"] = """
SELECT date_key, campaign_id, CAST(sum(view_product_count) AS BIGINT) AS views,
 CAST(sum(add_to_cart_count) AS BIGINT) AS add_to_carts, CAST(sum(purchase_event_count) AS BIGINT) AS purchase_events,
 CAST(sum(session_count) AS BIGINT) AS sessions, CAST(sum(user_count) AS BIGINT) AS users
FROM f_funnel GROUP BY date_key, campaign_id"""

TABLES["funnel_once"] = """
SELECT CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key, d.campaign_id,
 count(*) FILTER (event_type = 'view_product') AS views, count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
 count(*) FILTER (event_type = 'purchase') AS purchase_events, count(DISTINCT session_id) AS sessions,
 count(DISTINCT user_id) AS users
FROM s_web w LEFT JOIN d_campaign d ON w.campaign_id = d.campaign_id GROUP BY 1, 2"""


def sales_marketing(funnel: str, attributed: str) -> str:
    return f"""
SELECT m.date_key, m.campaign_id, d.ads_campaign_name AS campaign_name, d.channel, d.source, d.medium,
 coalesce(impressions, 0) AS impressions, coalesce(clicks, 0) AS clicks, coalesce(conversions, 0) AS conversions,
 coalesce(cost, 0.0) AS cost, coalesce(sessions, 0) AS sessions, coalesce(users, 0) AS users,
 coalesce(views, 0) AS views, coalesce(add_to_carts, 0) AS add_to_carts,
 coalesce(purchase_events, 0) AS purchase_events, coalesce(orders, 0) AS orders,
 coalesce(CAST(revenue AS DOUBLE), 0.0) AS revenue,
 CASE WHEN clicks > 0 THEN cost / clicks END AS cpc, CASE WHEN impressions > 0 THEN clicks / impressions END AS ctr,
 CASE WHEN sessions > 0 THEN orders / sessions END AS session_to_order_rate,
 CASE WHEN views > 0 THEN purchase_events / views END AS view_to_purchase_rate,
 CASE WHEN cost > 0 THEN CAST(revenue AS DOUBLE) / cost END AS roas
FROM (SELECT * FROM f_spend FULL JOIN {funnel} USING (date_key, campaign_id)
 FULL JOIN {attributed} USING (date_key, campaign_id)) m
LEFT JOIN d_campaign d ON m.campaign_id = d.campaign_id"""


TABLES["m_sales"] = sales_marketing("funnel_sum", "attributed")


def kpi(numerator: str, denominator: str, digits: int, scale: str = "") -> str:
    value = f"({numerator} / {denominator}){scale}"
    return (
        f"CASE WHEN {denominator} > 0 THEN CAST(round(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE) "
        "ELSE 0.0 END"
    )
