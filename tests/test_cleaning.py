from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemart.functions import blank_to_null, date_key, flag, guarded_ratio, hash_bucket, kpi_ratio, norm_text
from tidemart.operators.latest import keep_latest
from tidemart.plans.silver import CLEAN_TABLES, clean_table
from tidemart.schemas import ADS_JSON, CSV_SOURCES, WEB_EVENTS_JSON

DDL = {f"bronze_{n}": s for n, s in CSV_SOURCES.items()} | {
    "bronze_web_events": WEB_EVENTS_JSON,
    "bronze_ads_campaigns": ADS_JSON,
}
EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)


def raw(spark, bronze, *rows):
    """Bronze rows from dicts; every column is text, as a raw file may hold anything."""
    names = [c.split(" ")[0] for c in DDL[bronze].split(", ")]
    extra = {"ingestion_time": "timestamp", "source_file": "string"}
    ddl = ", ".join([f"{n} string" for n in names] + [f"{n} {t}" for n, t in extra.items()])
    return spark.createDataFrame([tuple(r.get(n) for n in [*names, *extra]) for r in rows], ddl)


def ids(df, key):
    return sorted(r[0] for r in df.select(key).collect())


GOOD = {
    "silver_order_items": {
        "order_id": "o", "order_item_id": "1", "product_id": "p", "seller_id": "s", "price": "1", "freight_value": "0",
    },
    "silver_order_payments": {
        "order_id": "o", "payment_sequential": "1", "payment_type": "card", "payment_value": "0",
    },
    "silver_order_reviews": {"review_id": "r", "order_id": "o", "review_score": "1"},
    "silver_products": {"product_id": "p"},
    "silver_sellers": {"seller_id": "s", "seller_zip_code_prefix": "1", "seller_state": "x"},
    "silver_customers": {"customer_id": "c", "customer_unique_id": "u", "customer_zip_code_prefix": "01"},
    "silver_geolocation": {
        "geolocation_zip_code_prefix": "1", "geolocation_lat": "90", "geolocation_lng": "-180",
        "geolocation_state": "s",
    },
    "silver_orders": {
        "order_id": "o", "customer_id": "c", "order_status": " DELIVERED ",
        "order_purchase_timestamp": "2024-01-01 10:00:00",
    },
    "silver_web_events": {
        "event_id": "e", "event_time": "2024-01-01 10:00:00", "session_id": "s", "event_type": " View_Product ",
    },
    "silver_ads_campaigns": {
        "date": "2024-01-01", "campaign_id": "c", "campaign_name": "n", "impressions": "3", "clicks": "3",
        "conversions": "3", "cost": "0",
    },
    "silver_category_translation": {"product_category_name": "a", "product_category_name_english": "b"},
}

# Table, changed values, accepted or not.
CASES = [
    ("silver_order_items", {"price": "-0.01"}, False),
    ("silver_order_items", {"price": "0"}, True),
    ("silver_order_items", {"price": None}, False),
    ("silver_order_items", {"price": "abc"}, False),
    ("silver_order_items", {"freight_value": "-0.01"}, False),
    ("silver_order_items", {"seller_id": "  "}, False),
    ("silver_order_items", {"order_item_id": None}, False),
    ("silver_order_payments", {"payment_installments": "-1"}, False),
    ("silver_order_payments", {"payment_installments": "0"}, True),
    ("silver_order_payments", {"payment_value": "-0.01"}, False),
    ("silver_order_payments", {"payment_type": " "}, False),
    ("silver_order_reviews", {"review_score": "0"}, False),
    ("silver_order_reviews", {"review_score": "5"}, True),
    ("silver_order_reviews", {"review_score": "6"}, False),
    ("silver_products", {"product_weight_g": "-1"}, False),
    ("silver_products", {"product_weight_g": "0"}, True),
    ("silver_products", {"product_photos_qty": "-1"}, False),
    ("silver_products", {"product_photos_qty": "bad"}, True),
    ("silver_sellers", {"seller_state": ""}, False),
    ("silver_customers", {"customer_city": None}, True),
    ("silver_customers", {"customer_zip_code_prefix": "x"}, False),
    ("silver_geolocation", {"geolocation_lat": "90.1"}, False),
    ("silver_geolocation", {"geolocation_lng": "180.1"}, False),
    ("silver_geolocation", {"geolocation_city": None}, True),
    ("silver_orders", {"order_status": "lost"}, False),
    ("silver_orders", {"order_status": None}, False),
    ("silver_orders", {"order_purchase_timestamp": "yesterday"}, False),
    ("silver_web_events", {"event_type": None}, False),
    ("silver_web_events", {"event_type": "error"}, False),
    ("silver_web_events", {"event_type": "purchase"}, False),
    ("silver_web_events", {"event_type": "purchase", "order_id": "o"}, True),
    ("silver_web_events", {"quantity": "0"}, False),
    ("silver_web_events", {"quantity": "1"}, True),
    ("silver_web_events", {"price_at_event": "-1"}, False),
    ("silver_web_events", {"event_time": "never"}, False),
    ("silver_ads_campaigns", {"clicks": "4", "conversions": "0"}, False),
    ("silver_ads_campaigns", {"conversions": "4"}, False),
    ("silver_ads_campaigns", {"impressions": "0", "clicks": "0", "conversions": "0"}, True),
    ("silver_ads_campaigns", {"date": "soon"}, False),
    ("silver_category_translation", {"product_category_name_english": " "}, False),
]


@pytest.mark.parametrize("table", sorted(CLEAN_TABLES))
def test_rules(spark, table):
    """All cases of a table at once: each is one row with its own key, plus the unchanged row."""
    key = CLEAN_TABLES[table].key[0]
    source = next(f.source or f.name for f in CLEAN_TABLES[table].fields if f.name == key)
    numeric = table == "silver_geolocation"
    by_date = table == "silver_ads_campaigns"
    rows, accepted = [GOOD[table]], 1
    for i, (_, change, ok) in enumerate(c for c in CASES if c[0] == table):
        own = {"campaign_id": f"c{i}"} if by_date else {source: str(100 + i) if numeric else f"k{i}"}
        rows.append(GOOD[table] | own | change)
        accepted += ok
    assert clean_table(table, raw(spark, CLEAN_TABLES[table].source, *rows)).count() == accepted


@pytest.mark.parametrize("status", ["created", "approved", "invoiced", "processing", "shipped", "unavailable", "canceled"])
def test_order_statuses(spark, status):
    row = GOOD["silver_orders"] | {"order_status": status.upper()}
    assert clean_table("silver_orders", raw(spark, "bronze_orders", row)).first()["order_status"] == status


def test_delivery_delay(spark):
    def row(key, delivered, estimated):
        return GOOD["silver_orders"] | {
            "order_id": key, "order_delivered_customer_date": delivered, "order_estimated_delivery_date": estimated,
        }

    rows = [row("early", "2024-01-01 23:00:00", "2024-01-03"), row("same", "2024-01-03 01:00:00", "2024-01-03"),
            row("late", "2024-01-04", "2024-01-03 23:59:59"), row("open", None, "2024-01-03")]
    df = clean_table("silver_orders", raw(spark, "bronze_orders", *rows))
    assert {r.order_id: r.delivery_delay_days for r in df.collect()} == {"early": -2, "same": 0, "late": 1, "open": None}


def test_normalised_channel_falls_back(spark):
    rows = [
        GOOD["silver_web_events"] | {"event_id": "1", "utm_source": " Google ", "referrer": "r", "store_channel": "w"},
        GOOD["silver_web_events"] | {"event_id": "2", "utm_source": " ", "referrer": "r", "store_channel": "w"},
        GOOD["silver_web_events"] | {"event_id": "3", "store_channel": "WEB"},
    ]
    df = clean_table("silver_web_events", raw(spark, "bronze_web_events", *rows))
    assert {r.event_id: r.normalized_channel for r in df.collect()} == {"1": "google", "2": "r", "3": "web"}


def test_latest_row_wins_and_ties_do_not_depend_on_order(spark):
    rows = [("a", EARLY, 9), ("a", LATE, 1), ("b", None, 5), ("b", EARLY, 1), ("c", LATE, 1), ("c", LATE, 2), ("d", None, 1)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "k string, ingestion_time timestamp, v int").repartition(4)
        assert {r.k: r.v for r in keep_latest(df, ["k"]).collect()} == {"a": 1, "b": 1, "c": 2, "d": 1}


def test_column_functions(spark):
    df = spark.createDataFrame([(" x ", 0, 3), ("  ", 2, 3), (None, None, 3)], "t string, d int, n int")
    out = df.select(
        blank_to_null(F.col("t")), norm_text(F.col("t"), "upper"), guarded_ratio(F.col("n"), F.col("d")),
        kpi_ratio(F.col("n"), F.col("d"), 1), flag(F.col("d") > 1),
    ).collect()
    assert [tuple(r) for r in out] == [("x", "X", None, 0.0, 0), (None, None, 1.5, 1.5, 1), (None, None, None, 0.0, 0)]
    day = spark.range(1).select(date_key(F.lit("2024-02-09").cast("date"))).first()[0]
    assert day == 20240209


def test_hash_bucket_is_the_absolute_hash(spark):
    h = F.xxhash64("id")
    wrong = spark.range(1000).filter(hash_bucket(F.col("id"), 6) != F.pmod(F.abs(h), F.lit(6)))
    assert wrong.count() == 0
