from collections import Counter

from tests.test_cleaning import GOOD, raw
from tidemart.plans.quality import quarantine_web_events, reconciliation_orders_payments, referential_integrity_issues
from tidemart.plans.silver import clean_table

WEB = GOOD["silver_web_events"]


def test_quarantine_reports_the_first_reason(spark):
    purchase = {"event_type": "purchase"}
    cases = {
        "missing_event_id": {"event_id": " ", "event_time": None},
        "invalid_or_missing_event_time": {"event_time": "never", "session_id": None},
        "missing_session_id": {"session_id": "", "event_type": "error"},
        "invalid_event_type": {"event_type": "error", "quantity": "0"},
        "purchase_missing_order_id": purchase | {"quantity": "0"},
        "invalid_quantity": {"quantity": "-1", "price_at_event": "-1"},
        "invalid_price_at_event": {"price_at_event": "-1"},
    }
    rows = [WEB | c for c in cases.values()] + [WEB, WEB | {"event_type": None}]
    df = raw(spark, "bronze_web_events", *rows)
    assert Counter(r.error_reason for r in quarantine_web_events(df).collect()) == Counter(list(cases))
    strict = Counter(r.error_reason for r in quarantine_web_events(df, strict=True).collect())
    assert strict == Counter([*cases, "missing_event_type"])


def test_quarantine_keeps_repeats_and_blank_marketing_text(spark):
    bad = WEB | {"quantity": "0", "utm_source": "  "}
    rows = quarantine_web_events(raw(spark, "bronze_web_events", bad, bad)).collect()
    assert [r.utm_source for r in rows] == ["", ""]


def test_clean_and_strict_quarantine_cover_all_rows(warehouse):
    bronze = warehouse["bronze_web_events"]
    rejected = quarantine_web_events(bronze, strict=True).count()
    accepted = bronze.count() - rejected
    repeats = accepted - warehouse["silver_web_events"].count()
    assert 0 <= repeats < accepted


def test_reconciliation_statuses(spark):
    ids = ["both", "items", "paid", "match", "edge", "off"]
    orders = spark.createDataFrame([(i, "shipped", None) for i in ids], "order_id string, order_status string, order_purchase_date date")
    items = spark.createDataFrame(
        [(i, 10.0, 0.0, 10.0) for i in ("paid", "match", "edge", "off")],
        "order_id string, price double, freight_value double, item_total_value double",
    )
    payments = spark.createDataFrame(
        [("items", 10.0), ("match", 10.0), ("edge", 10.01), ("off", 10.02)], "order_id string, payment_value double"
    )
    got = {r.order_id: r.reconciliation_status for r in reconciliation_orders_payments(orders, items, payments).collect()}
    assert got == {
        "both": "missing_items_and_payments", "items": "missing_items", "paid": "missing_payments",
        "match": "matched", "edge": "matched", "off": "mismatched",
    }


def test_all_checks_find_their_orphans(spark):
    def table(name, *changes):
        rows = [GOOD[name] | c for c in changes]
        source = {"silver_order_payments": "bronze_payments", "silver_order_reviews": "bronze_reviews"}.get(name)
        return clean_table(name, raw(spark, source or name.replace("silver", "bronze"), *rows))

    tables = {
        "silver_customers": table("silver_customers", {}),
        "silver_orders": table("silver_orders", {}, {"order_id": "o2", "customer_id": "gone"}),
        "silver_products": table("silver_products", {}),
        "silver_sellers": table("silver_sellers", {}),
        "silver_order_items": table(
            "silver_order_items", {}, {"order_id": "gone"}, {"order_item_id": "2", "product_id": "gone"},
            {"order_item_id": "3", "seller_id": "gone"},
        ),
        "silver_order_payments": table("silver_order_payments", {}, {"order_id": "gone"}),
        "silver_order_reviews": table("silver_order_reviews", {}, {"review_id": "r2", "order_id": "gone"}),
        "silver_web_events": table(
            "silver_web_events", {}, {"event_id": "e2", "order_id": "gone"}, {"event_id": "e3", "product_id": "gone"}
        ),
    }
    rows = referential_integrity_issues(tables).collect()
    assert {(r.check_name, r.record_key, r.missing_reference_key) for r in rows} == {
        ("orders_to_customers", "o2", "gone"),
        ("order_items_to_orders", "gone-1", "gone"),
        ("order_items_to_products", "o-2", "gone"),
        ("order_items_to_sellers", "o-3", "gone"),
        ("payments_to_orders", "gone-1", "gone"),
        ("reviews_to_orders", "r2", "gone"),
        ("web_events_to_orders", "e2", "gone"),
        ("web_events_to_products", "e3", "gone"),
    }
    assert len(rows) == 8
