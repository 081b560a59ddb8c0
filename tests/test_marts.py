from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.plans import dims, facts, marts
from tidemart.plans.bridges import bridge_campaign_mapping

DAY = date(2024, 1, 5)


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


@pytest.fixture(scope="module")
def shop(spark):
    """One customer whose zip covers two cities, orders of known value."""
    geo = frame(spark, "zip_code_prefix int, city string, state string, geolocation_lat double, geolocation_lng double",
                (1, "A", "S", 0.0, 0.0), (1, "B", "S", 0.0, 0.0))
    customers = frame(
        spark,
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
        ("c", "u", 1, "A", "S"),
        ("none", "u", 2, "X", "S"),
    )
    times = ", ".join(f"{t} timestamp" for t in facts.ORDER_TIMES)
    orders = frame(
        spark,
        f"order_id string, customer_id string, order_status string, order_purchase_date date, delivery_delay_days int, {times}",
        ("o1", "c", "delivered", DAY, 1, *[None] * 5),
        ("o2", "gone", "canceled", DAY, None, *[None] * 5),
    )
    items = frame(
        spark,
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double, item_total_value double",
        ("o1", 1, "p1", "s1", 150.0, 0.005, 150.005),
        ("o1", 2, "p2", "s1", 50.0, 0.0, 50.0),
    )
    payments = frame(spark, "order_id string, payment_value double", ("o1", 200.0))
    return {
        "geo": dims.dim_geolocation(geo), "customers": customers, "orders": orders, "items": items, "payments": payments,
    }


def orders_fact(shop, **options):
    keys = dims.customer_lookup(shop["customers"])
    return facts.fact_orders(shop["orders"], shop["items"], shop["payments"], keys, shop["geo"], **options)


def test_order_fact_repeats_per_place_of_a_zip(shop):
    assert Counter(r.order_id for r in orders_fact(shop).collect()) == {"o1": 2, "o2": 1}
    assert Counter(r.order_id for r in orders_fact(shop, geo_per_zip=True).collect()) == {"o1": 1, "o2": 1}


def test_order_fact_values(shop):
    rows = {r.order_id: r for r in orders_fact(shop, geo_per_zip=True).collect()}
    assert str(rows["o1"].gross_order_value) == "200.01" and rows["o1"].difference_amount == -0.01
    assert (rows["o2"].customer_key, rows["o2"].item_count, float(rows["o2"].payment_total)) == (None, 0, 0.0)
    assert (rows["o1"].is_delivered, rows["o2"].is_canceled) == (1, 1)


def test_logistics_counts_parties_and_open_orders(shop):
    keys = dims.customer_lookup(shop["customers"])
    orders = shop["orders"].withColumn("order_estimated_delivery_ts", F.lit("2024-01-10").cast("timestamp"))
    for day, late in (("2024-01-10", 0), ("2024-01-11", 1)):
        df = facts.fact_order_logistics(orders, shop["items"], keys, shop["geo"], F.lit(day).cast("date"), geo_per_zip=True)
        rows = {r.order_id: r for r in df.collect()}
        assert (rows["o1"].seller_count, rows["o1"].product_count, rows["o2"].seller_count) == (1, 2, 0)
        assert rows["o1"].is_open_late == late and rows["o1"].is_late_delivery == 0


def test_customer_mart_repeats_squared_unless_one_place(shop, spark):
    reviews = frame(spark, "review_id string, order_id string, review_score int", ("r1", "o1", 4), ("r2", "o1", 5))
    for options, copies in (({}, 4), ({"geo_per_zip": True}, 1)):
        df = marts.mart_customer_summary(
            shop["customers"], orders_fact(shop, **options), shop["orders"], reviews, shop["geo"], **options
        )
        rows = df.collect()
        mine = [r for r in rows if r.customer_id == "c"]
        assert len(mine) == copies and len(rows) == copies + 1
        assert (mine[0].avg_review_score, mine[0].review_count, mine[0].total_orders) == (4.5, 2, 1)


@pytest.mark.parametrize(
    "paid, segment",
    [(0.0, "no_purchase"), (199.99, "low_value"), (200.0, "mid_value"), (499.99, "mid_value"), (500.0, "high_value")],
)
def test_segments(shop, spark, paid, segment):
    payments = frame(spark, "order_id string, payment_value double", ("o1", paid))
    fact = facts.fact_orders(
        shop["orders"], shop["items"], payments, dims.customer_lookup(shop["customers"]), shop["geo"], geo_per_zip=True
    )
    reviews = frame(spark, "review_id string, order_id string, review_score int")
    df = marts.mart_customer_summary(shop["customers"], fact, shop["orders"], reviews, shop["geo"], geo_per_zip=True)
    assert {r.customer_segment for r in df.filter("customer_id = 'c'").collect()} == {segment}


SPEND = "date_key int, campaign_key bigint, impressions bigint, clicks bigint, conversions bigint, cost double"
FUNNEL = "date_key int, campaign_key bigint, views bigint, add_to_carts bigint, purchase_events bigint, sessions bigint, users bigint"
LABELS = "campaign_key bigint, campaign_id string, ads_campaign_name string, channel string, source string, medium string"


def test_sales_mart_sides_and_ratios(spark):
    spend = frame(spark, SPEND, (1, 7, 100, 10, 2, 5.0), (2, 7, 0, 0, 0, 0.0))
    funnel = frame(spark, FUNNEL, (1, 8, 4, 2, 1, 3, 3), (1, None, 1, 0, 0, 1, 1))
    paid = frame(spark, "date_key int, campaign_key bigint, orders bigint, revenue decimal(28,2)", (1, None, 1, None))
    labels = frame(spark, LABELS, (7, "c7", "n", "ch", "s", "m"), (8, "c8", None, None, None, None))
    mart = marts.mart_sales_marketing_360(spend, funnel, paid, labels)
    rows = {(r.date_key, r.campaign_key, r.sessions): r for r in mart.collect()}
    assert set(rows) == {(1, 7, 0), (2, 7, 0), (1, 8, 3), (1, None, 1), (1, None, 0)}
    assert (rows[1, 7, 0].cpc, rows[1, 7, 0].roas, rows[1, 7, 0].revenue) == (0.5, None, 0.0)
    assert (rows[2, 7, 0].cpc, rows[2, 7, 0].ctr) == (None, None)
    assert rows[1, 8, 3].view_to_purchase_rate == 0.25 and rows[1, 8, 3].session_to_order_rate is None
    kpi = {(r.date_key, r.campaign_key, r.sessions): r for r in marts.mart_kpi_daily(mart).collect()}
    assert (kpi[1, 7, 0].roas, kpi[1, 7, 0].cpm, kpi[2, 7, 0].cpc) == (0.0, 50.0, 0.0)


EVENTS = (
    "event_id string, event_date date, event_type string, session_id string, user_id string, campaign_id string, "
    "device string, order_id string, utm_campaign string, utm_source string, utm_medium string"
)
CAMPAIGNS = LABELS.replace("campaign_key bigint, ", "campaign_key bigint, ")
CHANNELS = "channel_key bigint, channel_name string, source string, medium string"


def test_funnel_channels_of_known_and_unknown_campaigns(spark):
    web = frame(
        spark,
        EVENTS,
        ("1", DAY, "view_product", "s1", "u1", "c7", None, None, None, None, None),
        ("2", DAY, "purchase", "s1", "u1", "c7", None, "o1", None, None, None),
        ("3", DAY, "view_product", "s2", "u2", None, "tv", None, None, None, None),
        ("4", DAY, "view_product", "s2", "u2", "odd", "tv", None, None, None, None),
    )
    campaigns = frame(spark, CAMPAIGNS, (7, "c7", "n", "ch", None, "m"))
    known = dims.dim_channel(frame(spark, "channel string, source string, medium string", ("ch", None, "m")))
    rows = {r.device: r for r in facts.fact_web_funnel_daily(web, campaigns, known).collect()}
    assert (rows["unknown"].session_count, rows["unknown"].funnel_conversion_rate) == (1, 1.0)
    assert rows["unknown"].channel_key == known.first().channel_key
    # An unknown campaign is the same group as none, and counts its session once.
    assert (rows["tv"].campaign_key, rows["tv"].channel_key, rows["tv"].session_count) == (None, None, 1)
    all_unknown = dims.dim_channel(frame(spark, "channel string, source string, medium string", (None, None, None)))
    rows = {r.device: r for r in facts.fact_web_funnel_daily(web, campaigns, all_unknown).collect()}
    assert rows["tv"].channel_key == all_unknown.first().channel_key and rows["unknown"].channel_key is None


def test_attribution_counts_events_and_copies(spark):
    web = frame(
        spark,
        EVENTS,
        *[(str(i), DAY, "purchase", "s", "u", "c7", None, "o1", None, None, None) for i in range(3)],
        ("x", DAY, "purchase", "s", "u", "c7", None, "gone", None, None, None),
    )
    fact = frame(spark, "order_id string, payment_total decimal(18,2)", ("o1", Decimal(10)), ("o1", Decimal(10)))
    campaigns = frame(spark, CAMPAIGNS, (7, "c7", "n", None, None, None))
    row = marts.attributed_orders(web, fact, campaigns).first()
    assert (row.orders, float(row.revenue)) == (2, 60.0)
    row = marts.attributed_orders(web, fact, campaigns, per_order=True).first()
    assert (row.orders, float(row.revenue)) == (2, 10.0)


def test_campaign_bridge_sides(spark):
    web = frame(
        spark,
        EVENTS,
        ("1", DAY, "view_product", "s", "u", "both", None, None, "t", "g", None),
        ("2", date(2024, 1, 9), "view_product", "s", "u", "both", None, None, "t", "g", None),
        ("3", DAY, "view_product", "s", "u", "web", None, None, None, None, None),
        ("4", DAY, "view_product", "s", "u", None, None, None, "t", "g", None),
    )
    ads = frame(
        spark,
        "campaign_id string, campaign_name string, source string, medium string, channel string, campaign_date date",
        ("both", "one", "x", "m", "ch", date(2023, 1, 1)),
        ("both", "two", "x", "m", "ch", date(2023, 1, 1)),
        ("ads", "n", "x", "m", "ch", date(2023, 1, 2)),
    )
    rows = bridge_campaign_mapping(web, ads).collect()
    got = {(r.campaign_id, r.ads_campaign_name): r for r in rows}
    assert set(got) == {("both", "one"), ("both", "two"), ("web", None), ("ads", "n")}
    both = got["both", "one"]
    assert (both.source, both.medium, both.first_seen_date, both.last_seen_date) == ("g", "m", DAY, date(2024, 1, 9))
    assert [got[k].mapping_quality for k in (("both", "two"), ("ads", "n"), ("web", None))] == ["high", "medium", "low"]
    best = {r.campaign_id: r.ads_campaign_name for r in dims.dim_campaign(bridge_campaign_mapping(web, ads)).collect()}
    assert best == {"both": "one", "web": None, "ads": "n"}
