"""Bronze tables from the driver's parquet tables (mapping in ``FIXTURES.md`` section 4).

Every row of a driver table becomes a raw row. Broken references, rejected rows, late copies and repeated keys are
made by changing values, never by leaving rows out, so all queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import money_sum, norm_text
from tidemart.plans.prep import rollup_ads_daily
from tidemart.sources.campaigns import campaign_lookup

ARRIVED = "TIMESTAMP '2024-03-01 00:00:00'"


def _select(df: DataFrame, source: str, **columns: str) -> DataFrame:
    columns.setdefault("ingestion_time", ARRIVED)
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()], f"'{source}' AS source_file")


class DriverTables:
    """Lazy bronze tables over one directory of driver parquet files."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.directory = directory
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:  # opening a file reads its schema
            self._read[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._read[name]

    def bronze(self, name: str) -> DataFrame:
        return BRONZE[name](self)

    def nations(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))

    def customers(self) -> DataFrame:
        people = self.table("customer").join(self.nations(), F.expr("c_nationkey = n_nationkey"), "left")
        return _select(
            people,
            "customers",
            customer_id="concat(' ', c_custkey)",
            customer_unique_id="cast(floor(c_custkey / 10) AS string)",
            customer_zip_code_prefix="c_nationkey * 10 + cast(c_custkey % 10 AS int)",
            customer_city="n_name",
            customer_state="lower(r_name)",
        )

    def geolocation(self) -> DataFrame:
        people = self.table("customer").join(self.nations(), F.expr("c_nationkey = n_nationkey"), "left")
        return _select(
            people,
            "geolocation",
            geolocation_zip_code_prefix="c_nationkey * 10 + cast(c_custkey % 10 AS int)",
            geolocation_lat="CASE WHEN c_custkey % 40 = 7 THEN 95.0D ELSE c_nationkey * 3.0D - 40 + (c_custkey % 7) / 8 END",
            geolocation_lng="CASE WHEN c_custkey % 40 = 9 THEN -181.0D ELSE c_nationkey * 7.0D - 90 END",
            geolocation_city="CASE WHEN c_nationkey % 5 = 0 AND floor(c_custkey / 10) % 2 = 1 "
            "THEN concat(n_name, ' II ') WHEN c_custkey % 90 = 11 THEN '  ' ELSE n_name END",
            geolocation_state="CASE WHEN c_custkey % 40 = 13 THEN ' ' ELSE r_name END",
            ingestion_time=f"{ARRIVED} + make_interval(0, 0, 0, 0, cast(c_custkey % 24 AS int))",
        )

    def orders(self) -> DataFrame:
        return _select(
            self.table("orders"),
            "orders",
            order_id="cast(o_orderkey AS string)",
            customer_id="CASE WHEN o_orderkey % 61 = 60 THEN concat('x', o_custkey) "
            "WHEN o_custkey % 25 = 3 OR (o_custkey % 25 = 4 AND o_orderkey % 8 <> 0) "
            "THEN cast(o_custkey - o_custkey % 25 AS string) ELSE cast(o_custkey AS string) END",
            order_status="CASE WHEN o_orderkey % 97 = 13 THEN ' CANCELED' WHEN o_orderkey % 211 = 17 THEN 'lost' "
            "WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END",
            order_purchase_timestamp="cast(o_orderdate AS timestamp)",
            order_approved_at="cast(o_orderdate AS timestamp) + make_interval(0, 0, 0, 0, cast(o_orderkey % 48 AS int))",
            order_delivered_carrier_date="CASE WHEN o_orderstatus IN ('F', 'O') THEN cast(o_orderdate AS timestamp) "
            "+ make_interval(0, 0, 0, cast(o_orderkey % 5 + 1 AS int)) END",
            order_delivered_customer_date="CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS timestamp) "
            "+ make_interval(0, 0, 0, cast(o_orderkey % 20 + 3 AS int)) END",
            order_estimated_delivery_date="cast(o_orderdate AS timestamp) + make_interval(0, 0, 0, 14)",
        )

    def order_items(self) -> DataFrame:
        return _select(
            self.table("lineitem"),
            "order_items",
            order_id="CASE WHEN l_orderkey % 60 = 59 THEN concat('x', l_orderkey) ELSE cast(l_orderkey AS string) END",
            order_item_id="l_linenumber",
            product_id="CASE WHEN l_partkey % 50 = 49 THEN concat('x', l_partkey) ELSE cast(l_partkey AS string) END",
            seller_id="CASE WHEN l_suppkey % 10 = 9 THEN concat('x', l_suppkey) ELSE cast(l_suppkey AS string) END",
            shipping_limit_date="cast(l_shipdate AS timestamp)",
            price="CASE WHEN l_orderkey % 83 = 5 THEN -l_extendedprice ELSE l_extendedprice END",
            freight_value="l_extendedprice * l_tax",
            ingestion_time="cast(l_shipdate AS timestamp)",
        )

    def item_totals(self) -> DataFrame:
        """Value of all raw item rows of each order: what a payment has to be to match, where no item is repeated."""
        value = F.expr("l_extendedprice + l_extendedprice * l_tax")
        return (
            self.table("lineitem").groupBy(F.col("l_orderkey").alias("total_of")).agg(money_sum(value).alias("item_total"))
        )

    def payments(self) -> DataFrame:
        orders = self.table("orders").withColumn("paid_for", F.col("o_orderkey").cast("string"))
        return _select(
            orders.join(self.item_totals(), F.expr("o_orderkey = total_of"), "left"),
            "payments",
            order_id="CASE WHEN o_orderkey % 60 = 59 THEN concat('x', paid_for) ELSE paid_for END",
            payment_sequential="1",
            payment_type="CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 2 = 0 THEN 'Credit_Card ' ELSE 'boleto' END",
            payment_installments="CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE cast(o_orderkey % 12 AS int) END",
            payment_value="CASE WHEN o_custkey % 10 = 7 THEN floor(o_totalprice / 100) / 100 "
            "WHEN o_custkey % 10 = 8 THEN floor(o_totalprice / 200) / 100 "
            "WHEN o_orderkey % 3 = 0 AND item_total IS NOT NULL THEN cast(cast(item_total AS decimal(18, 2)) AS double) "
            "ELSE o_totalprice END",
        )

    def reviews(self) -> DataFrame:
        return _select(
            self.table("orders"),
            "reviews",
            review_id="concat('r', o_orderkey - CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END)",
            order_id="CASE WHEN o_orderkey % 60 = 59 THEN concat('x', o_orderkey) ELSE cast(o_orderkey AS string) END",
            review_score="CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 29 = 1 THEN 6 "
            "ELSE cast(substring(o_orderpriority, 1, 1) AS int) END",
            review_comment_title="CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE concat(' ', o_orderpriority) END",
            review_comment_message="CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderstatus END",
            review_creation_date="cast(o_orderdate AS timestamp) + make_interval(0, 0, 0, 20)",
            review_answer_timestamp="CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderdate AS timestamp) END",
            ingestion_time=f"{ARRIVED} + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 AS int))",
        )

    def products(self) -> DataFrame:
        return _select(
            self.table("part"),
            "products",
            product_id="cast(p_partkey AS string)",
            product_category_name="CASE WHEN p_partkey % 31 = 2 THEN ' ' ELSE lower(p_type) END",
            product_name_lenght="length(p_name)",
            product_description_lenght="CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE length(p_brand) END",
            product_photos_qty="CASE WHEN p_partkey % 71 = 3 THEN -1 ELSE cast(p_partkey % 6 AS int) END",
            product_weight_g="CASE WHEN p_partkey % 73 = 4 THEN -1.0D ELSE p_size * 100.0D END",
            product_length_cm="CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size * 1.5D END",
            product_height_cm="p_size * 0.5D",
            product_width_cm="p_size * 2.0D",
        )

    def sellers(self) -> DataFrame:
        shops = self.table("supplier").join(self.nations(), F.expr("s_nationkey = n_nationkey"), "left")
        return _select(
            shops,
            "sellers",
            seller_id="cast(s_suppkey AS string)",
            seller_zip_code_prefix="s_nationkey * 10 + cast(s_suppkey % 10 AS int)",
            seller_city="CASE WHEN s_suppkey % 8 = 1 THEN '' ELSE n_name END",
            seller_state="CASE WHEN s_suppkey % 13 = 7 THEN NULL ELSE lower(r_name) END",
        )

    def category_translation(self) -> DataFrame:
        return _select(
            self.table("part"),
            "category_translation",
            product_category_name="concat(lower(p_type), ' ')",
            product_category_name_english="CASE WHEN p_type = 'MEDIUM' THEN '  ' ELSE initcap(p_type) END",
            ingestion_time=f"{ARRIVED} + make_interval(0, 0, 0, 0, cast(p_partkey % 24 AS int))",
        )

    def web_events(self) -> DataFrame:
        """Every event once, and a second, later copy with a higher price for one event in fifty."""
        events = self.table("events").withColumn(
            "campaign",
            F.expr("CASE WHEN event_id % 7 < 6 THEN concat('cmp_00', 1 + event_id % 7) END"),
        )
        tags = F.broadcast(campaign_lookup(self.spark).withColumnRenamed("campaign_id", "campaign"))  # six fixed rows
        copies = F.expr("explode(CASE WHEN event_id % 50 = 4 THEN array(0, 1) ELSE array(0) END)")
        raw = events.join(tags, "campaign", "left").select("*", copies.alias("copy"))
        return _select(
            raw,
            "web_events",
            event_id="CASE WHEN event_id % 101 = 0 THEN '  ' ELSE cast(event_id AS string) END",
            event_time="CASE WHEN event_id % 101 = 1 THEN NULL ELSE date_trunc('second', cast(ts AS timestamp)) END",
            session_id="CASE WHEN event_id % 101 = 2 THEN '' ELSE concat('s', user_id, '-', cast(ts AS date)) END",
            user_id="CASE WHEN event_id % 97 = 3 THEN ' ' ELSE cast(user_id AS string) END",
            event_type="CASE WHEN event_type = 'view' THEN ' View_Product ' WHEN event_type = 'signup' THEN 'view_product' "
            "WHEN event_type = 'click' THEN 'add_to_cart' WHEN event_type = 'purchase' THEN 'purchase' "
            "WHEN event_id % 2 = 1 THEN 'error' END",
            product_id="CASE WHEN event_id % 107 = 9 THEN concat('x', event_id) ELSE cast(event_id % 200 AS string) END",
            order_id="CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 13 = 3 THEN NULL "
            "WHEN event_id % 103 = 5 THEN concat('x', event_id) ELSE cast(event_id AS string) END END",
            quantity="CASE WHEN event_id % 20 = 7 THEN 0 WHEN event_id % 20 = 8 THEN NULL ELSE cast(1 + event_id % 3 AS int) END",
            price_at_event="CASE WHEN event_id % 31 = 11 THEN -1.0D ELSE value + copy END",
            page_url="concat('/product/', event_id % 200)",
            referrer="referrer",
            utm_source="CASE WHEN event_id % 11 = 5 THEN ' ' ELSE upper(utm_source) END",
            utm_medium="utm_medium",
            utm_campaign="CASE WHEN event_id % 17 = 6 THEN NULL ELSE utm_campaign END",
            campaign_id="campaign",
            device="CASE WHEN event_id % 3 = 0 THEN ' Mobile ' WHEN event_id % 3 = 1 THEN 'desktop' END",
            browser="CASE WHEN event_id % 4 = 0 THEN 'Chrome' WHEN event_id % 4 = 1 THEN 'safari ' ELSE 'firefox' END",
            store_channel="coalesce(store_channel, 'website')",
            ingestion_time="date_trunc('second', cast(ts AS timestamp)) + make_interval(0, 0, 0, 0, copy)",
        )

    def ads_campaigns(self) -> DataFrame:
        """Daily roll-up of the web events. One campaign is renamed, so it has spend but no traffic, while its web
        events have traffic but no spend; counters are wrong on two days of the month."""
        folded = {c: norm_text(F.col(c), "lower") for c in ("event_type", "utm_source")}
        events = self.web_events().withColumns(folded)
        ads = rollup_ads_daily(events)
        return ads.selectExpr(
            "date",
            "CASE WHEN campaign_id = 'cmp_006' THEN 'cmp_900 ' ELSE campaign_id END AS campaign_id",
            "campaign_name",
            "channel",
            "source",
            "medium",
            "CASE WHEN day(date) = 13 THEN clicks - 1 ELSE impressions END AS impressions",
            "clicks",
            "CASE WHEN day(date) = 17 THEN clicks + 1 ELSE conversions END AS conversions",
            "cost",
            "' usd' AS currency",
            "cast(date_add(date, 1) AS timestamp) AS ingestion_time",
            "'ads_api' AS source_api",
        )


BRONZE: dict[str, Callable[[DriverTables], DataFrame]] = {
    "bronze_customers": DriverTables.customers,
    "bronze_geolocation": DriverTables.geolocation,
    "bronze_orders": DriverTables.orders,
    "bronze_order_items": DriverTables.order_items,
    "bronze_payments": DriverTables.payments,
    "bronze_reviews": DriverTables.reviews,
    "bronze_products": DriverTables.products,
    "bronze_sellers": DriverTables.sellers,
    "bronze_category_translation": DriverTables.category_translation,
    "bronze_web_events": DriverTables.web_events,
    "bronze_ads_campaigns": DriverTables.ads_campaigns,
}
