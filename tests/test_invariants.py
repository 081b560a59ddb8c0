"""Properties of the saved datasets of a full run."""

import pytest
from pyspark.sql import functions as F

from tidemart.plans.silver import CLEAN_TABLES
from tidemart.plans.warehouse import DATASETS

GRAIN = {name: list(spec.key) for name, spec in CLEAN_TABLES.items()} | {
    "silver_products_enriched": ["product_id"],
    "bridge_identity": ["website_user_id", "customer_unique_id", "customer_id"],
    "bridge_campaign_mapping": ["campaign_id", "ads_campaign_name", "utm_campaign", "source", "medium", "channel"],
    "reconciliation_orders_payments": ["order_id"],
    "dim_campaign": ["campaign_key"],
    "dim_channel": ["channel_key"],
    "dim_customer": ["customer_key"],
    "dim_date": ["date_key"],
    "dim_geolocation": ["geolocation_key"],
    "dim_product": ["product_key"],
    "dim_seller": ["seller_key"],
    "fact_orders": ["order_id", "customer_geolocation_key"],
    "fact_order_items": ["order_id", "order_item_id", "seller_geolocation_key"],
    "fact_order_logistics": ["order_id", "customer_geolocation_key"],
    "fact_marketing_spend_daily": ["date_key", "campaign_key"],
    "fact_web_funnel_daily": ["date_key", "campaign_key", "channel_key", "device"],
}


@pytest.mark.parametrize("name", sorted(GRAIN))
def test_grain(saved, name):
    df = saved[name]
    assert df.count() == df.select(*GRAIN[name]).distinct().count() > 0


def test_every_dataset_is_saved(saved):
    assert {d for d in DATASETS if saved[d].count() > 0} == set(DATASETS)


def test_marts_add_up_to_the_facts(saved):
    mart, spend, funnel = (
        saved[n] for n in ("mart_sales_marketing_360", "fact_marketing_spend_daily", "fact_web_funnel_daily")
    )
    got = mart.agg(F.sum("clicks"), F.sum("views"), F.sum("sessions")).first()
    assert got[0] == spend.agg(F.sum("clicks")).first()[0]
    assert tuple(got[1:]) == tuple(funnel.agg(F.sum("view_product_count"), F.sum("session_count")).first())
    assert saved["mart_kpi_daily"].count() == mart.count()


def test_saved_equals_lazy(saved, warehouse):
    for name in ("fact_orders", "mart_kpi_daily", "mart_customer_summary"):
        assert sorted(map(str, saved[name].collect())) == sorted(map(str, warehouse[name].collect()))


def test_rows_without_a_campaign_stay_separate(saved):
    rows = saved["mart_sales_marketing_360"].filter("campaign_key IS NULL")
    assert rows.filter("views > 0 AND orders > 0").count() == 0 < rows.count()
