"""The fixed campaign table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Campaign(NamedTuple):
    campaign_bucket: int
    campaign_id: str
    campaign_name: str
    referrer: str
    utm_source: str
    utm_medium: str
    utm_campaign: str
    store_channel: str


# Fixed values.
CAMPAIGNS = (
    Campaign(0, "cmp_001", "Search - Electronics", "google_ads", "google", "cpc", "search_electronics", "website"),
    Campaign(
        1, "cmp_002", "Social - Home & Living", "facebook_ads", "facebook", "paid_social", "social_home_living", "website"
    ),
    Campaign(
        2,
        "cmp_003",
        "Retargeting - Marketplace",
        "instagram_ads",
        "instagram",
        "display",
        "retargeting_marketplace",
        "website",
    ),
    Campaign(3, "cmp_004", "CRM - High Intent", "email", "newsletter", "email", "crm_high_intent", "website"),
    Campaign(4, "cmp_005", "Search - Fashion", "google_ads", "google", "cpc", "search_fashion", "website"),
    Campaign(
        5, "cmp_006", "Social - Baby & Toys", "tiktok_ads", "tiktok", "paid_social", "social_baby_toys", "mobile_app"
    ),
)

SCHEMA = (
    "campaign_bucket bigint, campaign_id string, campaign_name string, referrer string, utm_source string, "
    "utm_medium string, utm_campaign string, store_channel string"
)


def campaign_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAMPAIGNS, SCHEMA)
