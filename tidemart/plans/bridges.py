"""Links between web users and customers, and between web campaigns and ads campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.cleaning import stamp
from tidemart.operators.skew import Slots, spread_join


def bridge_identity(web: DataFrame, customers: DataFrame, hot: Slots | None = None) -> DataFrame:
    """Web activity per (user, customer record).

    Events are rolled up to one row per user before the join, so neither the join nor its output grows with the
    number of events of a busy user. ``customers`` has one row per customer_id, as the clean table does.
    """
    activity = (
        web.filter(F.col("user_id").isNotNull())
        .groupBy(F.col("user_id").alias("customer_unique_id"))
        .agg(
            F.min("event_time").alias("first_seen_at"),
            F.max("event_time").alias("last_seen_at"),
            F.count_distinct("session_id").alias("session_count"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )
    people = customers.select("customer_unique_id", "customer_id")
    linked = spread_join(people, activity, "customer_unique_id", hot, ["customer_id"], "inner")
    return stamp(
        linked.select(
            F.col("customer_unique_id").alias("website_user_id"),
            "customer_unique_id",
            "customer_id",
            "first_seen_at",
            "last_seen_at",
            "session_count",
            "event_count",
            F.lit("web.user_id = customers.customer_unique_id").alias("match_rule"),
            F.lit(True).alias("is_current"),
        ),
        "silver_web_events + silver_customers",
    )


# Tasks over which the web tuples of one campaign are dealt.
PIECES = 16


def _span(df: DataFrame, keys: dict[str, str], day: str, prefix: str) -> DataFrame:
    """Distinct key tuples with their first and last day."""
    return df.groupBy(*[F.col(c).alias(name) for name, c in keys.items()]).agg(
        F.min(day).alias(f"{prefix}_first"), F.max(day).alias(f"{prefix}_last")
    )


def _full_by_campaign(seen: DataFrame, bought: DataFrame) -> DataFrame:
    """Full join by campaign, the web tuples of a campaign dealt over PIECES tasks: ads tuples are repeated for them,
    and those without any web tuple are added."""
    piece = F.pmod(F.xxhash64("utm_campaign", "web_source", "web_medium"), F.lit(PIECES)).cast("int")
    dealt = bought.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    matched = seen.withColumn("_piece", piece).join(dealt, ["campaign_id", "_piece"], "left").drop("_piece")
    only_bought = bought.join(seen.select("campaign_id").distinct(), "campaign_id", "left_anti")
    return matched.unionByName(only_bought, allowMissingColumns=True)


def bridge_campaign_mapping(web: DataFrame, ads: DataFrame) -> DataFrame:
    """Every (campaign, ads name, web tags, channel) combination seen, with its active period and match quality.

    Joining events to ads days directly costs events x days per campaign. Both sides are first reduced to their
    distinct tuples; the joined rows carry the period of the web tuple where there is one, else that of the ads.
    """
    seen = _span(
        web.filter(F.col("campaign_id").isNotNull()),
        {
            "campaign_id": "campaign_id",
            "utm_campaign": "utm_campaign",
            "web_source": "utm_source",
            "web_medium": "utm_medium",
        },
        "event_date",
        "web",
    )
    bought = _span(
        ads.filter(F.col("campaign_id").isNotNull()),
        {
            "campaign_id": "campaign_id",
            "ads_campaign_name": "campaign_name",
            "ads_source": "source",
            "ads_medium": "medium",
            "channel": "channel",
        },
        "campaign_date",
        "ads",
    )
    named = F.col("ads_campaign_name").isNotNull()
    tagged = F.col("utm_campaign").isNotNull()
    return stamp(
        _full_by_campaign(seen, bought)
        .groupBy(
            "campaign_id",
            "ads_campaign_name",
            "utm_campaign",
            F.coalesce("web_source", "ads_source").alias("source"),
            F.coalesce("web_medium", "ads_medium").alias("medium"),
            "channel",
        )
        .agg(
            F.min(F.coalesce("web_first", "ads_first")).alias("first_seen_date"),
            F.max(F.coalesce("web_last", "ads_last")).alias("last_seen_date"),
        )
        .withColumns(
            {
                "mapping_quality": F.when(named & tagged, "high").when(named | tagged, "medium").otherwise("low"),
                "match_rule": F.lit("campaign_id direct match"),
            }
        ),
        "silver_web_events + silver_ads_campaigns",
    )
