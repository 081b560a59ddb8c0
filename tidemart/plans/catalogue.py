"""Named queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import hash_bucket, session_id
from tidemart.operators.latest import keep_latest
from tidemart.operators.sampling import hash_sample
from tidemart.plans import incremental, marts, prep, quality
from tidemart.plans.warehouse import Warehouse
from tidemart.schemas import CSV_SOURCES, WEB_EVENTS_JSON
from tidemart.sources.driver_tables import DriverTables
from tidemart.sources.files import read_csv
from tidemart.sources.published import open_table
from tidemart.sources.scratch import scratch_folder
from tidemart.streaming.ingest import WEB_KEYS, bronze_reader, ingest_ads, ingest_csv_sources, ingest_web_events
from tidemart.streaming.landing import AUDIT, CSV_READ_OPTIONS, WEB_RECORDS, land_ads, land_csv, land_web
from tidemart.streaming.upserts import Upserted

Query = Callable[[SparkSession, str], DataFrame]

# When a run happened, and hash keys, which SQL engines do not share.
RUN_COLUMNS = ("silver_processed_at", "checked_at", "detected_at", "quarantined_at")
KEY_COLUMNS = (
    "campaign_key", "channel_key", "customer_key", "product_key", "seller_key", "geolocation_key",
    "customer_geolocation_key", "seller_geolocation_key",
)

# Open orders are judged on this day.
AS_OF = "DATE '2001-06-30'"


# A share of the rows so small that the lookup columns of the driver tables have many values above it.
FORCED_SHARE = 1 / 1024


def tables(spark: SparkSession, directory: str) -> Warehouse:
    return Warehouse(DriverTables(spark, directory).bronze)


def split_tables(spark: SparkSession, directory: str) -> Warehouse:
    """Like ``tables``, with nearly every lookup key split, to compare the split joins with the plain definition."""
    return Warehouse(DriverTables(spark, directory).bronze, hot_share=FORCED_SHARE)


# Tables that the campaign datasets read several times.
CAMPAIGN_TABLES = ("silver_web_events", "silver_ads_campaigns", "bridge_campaign_mapping", "dim_campaign")


def campaign_tables(spark: SparkSession, directory: str) -> Warehouse:
    """Like ``tables``, with the tables the campaign datasets share saved once."""
    return Warehouse(DriverTables(spark, directory).bronze, scratch_folder(spark), CAMPAIGN_TABLES)


def comparable(df: DataFrame) -> DataFrame:
    return df.drop(*RUN_COLUMNS, *KEY_COLUMNS)


def dataset(name: str, make: Callable[[SparkSession, str], Warehouse] = tables) -> Query:
    return lambda spark, directory: comparable(make(spark, directory)[name])


Make = Callable[[SparkSession, str], Warehouse]
KNOWN = {"fact_orders": ("customer",), "fact_order_logistics": ("customer",), "fact_order_items": ("product", "seller")}


def fact_with_place(name: str, make: Make = tables, **options: object) -> Query:
    """A fact with the place instead of its key, and whether the other keys were found."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        fact = make(spark, directory).build(name, show_place=True, **options)
        return comparable(fact.withColumns({f"has_{p}": F.col(f"{p}_key").isNotNull() for p in KNOWN[name]}))

    return query


def fact_logistics(make: Make = tables) -> Query:
    return lambda spark, directory: fact_with_place("fact_order_logistics", make, as_of=F.expr(AS_OF))(spark, directory)


def fact_spend(spark: SparkSession, directory: str) -> DataFrame:
    spend = tables(spark, directory)["fact_marketing_spend_daily"]
    return comparable(spend.withColumn("has_campaign", F.col("campaign_key").isNotNull()))


def mart_customer(make: Make = tables) -> Query:
    return lambda spark, directory: comparable(make(spark, directory).build("mart_customer_summary", show_place=True))


def mart_customer_one_place(spark: SparkSession, directory: str) -> DataFrame:
    """One row per customer: order facts and customers take one place per zip."""
    w = tables(spark, directory)
    hot = w.hot_keys(("silver_customers", "silver_orders"))
    merged = {c: s for columns in hot.values() for c, s in columns.items()}
    mart = marts.mart_customer_summary(
        w["silver_customers"], w.build("fact_orders", geo_per_zip=True), w["silver_orders"],
        w["silver_order_reviews"], w["dim_geolocation"], merged, geo_per_zip=True, show_place=True,
    )
    return comparable(mart)


def _fact_funnel(w: Warehouse) -> DataFrame:
    campaigns = w["dim_campaign"].select("campaign_key", "campaign_id")
    named = w["fact_web_funnel_daily"].join(campaigns, "campaign_key", "left")
    return comparable(named.join(w["dim_channel"], "channel_key", "left"))


def fact_funnel(spark: SparkSession, directory: str) -> DataFrame:
    return _fact_funnel(campaign_tables(spark, directory))


def quarantine_strict(spark: SparkSession, directory: str) -> DataFrame:
    return comparable(quality.quarantine_web_events(tables(spark, directory)["bronze_web_events"], strict=True))


def fact_orders_one_place(spark: SparkSession, directory: str) -> DataFrame:
    return fact_with_place("fact_orders", geo_per_zip=True)(spark, directory).drop("has_customer")


def mart_counted_once(spark: SparkSession, directory: str) -> DataFrame:
    """Sessions and users per day and campaign counted once, and each order paid once."""
    w = campaign_tables(spark, directory)
    hot = w.hot_keys(("silver_web_events",))["silver_web_events"]
    campaigns = w["dim_campaign"]
    attributed = marts.attributed_orders(w["silver_web_events"], w["fact_orders"], campaigns, hot, per_order=True)
    funnel = marts.funnel_recount(w["silver_web_events"], campaigns, hot)
    return comparable(
        marts.mart_sales_marketing_360(w["fact_marketing_spend_daily"], funnel, attributed, campaigns)
    )


def surrogate_keys(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and distinct keys per dimension."""
    w = tables(spark, directory)
    keys = {
        "dim_campaign": "campaign_key", "dim_channel": "channel_key", "dim_customer": "customer_key",
        "dim_geolocation": "geolocation_key", "dim_product": "product_key", "dim_seller": "seller_key",
    }
    counts = [
        w[name].agg(
            F.lit(name).alias("dimension"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(key).alias("key_count"),
        )
        for name, key in keys.items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def item_base(w: Warehouse) -> DataFrame:
    bronze = ("orders", "customers", "order_items", "products", "payments", "category_translation")
    raw = {name: w[f"bronze_{name}"].drop("ingestion_time", "source_file") for name in bronze}
    raw["customers"] = raw["customers"].withColumn("customer_id", F.trim("customer_id"))
    translation = w["silver_category_translation"]
    hot = w.hot_keys(("silver_orders", "silver_order_items", "silver_products"))
    merged = {c: s for columns in hot.values() for c, s in columns.items()}
    return prep.order_item_base(
        raw["orders"], raw["customers"], raw["order_items"], raw["products"], raw["payments"], translation, merged
    )


def prep_item_base(spark: SparkSession, directory: str) -> DataFrame:
    return item_base(tables(spark, directory))


def prep_payment_rollup(spark: SparkSession, directory: str) -> DataFrame:
    return prep.payment_rollup(tables(spark, directory)["bronze_payments"])


def prep_session_id(spark: SparkSession, directory: str) -> DataFrame:
    base = item_base(tables(spark, directory))
    ids = [F.col(c) for c in ("customer_unique_id", "order_id", "product_id")]
    return base.select("order_id", "order_item_id", "product_id", session_id(*ids).alias("session_id"))


def prep_expand_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events without the campaign tags, which depend on the engine's hash."""
    tags = ("campaign_id", "referrer", "utm_source", "utm_medium", "utm_campaign", "store_channel")
    events = prep.expand_to_events(prep.with_campaign(item_base(tables(spark, directory))))
    return events.drop(*tags)


def prep_ads_rollup(spark: SparkSession, directory: str) -> DataFrame:
    return prep.rollup_ads_daily(tables(spark, directory)["silver_web_events"])


def prep_campaign_days(spark: SparkSession, directory: str) -> DataFrame:
    """Events of each kind per day, campaign and tags."""
    return prep.campaign_day_counts(tables(spark, directory)["silver_web_events"])


def prep_labels(spark: SparkSession, directory: str) -> DataFrame:
    web = tables(spark, directory)["silver_web_events"]
    labels = {
        "campaign_name": prep.campaign_name(F.col("campaign_id")),
        "channel": prep.channel_name(F.col("utm_source")),
    }
    grouped = web.withColumns(labels).groupBy("campaign_id", "utm_source", *labels)
    return grouped.agg(F.count(F.lit(1)).alias("event_count"))


def hash_bucket_campaigns(spark: SparkSession, directory: str) -> DataFrame:
    """Per English category: products, buckets its products fall into, and whether all buckets are in range."""
    enriched = tables(spark, directory)["silver_products_enriched"]
    named = enriched.select("product_category_name_english", hash_bucket(F.col("product_category_name_english"), 6).alias("b"))
    return named.groupBy("product_category_name_english").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.count_distinct(F.coalesce("b", F.lit(-1))).alias("bucket_count"),
        F.bool_and(F.col("b").between(0, 5)).alias("in_range"),
    )


def hash_sample_items(spark: SparkSession, directory: str) -> DataFrame:
    """The generator's sample of order items: its size, and how many of its rows are rows of the items as often."""
    w = tables(spark, directory)
    keys = ["order_id", "order_item_id", "product_id", "seller_id", "price"]
    base = item_base(w).select(*keys)
    sampled = hash_sample(base, ["order_id", "order_item_id"]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    have = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("there"))
    same = [sampled[k].eqNullSafe(have[k]) for k in keys]
    found = sampled.join(have, same, "left")
    return found.agg(
        F.sum("n").alias("sample_rows"), F.sum(F.when(F.col("n") <= F.col("there"), F.col("n"))).alias("known_rows")
    )


QUERIES: dict[str, Query] = {
    "clean_categories": dataset("silver_category_translation"),
    "clean_customers": dataset("silver_customers"),
    "clean_geolocation": dataset("silver_geolocation"),
    "clean_orders": dataset("silver_orders"),
    "clean_order_items": dataset("silver_order_items"),
    "clean_payments": dataset("silver_order_payments"),
    "clean_reviews": dataset("silver_order_reviews"),
    "clean_products": dataset("silver_products"),
    "clean_sellers": dataset("silver_sellers"),
    "clean_web_events": dataset("silver_web_events"),
    "clean_ads": dataset("silver_ads_campaigns"),
    "products_enriched": dataset("silver_products_enriched"),
    "bridge_identity": dataset("bridge_identity"),
    "bridge_campaign": dataset("bridge_campaign_mapping"),
    "quarantine_web": dataset("quarantine_web_events"),
    "quarantine_web_strict": quarantine_strict,
    "reconcile_orders": dataset("reconciliation_orders_payments"),
    "referential_issues": dataset("referential_integrity_issues"),
    "dim_campaign": dataset("dim_campaign"),
    "dim_channel": dataset("dim_channel"),
    "dim_customer": dataset("dim_customer"),
    "dim_date": dataset("dim_date"),
    "dim_geolocation": dataset("dim_geolocation"),
    "dim_product": dataset("dim_product"),
    "dim_seller": dataset("dim_seller"),
    "surrogate_key_check": surrogate_keys,
    "fact_orders": fact_with_place("fact_orders"),
    "fact_orders_one_place": fact_orders_one_place,
    "fact_order_items": fact_with_place("fact_order_items"),
    "fact_logistics": fact_logistics(),
    "fact_spend": fact_spend,
    "fact_funnel": fact_funnel,
    "mart_sales_marketing": dataset("mart_sales_marketing_360", campaign_tables),
    "mart_counted_once": mart_counted_once,
    "mart_kpi": dataset("mart_kpi_daily", campaign_tables),
    "mart_customer": mart_customer(),
    "mart_customer_one_place": mart_customer_one_place,
    "split_fact_orders": fact_with_place("fact_orders", split_tables),
    "split_fact_order_items": fact_with_place("fact_order_items", split_tables),
    "split_fact_logistics": fact_logistics(split_tables),
    "split_fact_funnel": lambda spark, directory: _fact_funnel(split_tables(spark, directory)),
    "split_bridge_identity": dataset("bridge_identity", split_tables),
    "split_referential_issues": dataset("referential_integrity_issues", split_tables),
    "split_item_base": lambda spark, directory: item_base(split_tables(spark, directory)),
    "split_mart_customer": mart_customer(split_tables),
    "prep_payment_rollup": prep_payment_rollup,
    "prep_item_base": prep_item_base,
    "prep_session_id": prep_session_id,
    "prep_expand_events": prep_expand_events,
    "prep_ads_rollup": prep_ads_rollup,
    "prep_campaign_days": prep_campaign_days,
    "prep_labels": prep_labels,
    "hash_bucket": hash_bucket_campaigns,
    "hash_sample": hash_sample_items,
}


def _ingest_folders(spark: SparkSession) -> tuple[str, str, str]:
    folder = scratch_folder(spark)
    return f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoints"


def ingest_csv_append(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as CSV in two landing runs, streamed in two starts: each start appends only its new files."""
    orders = tables(spark, directory)["bronze_orders"]
    landing, bronze, checkpoints = _ingest_folders(spark)
    early = F.coalesce(F.col("order_purchase_timestamp") < F.lit("1999-01-01").cast("timestamp"), F.lit(False))
    for part in (orders.filter(early), orders.filter(~early)):
        land_csv(part, landing, "orders")
        ingest_csv_sources(spark, landing, bronze, checkpoints, ["orders"], CSV_READ_OPTIONS)
    return bronze_reader(spark, bronze)("bronze_orders").drop(*AUDIT)


def _land_web_in_two_runs(spark: SparkSession, directory: str) -> tuple[DataFrame, str]:
    """First copies of all events, then the later copies; both runs are ingested by separate starts."""
    raw = tables(spark, directory)["bronze_web_events"]
    landing, bronze, checkpoints = _ingest_folders(spark)
    updated = F.col("event_time") < F.col("ingestion_time")
    web = raw
    for run, part in (("run_1", raw.filter(~updated | updated.isNull())), ("run_2", raw.filter(updated))):
        land_web(part, landing, run)
        web = ingest_web_events(spark, landing, bronze, checkpoints)
    return web, bronze


def ingest_json_upsert_web(spark: SparkSession, directory: str) -> DataFrame:
    web, _ = _land_web_in_two_runs(spark, directory)
    return web.drop(*AUDIT)


def ingest_late_update(spark: SparkSession, directory: str) -> DataFrame:
    """Rows per batch of the web log, and how many of them are the current row of their key."""
    _, bronze = _land_web_in_two_runs(spark, directory)
    log = Upserted(spark, f"{bronze}/bronze_web_events").deltas()
    written = log.groupBy(F.col("batch_id").cast("int").alias("batch_id")).agg(F.count(F.lit(1)).alias("log_rows"))
    current = keep_latest(log, WEB_KEYS, newest=("batch_id",)).groupBy(F.col("batch_id").cast("int").alias("batch_id"))
    return written.join(current.agg(F.count(F.lit(1)).alias("current_rows")), "batch_id", "left")


def ingest_json_upsert_web_at_once(spark: SparkSession, directory: str) -> DataFrame:
    """Both runs lie in the landing folder before the first start: the later run still wins."""
    raw = tables(spark, directory)["bronze_web_events"]
    landing, bronze, checkpoints = _ingest_folders(spark)
    updated = F.coalesce(F.col("event_time") < F.col("ingestion_time"), F.lit(False))
    for run, part in (("run_1", raw.filter(~updated)), ("run_2", raw.filter(updated))):
        land_web(part, landing, run)
    return ingest_web_events(spark, landing, bronze, checkpoints).drop(*AUDIT)


def ingest_json_upsert_ads(spark: SparkSession, directory: str) -> DataFrame:
    """All raw ads rows, then the same with a higher cost."""
    raw = tables(spark, directory)["bronze_ads_campaigns"]
    landing, bronze, checkpoints = _ingest_folders(spark)
    land_ads(raw, landing, "run_1")
    ingest_ads(spark, landing, bronze, checkpoints)
    land_ads(raw.withColumn("cost", F.col("cost") + 1), landing, "run_2")
    return ingest_ads(spark, landing, bronze, checkpoints).drop(*AUDIT)


def _refreshed(spark: SparkSession, directory: str) -> str:
    """The marketing tables built after a first ingest and refreshed after a second one: later copies of some events, and ads of
    some days at another cost. Returns their folder."""
    w = tables(spark, directory)
    landing, bronze, checkpoints = _ingest_folders(spark)
    out = f"{bronze}-marketing"
    web, ads = w["bronze_web_events"], w["bronze_ads_campaigns"]
    updated = F.coalesce(F.col("event_time") < F.col("ingestion_time"), F.lit(False))
    later = ads.filter(F.day("date") <= 2).withColumn("cost", F.col("cost") + 1)
    for run, new_web, new_ads, follow in (("run_1", web.filter(~updated), ads, incremental.build), ("run_2", web.filter(updated), later, incremental.refresh)):
        land_web(new_web, landing, run)
        land_ads(new_ads, landing, run)
        ingest_web_events(spark, landing, bronze, checkpoints)
        ingest_ads(spark, landing, bronze, checkpoints)
        follow(spark, bronze, out)
    return out


def incremental_bridge(spark: SparkSession, directory: str) -> DataFrame:
    return comparable(open_table(spark, f"{_refreshed(spark, directory)}/bridge_campaign_mapping"))


def incremental_spend(spark: SparkSession, directory: str) -> DataFrame:
    spend = open_table(spark, f"{_refreshed(spark, directory)}/fact_marketing_spend_daily")
    return comparable(spend.withColumn("has_campaign", F.col("campaign_key").isNotNull()))


def incremental_funnel(spark: SparkSession, directory: str) -> DataFrame:
    out = _refreshed(spark, directory)
    fact, campaigns, channels = (open_table(spark, f"{out}/{n}") for n in ("fact_web_funnel_daily", "dim_campaign", "dim_channel"))
    named = fact.join(campaigns.select("campaign_key", "campaign_id"), "campaign_key", "left")
    return comparable(named.join(channels, "channel_key", "left"))


def _land_all_csv(spark: SparkSession, directory: str) -> tuple[str, str, str]:
    """All nine CSV sources, written side by side; the sellers in another order of columns, with one more."""
    w = tables(spark, directory)
    landing, bronze, checkpoints = _ingest_folders(spark)
    sources = {name: w[f"bronze_{name}"].drop(*AUDIT) for name in CSV_SOURCES}
    noted = ("seller_state", F.lit("x").alias("seller_note"), "seller_id", "seller_zip_code_prefix", "seller_city")
    sources["sellers"] = sources["sellers"].select(*noted)
    with ThreadPoolExecutor(len(sources)) as pool:
        list(pool.map(lambda name: land_csv(sources[name], landing, name), sources))
    return landing, bronze, checkpoints


def ingest_csv_headers(spark: SparkSession, directory: str) -> DataFrame:
    """Sellers in three files with headers of their own: two orders of columns in the first start, a column more in the
    second. Earlier rows have no value in the new column."""
    sellers = tables(spark, directory)["bronze_sellers"].drop(*AUDIT)
    landing, bronze, checkpoints = _ingest_folders(spark)
    third = F.coalesce(F.col("seller_zip_code_prefix") % 3, F.lit(0))
    land_csv(sellers.filter(third == 0), landing, "sellers")
    land_csv(sellers.filter(third == 1).select(*reversed(sellers.columns)), landing, "sellers")
    ingest_csv_sources(spark, landing, bronze, checkpoints, ["sellers"], CSV_READ_OPTIONS)
    noted = sellers.filter(third == 2).select("seller_state", F.concat(F.lit("n"), "seller_id").alias("seller_note"), "seller_id", "seller_zip_code_prefix", "seller_city")
    land_csv(noted, landing, "sellers")
    ingest_csv_sources(spark, landing, bronze, checkpoints, ["sellers"], CSV_READ_OPTIONS)
    return bronze_reader(spark, bronze)("bronze_sellers").drop(*AUDIT)


#: Types in which values are told apart; whole numbers and times are longs.
VALUE = ("string", "double", "bigint")


def _column_values(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """One row per value: the column's number, and the value as the one of ``VALUE`` that its type goes to. Column -1 stands
    for the row itself."""
    marked, names = {}, [-1, *range(len(fields))]
    for i in names:
        kind = fields[i].dataType.simpleString() if i >= 0 else None
        for to in VALUE:
            mine = to == kind or to == "bigint" and kind in ("int", "timestamp")
            value = F.lit(None) if not mine else F.unix_micros(fields[i].name) if kind == "timestamp" else F.col(fields[i].name)
            marked[f"{to}_{i}"] = value.cast(to)
    listed = ", ".join(f"({', '.join(f'`{to}_{i}`' for to in VALUE)}) AS `{i}`" for i in names)
    wide = rows.select(*[value.alias(name) for name, value in marked.items()])
    long = f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join(f'`{to}`' for to in VALUE)}) FOR i IN ({listed}))"
    return rows.sparkSession.sql(long, wide=wide).withColumn("i", F.col("i").cast("int"))


def _csv_summary(read: Callable[[str], DataFrame]) -> DataFrame:
    """Rows per source, and per column how many values it has and how many differ.

    A row becomes one short row per value, and equal ones are counted; distinct counts of all columns side by side would
    carry the fields of every column along with each value."""
    parts = []
    for name, ddl in CSV_SOURCES.items():
        fields = T.StructType.fromDDL(ddl).fields
        different = _column_values(read(name), fields).groupBy("i", *VALUE).agg(F.count(F.lit(1)).alias("n"))
        filled = F.col("string").isNotNull() | F.col("double").isNotNull() | F.col("bigint").isNotNull()
        measures = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.coalesce(F.sum(F.when((F.col("i") == i) & filled, F.col("n"))), F.lit(0)).alias("values"),
                F.count_if((F.col("i") == i) & filled).alias("distinct_values"),
            )
            for i, f in enumerate(fields)
        ]
        row_count = F.coalesce(F.sum(F.when(F.col("i") == -1, F.col("n"))), F.lit(0)).alias("row_count")
        summed = different.agg(row_count, F.array(*measures).alias("m"))
        parts.append(summed.select(F.lit(name).alias("source"), "row_count", F.inline("m")))
    return reduce(DataFrame.unionByName, parts)


def ingest_csv_all(spark: SparkSession, directory: str) -> DataFrame:
    """All nine streams side by side."""
    landing, bronze, checkpoints = _land_all_csv(spark, directory)
    ingest_csv_sources(spark, landing, bronze, checkpoints, options=CSV_READ_OPTIONS)
    return _csv_summary(bronze_reader(spark, bronze, prefix="bronze_"))


def read_csv_all(spark: SparkSession, directory: str) -> DataFrame:
    """All nine sources read as a batch."""
    landing, _, _ = _land_all_csv(spark, directory)
    return _csv_summary(lambda name: read_csv(spark, f"{landing}/{name}", CSV_SOURCES[name], options=CSV_READ_OPTIONS))


def sink_json_layout(spark: SparkSession, directory: str) -> DataFrame:
    """Web events written as landing JSON and read back: rows per campaign, and whether every file of the landing run
    that holds some keeps to its size limit."""
    landing, _, _ = _ingest_folders(spark)
    land_web(tables(spark, directory)["bronze_web_events"], landing, "run_1")
    back = spark.read.schema(WEB_EVENTS_JSON).json(f"{landing}/web_events/run_1")
    files = back.groupBy("campaign_id", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    whole = files.groupBy("file").agg(F.sum("n").alias("in_file"))
    return files.join(whole, "file").groupBy("campaign_id").agg(
        F.sum("n").alias("row_count"), (F.max("in_file") <= WEB_RECORDS).alias("within_limit")
    )


QUERIES.update(
    {
        "ingest_csv_append": ingest_csv_append,
        "ingest_json_upsert_web": ingest_json_upsert_web,
        "ingest_json_upsert_web_at_once": ingest_json_upsert_web_at_once,
        "ingest_json_upsert_ads": ingest_json_upsert_ads,
        "ingest_csv_all": ingest_csv_all,
        "ingest_csv_headers": ingest_csv_headers,
        "read_csv_all": read_csv_all,
        "ingest_late_update": ingest_late_update,
        "incremental_bridge": incremental_bridge,
        "incremental_spend": incremental_spend,
        "incremental_funnel": incremental_funnel,
        "sink_json_layout": sink_json_layout,
    }
)
