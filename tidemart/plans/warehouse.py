"""All datasets with their inputs, and the two ways to make them: lazily on top of the raw tables, or one after
the other as saved tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.cleaning import tidy
from tidemart.operators.skew import HotKeys, measure_hot_keys
from tidemart.plans import bridges, dims, facts, marts, quality, silver
from tidemart.sources.files import materialize

TableHotKeys = Mapping[str, HotKeys]

# Columns of the clean tables that other tables are looked up by. Any of them may have a value that owns a large
# part of the rows.
LOOKUP_COLUMNS: dict[str, tuple[str, ...]] = {
    "silver_orders": ("customer_id",),
    "silver_order_items": ("order_id", "product_id", "seller_id"),
    "silver_order_payments": ("order_id",),
    "silver_order_reviews": ("order_id",),
    "silver_customers": ("customer_zip_code_prefix", "customer_unique_id"),
    "silver_sellers": ("seller_zip_code_prefix",),
    "silver_products": ("product_category_name",),
    "silver_web_events": ("campaign_id", "order_id", "product_id"),
}


@dataclass(frozen=True)
class Dataset:
    """``build(hot, *inputs)`` makes the dataset; ``skewed`` names the inputs whose hot keys it wants to know."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    skewed: tuple[str, ...] = ()


def _plain(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    return lambda hot, *inputs: function(*inputs)


def _flat(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions that take one column -> slots mapping over all their inputs."""

    def build(hot: TableHotKeys, *inputs: DataFrame, **options: object) -> DataFrame:
        return function(*inputs, hot={c: s for columns in hot.values() for c, s in columns.items()}, **options)

    return build


def _integrity(hot: TableHotKeys, *inputs: DataFrame) -> DataFrame:
    return quality.referential_integrity_issues(dict(zip(INTEGRITY_TABLES, inputs, strict=True)), hot)


INTEGRITY_TABLES = tuple(dict.fromkeys(t for c in quality.REFERENCE_CHECKS for t in (c.table, c.target)))


def _fact_orders(orders, items, payments, customers, geolocation, hot, **options):
    return facts.fact_orders(orders, items, payments, dims.customer_lookup(customers), geolocation, hot, **options)


def _fact_order_items(items, orders, products, sellers, geolocation, hot, **options):
    return facts.fact_order_items(items, orders, dims.product_lookup(products), sellers, geolocation, hot, **options)


def _fact_order_logistics(orders, items, customers, geolocation, hot, **options):
    return facts.fact_order_logistics(
        orders, items, dims.customer_lookup(customers), geolocation, hot=hot, **options
    )


def _mart_sales_marketing(spend, funnel, web, order_facts, campaigns, hot):
    attributed = marts.attributed_orders(web, order_facts, campaigns, hot)
    return marts.mart_sales_marketing_360(spend, marts.funnel_totals(funnel), attributed, campaigns)


SILVER: tuple[Dataset, ...] = (
    *[
        Dataset(name, (spec.source,), _plain(partial(silver.clean_table, name)))
        for name, spec in silver.CLEAN_TABLES.items()
    ],
    Dataset(
        "silver_products_enriched",
        ("silver_products", "silver_category_translation"),
        lambda hot, p, t: silver.products_enriched(p, t, hot["silver_products"]["product_category_name"]),
        ("silver_products",),
    ),
    Dataset(
        "bridge_identity",
        ("silver_web_events", "silver_customers"),
        lambda hot, w, c: bridges.bridge_identity(w, c, hot["silver_customers"]["customer_unique_id"]),
        ("silver_customers",),
    ),
    Dataset(
        "bridge_campaign_mapping",
        ("silver_web_events", "silver_ads_campaigns"),
        _plain(bridges.bridge_campaign_mapping),
    ),
    Dataset("quarantine_web_events", ("bronze_web_events",), _plain(quality.quarantine_web_events)),
    Dataset(
        "reconciliation_orders_payments",
        ("silver_orders", "silver_order_items", "silver_order_payments"),
        _plain(quality.reconciliation_orders_payments),
    ),
    Dataset(
        "referential_integrity_issues",
        INTEGRITY_TABLES,
        _integrity,
        tuple(dict.fromkeys(c.table for c in quality.REFERENCE_CHECKS)),
    ),
)

GOLD: tuple[Dataset, ...] = (
    Dataset("dim_campaign", ("bridge_campaign_mapping",), _plain(dims.dim_campaign)),
    Dataset("dim_channel", ("bridge_campaign_mapping",), _plain(dims.dim_channel)),
    Dataset("dim_customer", ("silver_customers", "silver_orders"), _plain(dims.dim_customer)),
    Dataset("dim_date", ("silver_orders", "silver_web_events", "silver_ads_campaigns"), _plain(dims.dim_date)),
    Dataset("dim_geolocation", ("silver_geolocation",), _plain(dims.dim_geolocation)),
    Dataset("dim_product", ("silver_products_enriched",), _plain(dims.dim_product)),
    Dataset("dim_seller", ("silver_sellers",), _plain(dims.dim_seller)),
    Dataset(
        "fact_orders",
        ("silver_orders", "silver_order_items", "silver_order_payments", "silver_customers", "dim_geolocation"),
        _flat(_fact_orders),
        ("silver_orders", "silver_customers"),
    ),
    Dataset(
        "fact_order_items",
        ("silver_order_items", "silver_orders", "silver_products", "dim_seller", "dim_geolocation"),
        _flat(_fact_order_items),
        ("silver_order_items", "silver_sellers"),
    ),
    Dataset(
        "fact_order_logistics",
        ("silver_orders", "silver_order_items", "silver_customers", "dim_geolocation"),
        _flat(_fact_order_logistics),
        ("silver_orders", "silver_customers"),
    ),
    Dataset(
        "fact_marketing_spend_daily", ("silver_ads_campaigns", "dim_campaign"), _plain(facts.fact_marketing_spend_daily)
    ),
    Dataset(
        "fact_web_funnel_daily",
        ("silver_web_events", "dim_campaign", "dim_channel"),
        _flat(facts.fact_web_funnel_daily),
        ("silver_web_events",),
    ),
    Dataset(
        "mart_sales_marketing_360",
        (
            "fact_marketing_spend_daily",
            "fact_web_funnel_daily",
            "silver_web_events",
            "fact_orders",
            "dim_campaign",
        ),
        _flat(_mart_sales_marketing),
        ("silver_web_events",),
    ),
    Dataset("mart_kpi_daily", ("mart_sales_marketing_360",), _plain(marts.mart_kpi_daily)),
    Dataset(
        "mart_customer_summary",
        ("silver_customers", "fact_orders", "silver_orders", "silver_order_reviews", "dim_geolocation"),
        _flat(marts.mart_customer_summary),
        ("silver_customers",),
    ),
)

DATASETS: dict[str, Dataset] = {d.name: d for d in (*SILVER, *GOLD)}


class Warehouse:
    """Datasets by name. ``bronze`` gives the raw table for a bronze name; everything else is built on demand.

    A saved table replaces its lazy definition, so later datasets read files instead of recomputing. ``shared``
    names tables to save in ``folder`` when they are first asked for, because several datasets read them.
    """

    def __init__(
        self,
        bronze: Callable[[str], DataFrame],
        folder: str = "",
        shared: tuple[str, ...] = (),
        hot_share: float | None = None,
    ) -> None:
        self._bronze = bronze
        self._hot_share = hot_share
        self._folder = folder
        self._shared = shared
        self._tables: dict[str, DataFrame] = {}
        self._saved: set[str] = set()
        self._hot: dict[str, HotKeys] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.build(name) if name in DATASETS else self._bronze(name)
            if name in self._shared:
                self.save(self._folder, name)
        return self._tables[name]

    def build(self, name: str, **options: object) -> DataFrame:
        """``options`` go to the function of a fact or mart, such as ``geo_per_zip`` or ``show_place``."""
        dataset = DATASETS[name]
        return dataset.build(self.hot_keys(dataset.skewed), *[self[i] for i in dataset.inputs], **options)

    def hot_keys(self, names: tuple[str, ...]) -> TableHotKeys:
        """Measured hot keys per table; each table is measured once.

        A table that is not saved yet is measured on its typed raw rows; the latest-row step can but remove rows, so no
        hot key is missed. From CSV-fed tables that reads the key columns only; upserted ones need their latest row.
        """
        todo = {n: (self._keys_of(n), LOOKUP_COLUMNS[n]) for n in names if n not in self._hot}
        if todo:
            self._hot.update(measure_hot_keys(todo, self._hot_share))
        return {n: self._hot[n] for n in names}

    def _keys_of(self, name: str) -> DataFrame:
        if name in self._saved:
            return self[name]
        spec = silver.CLEAN_TABLES[name]
        fields = tuple(f for f in spec.fields if f.name in LOOKUP_COLUMNS[name])
        return tidy(self[spec.source], fields)

    def save(self, warehouse: str, name: str) -> DataFrame:
        self._tables[name] = materialize(self[name], warehouse, name)
        self._saved.add(name)
        return self._tables[name]


def run_silver(tables: Warehouse, out: str) -> None:
    for dataset in SILVER:
        tables.save(f"{out}/silver", dataset.name)


def run_gold(tables: Warehouse, out: str) -> None:
    for dataset in GOLD:
        tables.save(f"{out}/gold", dataset.name)


def run_all(spark: SparkSession, bronze: Callable[[str], DataFrame], out: str) -> Warehouse:
    """Clean tables, then the star schema and marts, each saved once and read back by the ones that need it."""
    tables = Warehouse(bronze)
    run_silver(tables, out)
    run_gold(tables, out)
    return tables
