"""Data-quality outputs: rejected web events, order/payment reconciliation, broken references."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.cleaning import stamp, tidy
from tidemart.operators.rollups import order_item_totals, order_payment_totals
from tidemart.operators.skew import HotKeys, spread_join
from tidemart.plans.silver import EVENT_TYPES, one_of, web_fields

# Rejection reasons; the first that applies is reported.
WEB_REASONS: tuple[tuple[str, str], ...] = (
    ("missing_event_id", "event_id IS NULL"),
    ("invalid_or_missing_event_time", "event_time IS NULL"),
    ("missing_session_id", "session_id IS NULL"),
    ("invalid_event_type", f"NOT ({one_of('event_type', EVENT_TYPES)})"),
    ("purchase_missing_order_id", "event_type = 'purchase' AND order_id IS NULL"),
    ("invalid_quantity", "quantity <= 0"),
    ("invalid_price_at_event", "price_at_event < 0"),
)
STRICT_REASON = ("missing_event_type", "event_type IS NULL")


def quarantine_web_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Raw web rows the clean table rejects, with the reason; repeated rows are all kept.

    A missing event type passes the ``invalid_event_type`` test (NULL is neither in nor out of the list) while the
    clean table drops the row. ``strict`` reports those rows too.
    """
    reasons = (*WEB_REASONS, STRICT_REASON) if strict else WEB_REASONS
    first = F.coalesce(*[F.when(F.expr(rule), F.lit(name)) for name, rule in reasons])
    rejected = tidy(raw, web_fields(marketing_blank_is_null=False)).withColumn("error_reason", first)
    return stamp(rejected.filter(F.col("error_reason").isNotNull()), "bronze_web_events", at="quarantined_at")


def reconciliation_orders_payments(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid against ordered value per order, with a status."""
    no_items = F.col("item_count") == 0
    no_payments = F.col("payment_record_count") == 0
    money = ("items_price_total", "freight_total", "items_grand_total", "payment_total")
    exact = (
        orders.select("order_id", "order_status", "order_purchase_date")
        .join(order_item_totals(items), "order_id", "left")
        .join(order_payment_totals(payments), "order_id", "left")
        .fillna(0, ["item_count", "payment_record_count", *money])
        .withColumn("difference_amount", F.round(F.col("payment_total") - F.col("items_grand_total"), 2))
    )
    return stamp(
        exact.withColumn(
            "reconciliation_status",
            F.when(no_items & no_payments, "missing_items_and_payments")
            .when(no_items, "missing_items")
            .when(no_payments, "missing_payments")
            .when(F.abs("difference_amount") <= F.lit("0.01").cast("decimal(3,2)"), "matched")
            .otherwise("mismatched"),
        ).withColumns({c: F.col(c).cast("double") for c in (*money, "difference_amount")}),
        "silver_order_items + silver_order_payments",
        at="checked_at",
    )


@dataclass(frozen=True)
class ReferenceCheck:
    """``table.column`` must exist in ``target.target_column``; ``record`` identifies the offending row."""

    name: str
    table: str
    column: str
    target: str
    record: tuple[str, ...]
    optional: bool = False


REFERENCE_CHECKS: tuple[ReferenceCheck, ...] = (
    ReferenceCheck("orders_to_customers", "silver_orders", "customer_id", "silver_customers", ("order_id",)),
    ReferenceCheck(
        "order_items_to_orders", "silver_order_items", "order_id", "silver_orders", ("order_id", "order_item_id")
    ),
    ReferenceCheck(
        "order_items_to_products", "silver_order_items", "product_id", "silver_products", ("order_id", "order_item_id")
    ),
    ReferenceCheck(
        "order_items_to_sellers", "silver_order_items", "seller_id", "silver_sellers", ("order_id", "order_item_id")
    ),
    ReferenceCheck(
        "payments_to_orders",
        "silver_order_payments",
        "order_id",
        "silver_orders",
        ("order_id", "payment_sequential"),
    ),
    ReferenceCheck("reviews_to_orders", "silver_order_reviews", "order_id", "silver_orders", ("review_id",)),
    ReferenceCheck("web_events_to_orders", "silver_web_events", "order_id", "silver_orders", ("event_id",), True),
    ReferenceCheck("web_events_to_products", "silver_web_events", "product_id", "silver_products", ("event_id",), True),
)


def _references(tables: Mapping[str, DataFrame], table: str) -> DataFrame:
    """All references of one table in one pass: a row for each of its rows and checks."""
    checks = [c for c in REFERENCE_CHECKS if c.table == table]
    marks = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.target).alias("target"),
            F.concat_ws("-", *c.record).alias("record_key"),
            F.col(c.column).alias("missing_reference_key"),
            F.lit(f"{c.column}_not_found").alias("issue_type"),
            F.lit(c.optional).alias("optional"),
        )
        for c in checks
    ]
    rows = tables[table].select(F.lit(table).alias("source_table"), F.inline(F.array(*marks)))
    return rows.filter("NOT optional OR missing_reference_key IS NOT NULL").drop("optional")


def referential_integrity_issues(
    tables: Mapping[str, DataFrame], hot: Mapping[str, HotKeys] | None = None
) -> DataFrame:
    """All broken references. ``hot`` maps a table name to its measured hot keys.

    The references of all tables meet the keys of all targets in one join by target and key, so every table is read once as a
    source and once as a target, and every key moves once. The optimizer would take an anti join apart, into one for each
    table with all targets anew; a left join stays whole, and target keys are unique, so it repeats no row.
    """
    references = reduce(DataFrame.unionByName, [_references(tables, t) for t in dict.fromkeys(c.table for c in REFERENCE_CHECKS)])
    targets = dict.fromkeys((c.target, c.column) for c in REFERENCE_CHECKS)
    known = [tables[t].select(F.lit(t).alias("target"), F.col(c).alias("missing_reference_key")) for t, c in targets]
    split: dict[int, int] = {}
    for c in REFERENCE_CHECKS:
        for key, pieces in (hot or {}).get(c.table, {}).get(c.column, {}).items():
            split[key] = max(pieces, split.get(key, 0))
    there = reduce(DataFrame.unionByName, known).withColumn("there", F.lit(True))
    joined = spread_join(references, there, "missing_reference_key", split, ["record_key"], "left", ["target"])
    missing = joined.filter("there IS NULL")
    columns = ("check_name", "source_table", "record_key", "missing_reference_key", "issue_type")
    return missing.select(*columns, F.current_timestamp().alias("detected_at"))
