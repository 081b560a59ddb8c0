"""Shapes of the physical plans."""

import re

import pytest

from tidemart.plans.warehouse import DATASETS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_no_python_in_plans(warehouse, name):
    plan = plan_of(warehouse[name])
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct", plan)


def test_latest_row_is_limited_before_the_shuffle(warehouse):
    plan = plan_of(warehouse["silver_order_items"])
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_reference_keys_move_once(spark, warehouse):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse["referential_integrity_issues"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_key = re.findall(r"Exchange hashpartitioning\(missing_reference_key#\d+, target#\d+", plan)
    assert len(by_key) == 2  # all references, all targets


def test_scans_read_only_needed_columns(saved):
    plan = plan_of(saved["silver_order_items"].groupBy("order_id").count())
    assert "ReadSchema: struct<order_id:string>" in plan
    plan = plan_of(saved["fact_orders"].filter("order_status = 'canceled'").select("order_id"))
    assert "EqualTo(order_status,canceled)" in plan


def test_no_broadcast_hints_on_growing_tables(warehouse):
    """Only the table of six fixed campaigns is hinted, and that hint is there to be found."""
    from tidemart.plans import prep
    from tidemart.plans.catalogue import item_base

    def hinted(df) -> list[str]:
        """The leaf below each hint, whatever renames columns in between."""
        lines = df._jdf.queryExecution().analyzed().toString().split("\n")
        found = [i for i, line in enumerate(lines) if "strategy=broadcast" in line]
        return [next(x for x in lines[i + 1 :] if not re.search(r"(Project|SubqueryAlias) ", x)) for i in found]

    for df in [prep.with_campaign(item_base(warehouse)), *(warehouse[name] for name in DATASETS)]:
        assert all("LogicalRDD [campaign_bucket" in child for child in hinted(df))
    assert len(hinted(prep.with_campaign(item_base(warehouse)))) == 1


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_order_logistics"])
def test_facts_are_not_moved_by_place(spark, warehouse, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse.build(name, show_place=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" in plan
    assert not re.search(r"hashpartitioning\([^)]*geolocation_key", plan)


def test_order_columns_move_with_the_items_once(spark, warehouse):
    """The items meet their products before their orders, so that no shuffle by product carries an order."""
    from tidemart.plans.catalogue import item_base

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(item_base(warehouse))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+\], \[\w+#\d+\], (\w+)", plan)
    assert ("product_id", "LeftOuter") in joins
    assert joins.index(("order_id", "Inner")) < joins.index(("product_id", "LeftOuter"))  # an outer node comes first


def test_column_summary_groups_one_value_a_row(spark):
    from tidemart.plans.catalogue import _csv_summary
    from tidemart.schemas import CSV_SOURCES

    def read(name):
        rows = [] if name != "order_items" else [("o1", 1, "p", None, 0.0), ("o1", 1, None, None, -0.0), ("o2", 2, "p", None, float("nan")), ("", 2, "", None, float("nan"))]
        given = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string, seller_id string, price double")
        have = [c.split(" ") for c in CSV_SOURCES[name].split(", ")]
        return given.selectExpr(*[c if c in given.columns else f"CAST(NULL AS {t}) AS {c}" for c, t in have])

    summary = _csv_summary(read)
    widest = max(len(keys.split(",")) for keys in re.findall(r"Exchange hashpartitioning\((.*), \d+\), ENSURE", plan_of(summary)))
    assert widest == 4  # the column and its value in one of three types
    found = {(r["source"], r["column_name"]): (r["row_count"], r["values"], r["distinct_values"]) for r in summary.collect()}
    assert found["order_items", "order_id"] == (4, 4, 3) and found["order_items", "order_item_id"] == (4, 4, 2)
    assert found["order_items", "product_id"] == (4, 3, 2) and found["order_items", "seller_id"] == (4, 0, 0)
    assert found["order_items", "price"] == (4, 4, 2) and found["orders", "order_id"] == (0, 0, 0)
    assert len(found) == sum(len(ddl.split(", ")) for ddl in CSV_SOURCES.values())
