from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators.sampling import hash_sample
from tidemart.operators.skew import _pieces, measure_hot_keys, spread_join


@pytest.fixture(scope="module")
def left(spark):
    """Key 'hot' has a third of the rows, NULL a sixth, the others one row each."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(F.col("id").cast("string"))
    return spark.range(6000).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def right(spark):
    rows = spark.range(0, 6000, 2).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    hot = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, v bigint")
    return rows.union(hot)


@pytest.fixture(scope="module")
def slots(left):
    return measure_hot_keys({"t": (left, ["k", "id"])}, share=1 / 64)["t"]


def test_measure_finds_only_hot_slots(slots):
    assert len(slots["k"]) == 2 and slots["id"] == {}
    assert sorted(slots["k"].values()) == [11, 22]


def test_size_plays_no_part(left):
    few = left.limit(60)
    assert measure_hot_keys({"t": (few, ["k"])}, share=1 / 8)["t"]["k"]


def test_the_bar_follows_the_cluster(spark):
    """A key with a 2000th of the rows is five average partitions of 10,000 and nothing among 8."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id")).alias("k"))
    for partitions, hot in ((8, {}), (1000, {}), (10_000, {spark.sql("SELECT xxhash64(-1L) AS h").first()["h"]: 5})):
        assert measure_hot_keys({"t": (rows, ["k"])}, partitions=partitions)["t"]["k"] == hot
    many = spark.range(100_000).select((F.col("id") % 20).alias("k"))  # 20 keys are hot among 1,000 partitions
    found = measure_hot_keys({"t": (many, ["k"])}, partitions=1000)["t"]["k"]
    assert len(found) == 20 and set(found.values()) == {50}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(left, right, slots, how):
    plain = Counter(tuple(r) for r in left.join(right, "k", how).select("*").collect())
    spread = Counter(tuple(r) for r in spread_join(left, right, "k", slots["k"], ["id"], how).collect())
    assert spread == plain


def test_hot_key_is_split(left, right, slots):
    pieces = F.pmod(F.xxhash64("id"), _pieces(F.col("k"), slots["k"]))
    largest = left.groupBy("k", pieces.alias("p")).count().agg(F.max("count")).first()[0]
    assert largest < 6000 / 32


def test_full_join_is_refused(left, right, slots):
    with pytest.raises(ValueError):
        spread_join(left, right, "k", slots["k"], ["id"], "full")


def test_key_types_must_agree(left, slots):
    for measured in (slots["k"], {}, None):
        with pytest.raises(TypeError):
            spread_join(left, left.select(F.lit(1).alias("k")), "k", measured, ["id"])


def test_facts_are_the_same_with_hot_keys(warehouse):
    """Facts built with every lookup column measured as hot equal the plain ones."""
    from tidemart.plans.warehouse import DATASETS, LOOKUP_COLUMNS

    tables = {n: (warehouse[n], LOOKUP_COLUMNS[n]) for n in LOOKUP_COLUMNS}
    hot = measure_hot_keys(tables, share=1 / 512)
    assert any(s for columns in hot.values() for s in columns.values())
    for name in ("fact_order_items", "fact_web_funnel_daily", "bridge_identity", "silver_products_enriched"):
        d = DATASETS[name]
        salted = d.build({t: hot[t] for t in d.skewed}, *[warehouse[i] for i in d.inputs])
        drop = ("silver_processed_at",)
        expected = Counter(map(tuple, warehouse[name].drop(*drop).collect()))
        assert Counter(map(tuple, salted.drop(*drop).select(*warehouse[name].drop(*drop).columns).collect())) == expected


def test_hash_sample_is_repeatable(spark):
    df = spark.range(10_000)
    one, two = (hash_sample(d, ["id"], 100).collect() for d in (df, df.repartition(7)))
    assert one == two and len(set(one)) == 100
