"""Hot join keys are split at run time when neither side can be broadcast."""

import pytest
from pyspark.sql import functions as F

from orderlens.columns import Columns
from orderlens.functions.lookup import lookup_join
from orderlens.operators import exclusion as X
from orderlens.operators import netting as N
from orderlens.operators import prepare as E
from orderlens.operators import retention as T

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def strict(spark):
    """The session with thresholds so small that the test data counts as large."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark, rows=60_000):
    """A third of the rows has one id, another third none, the rest its own."""
    n = F.col("n")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise(n.cast("string"))
    wide = F.sha2(n.cast("string"), 256)
    base = spark.range(rows).withColumnRenamed("id", "n").repartition(16)
    return base.select(key.alias("order_item_id"), n, wide.alias("text"))


def was_split(df):
    return "isSkewJoin" in df._jdf.queryExecution().executedPlan().toString() or (
        "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    )


def test_duplicates_of_hot_ids(strict):
    df = N.duplicate_orders(skewed(strict))
    assert len(df.select("n", "text").collect()) == 40_000
    full = df
    full.collect()
    assert was_split(full)


def test_lookup_too_large_to_broadcast(strict):
    fact = skewed(strict)
    n = F.col("id")
    key = F.when(n == 0, "hot").otherwise((n * 3 - 1).cast("string"))
    lookup = strict.range(20_001).select(key.alias("order_item_id"), n.alias("m"))
    joined = lookup_join(fact, lookup, "order_item_id", max_rows=10)
    found = joined.collect()
    assert len(found) == 60_000 and sum(row.m is None for row in found) == 20_000
    assert was_split(joined)


def test_refund_and_rebuy_of_people_without_data(strict):
    """A third of the orders lacks all personal data and so is one person."""
    n = F.col("n")
    text = F.when(n % 3 != 0, n.cast("string"))
    nothing = F.lit(None).cast("string")
    orders = skewed(strict).select(
        n.cast("string").alias("order_item_id"),
        F.timestamp_seconds(n + 1_640_995_200).alias("date_created"),
        F.when(n % 7 == 0, "04").otherwise("00").alias("policy_order_status"),
        F.concat(F.lit("c"), (n % 5).cast("string")).alias("company"),
        text.alias("name"), nothing.alias("id_type"), text.alias("id_no"),
        nothing.alias("birthday"), nothing.alias("sex"),
    )
    rows, refunds, pairs = T._lured_pairs(orders, Columns(), "all", "company", [], "created")
    # The refund is order 0 with c0; every later valid order of the others counts.
    expected = sum(i % 3 == 0 and i % 7 != 0 and i % 5 != 0 for i in range(60_000))
    assert len(pairs.collect()) == expected
    assert was_split(pairs)


def test_corporate_items_of_one_large_company(strict):
    """A third of the items belongs to one corporate order."""
    n = F.col("id")
    order_id = F.when(n % 3 == 0, F.lit(0)).otherwise(n)
    items = strict.range(30_000).repartition(16).select(
        n.alias("order_item_id"), order_id.alias("order_id"), F.sha2(n.cast("string"), 256).alias("sku_code")
    )
    per_order = strict.range(30_000).select(n.alias("order_id"), n.alias("a"))
    joined = E.with_order_info(
        items, per_order, per_order.withColumnRenamed("a", "b"), per_order.withColumnRenamed("a", "c")
    )
    assert len(joined.collect()) == 30_000
    assert was_split(joined)


def test_rule_keys(strict):
    signed = skewed(strict).withColumnRenamed("order_item_id", "id_no").withColumn("account", F.col("id_no"))
    rule = X.listed_people(signed.select("id_no"))
    caught = X.caught(signed, rule)
    assert len(caught.collect()) == 60_000
    assert was_split(caught)
