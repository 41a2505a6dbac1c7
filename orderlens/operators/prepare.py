"""From raw order tables to the enriched order fact the reports run on.

Joins on lookups come first and joins on the order id last, so the final
whole-row ``distinct`` finds the rows already partitioned by order id.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels as L
from orderlens.functions.dates import bound
from orderlens.functions.lookup import lookup_join
from orderlens.functions.nulls import flag
from orderlens.functions.people import birthday_from_id, sex_from_id

CHANNEL_ID_LENGTH = 16
TEST_WORD = "测试"
NAMES = ("channel_1", "channel_2", "channel_3")

# Statuses of cancelled, paid and refunded orders in the raw tables.
CANCELLED = "02"
SELF_PAID = ("01",)
COM_PAID = ("02",)
COM_UNPAID_TOO = ("00", "01", "02")
SELF_REFUND_DONE = "02"
REMARK_EVENT = "07"


def created_between(
    df: DataFrame,
    start: date | datetime | str | None,
    end: date | datetime | str | None,
    inclusive_end: bool = False,
    column: str = "date_created",
) -> DataFrame:
    """Rows created from ``start`` up to, and normally without, ``end``."""
    kind = df.schema[column].dataType
    if start is not None:
        df = df.filter(F.col(column) >= bound(start, kind))
    if end is not None:
        upper = bound(end, kind)
        df = df.filter(F.col(column) <= upper if inclusive_end else F.col(column) < upper)
    return df


def self_order_items(df: DataFrame, start, end, prices: Sequence[str], skus: Sequence[str]):
    """Paid individual orders of the project, flags as 0/1, status derived."""
    kept = created_between(df, start, end).filter(
        (F.col("order_status") != CANCELLED)
        & F.col("payment_status").isin(*SELF_PAID)
        & F.col("payment_amount").isin(*prices)
        & F.col("sku_code").isin(*skus)
    )
    refunded = F.coalesce(F.col("refund_status") == SELF_REFUND_DONE, F.lit(False))
    return kept.select(
        F.col("id").alias("order_item_id"),
        "date_created",
        "date_updated",
        "sku_code",
        F.substring("sale_channel_id", 1, CHANNEL_ID_LENGTH).alias("sale_channel_id"),
        flag(F.col("automatic_deduction") == 1).alias("automatic_deduction"),
        flag(F.col("automatic_deduction_is_success") == 1).alias("automatic_deduction_is_success"),
        flag(F.col("is_automatic_deduction") == 1).alias("is_automatic_deduction"),
        "customer_id",
        "agent_no",
        "pk_main_order",
        "sub_order_no",
        flag(F.col("medical_insure_flag") == 1).alias("medical_insure_flag"),
        F.col("payment_amount").cast("string").alias("payment_amount"),
        F.col("payway").cast("string").alias("payway_code"),
        F.when(refunded, "04").otherwise("00").alias("policy_order_status"),
        F.lit("self").alias("group"),
    )


def com_order_items(
    df: DataFrame, start, end, prices: Sequence[str], skus: Sequence[str], unpaid: bool = False
):
    """Corporate orders of the project; ``unpaid`` also keeps those not yet paid."""
    kept = created_between(df, start, end).filter(
        (F.col("order_status") != CANCELLED)
        & F.col("payment_status").isin(*(COM_UNPAID_TOO if unpaid else COM_PAID))
        & F.col("amount").isin(*prices)
        & F.col("product_id").isin(*skus)
    )
    return kept.select(
        F.col("id").alias("order_item_id"),
        "date_created",
        "date_updated",
        F.col("product_id").alias("sku_code"),
        F.substring("sale_channel_id", 1, CHANNEL_ID_LENGTH).alias("sale_channel_id"),
        F.col("policy_status").alias("policy_order_status"),
        "payment_status",
        F.col("amount").cast("string").alias("payment_amount"),
        "com_id",
        "order_id",
        F.lit("com").alias("group"),
    )


def _person(prefix: str = "") -> list[Column]:
    return [
        L.map_codes(F.col("id_type"), L.SELF_ID_TYPES).alias(f"{prefix}id_type"),
        F.upper("id_no").alias(f"{prefix}id_no"),
        sex_from_id(F.col("sex"), F.col("id_no")).alias(f"{prefix}sex"),
        birthday_from_id(F.col("birthday"), F.col("id_no")).alias(f"{prefix}birthday"),
    ]


def self_insured(df: DataFrame, start, end) -> DataFrame:
    """Insured persons of individual orders, sex and birthday read from the id."""
    return created_between(df, start, end).select(
        F.col("pk_order_item").alias("order_item_id"),
        "name",
        *_person(),
        "tel",
        L.map_codes(F.col("relation_ship"), L.RELATIONS, L.OTHER).alias("relation_ship"),
    )


def self_applicants(df: DataFrame, start, end) -> DataFrame:
    return created_between(df, start, end).select(
        "pk_main_order",
        "open_id",
        F.col("name").alias("applicant_name"),
        F.col("tel").alias("applicant_tel"),
        *_person("applicant_"),
    )


def self_policies(df: DataFrame, start, end) -> DataFrame:
    return created_between(df, start, end).select(
        F.col("pk_order_item").alias("order_item_id"),
        "policy_company",
        "policy_no",
        "effective_date",
        "expiry_date",
    )


def com_insured(df: DataFrame, start, end) -> DataFrame:
    is_man = F.coalesce(F.col("gender") == "M", F.lit(False))
    return created_between(df, start, end).select(
        "order_item_id",
        "name",
        L.map_codes(F.col("id_type"), L.COM_ID_TYPES).alias("id_type"),
        F.upper("id_no").alias("id_no"),
        F.when(is_man, "男").otherwise("女").alias("sex"),
        F.try_to_date(F.substring("birthday", 1, 10), "yyyy-MM-dd").alias("birthday"),
        "tel",
    )


def com_payments(df: DataFrame, start, end) -> DataFrame:
    """Successful payments only; other attempts would repeat the orders."""
    return created_between(df, start, end).filter(F.col("payment_status").isin(*COM_PAID)).select(
        "order_id",
        F.col("date_updated").alias("date_updated_pay"),
        F.col("pay_way").cast("string").alias("payway_code"),
    )


def com_main_orders(df: DataFrame, start, end) -> DataFrame:
    return created_between(df, start, end, inclusive_end=True).select(
        F.col("id").alias("order_id"), F.col("order_no").alias("main_order_id")
    )


def com_policies(df: DataFrame, start, end) -> DataFrame:
    return created_between(df, start, end, inclusive_end=True).select(
        "order_id",
        F.col("insurance_company_name").alias("policy_company"),
        "policy_no",
        F.col("effect_start_date").alias("effective_date"),
        F.col("effect_end_date").alias("expiry_date"),
    )


def company_profiles(df: DataFrame) -> DataFrame:
    """Corporate customers with the name of their business type."""
    return df.select(
        "com_id",
        "business_name",
        L.map_codes(F.col("business_type").cast("string"), L.BUSINESS_TYPES).alias("business_type"),
        "credit_code",
        F.col("name").alias("business_contact"),
        F.col("phone_num").alias("contact_tel"),
        F.col("mail").alias("contact_mail"),
        F.col("address").alias("business_address"),
    )


def latest_refund_remarks(records: DataFrame) -> DataFrame:
    """Class of the latest refund remark per order."""
    kept = records.filter((F.col("event") == REMARK_EVENT) & ~F.col("remark").contains(TEST_WORD))
    latest = kept.groupBy(F.col("pk_order_item").alias("order_item_id")).agg(
        F.max("date_updated").alias("date_updated"),
        F.max_by("remark", F.struct("date_updated", "remark")).alias("remark"),
    )
    return latest.select(
        "order_item_id",
        "date_updated",
        "remark",
        L.refund_reason(F.col("remark")).alias("refund_remark"),
    )


def channel_levels(raw: DataFrame) -> DataFrame:
    """Level names of each channel from its own name and its ancestors' names."""
    level, path, name = F.col("level"), F.col("ancestor_name"), F.col("channel_name")
    pieces = F.split(name, "#")
    prefixed = F.size(pieces) > 1
    return raw.select(
        F.col("channel_encode").alias("sale_channel_id"),
        F.col("gmt_created").alias("channel_date_created"),
        F.when(level == 3, F.substring_index(path, ",", 1))
        .when(level == 2, path)
        .otherwise(name)
        .alias("channel_1"),
        F.when(level == 3, F.substring_index(path, ",", -1)).otherwise(name).alias("channel_2"),
        F.when(prefixed, pieces[0]).alias("parent_id"),
        F.when(prefixed, pieces[1]).otherwise(name).alias("channel_3"),
    )


def repair_channels(channels: DataFrame) -> DataFrame:
    """Give channels without level 1 or 2 those of their parent, one step up.

    Intact channels match no parent, and a parent id that occurs twice stands for its
    row with the smallest names, so no channel is repeated.
    """
    broken = F.col("parent_id").isNotNull() & (
        F.col("channel_1").isNull() | F.col("channel_2").isNull()
    )
    named = channels.filter("channel_1 is not null or channel_2 is not null")
    parents = named.groupBy(F.col("sale_channel_id").alias("parent")).agg(
        F.min(F.struct(F.col("channel_1").alias("parent_1"), F.col("channel_2").alias("parent_2"))).alias("found")
    )
    parents = parents.select("parent", "found.*")
    wanted = F.when(broken, F.col("parent_id"))
    return channels.join(parents, wanted == F.col("parent"), "left").select(
        "sale_channel_id",
        "channel_date_created",
        F.when(broken, F.col("parent_1")).otherwise(F.col("channel_1")).alias("channel_1"),
        F.when(broken, F.col("parent_2")).otherwise(F.col("channel_2")).alias("channel_2"),
        "channel_3",
    )


def channel_table(raw: DataFrame) -> DataFrame:
    return repair_channels(channel_levels(raw))


def with_channels(orders: DataFrame, channels: DataFrame) -> DataFrame:
    """Add channel names; orders without a channel id match nothing and stay."""
    return lookup_join(orders, channels, "sale_channel_id")


def with_channels_by_prefix(
    orders: DataFrame, channels: DataFrame, lengths: Sequence[int] = (10, 12, 16)
) -> DataFrame:
    """Fill missing channel names from a channel that shares an id prefix.

    Prefixes are tried in order; per prefix the channel with the smallest id
    stands for all, so the join never adds rows. Ids that share a prefix share every shorter one,
    so a length behind a shorter one finds nothing new and is left out: rising lengths take one join. The id of a filled order is
    cut to the prefix that matched. The prefix's hash is a second key, so that
    a join without broadcast gives both sides a shuffle of their own, where the
    many orders with nothing to fill can be split.
    """
    known = channels.filter("channel_1 is not null")
    filled = orders
    for length in [n for i, n in enumerate(lengths) if all(n < m for m in lengths[:i])]:
        lookup = known.groupBy(
            F.substring("sale_channel_id", 1, length).alias("prefix")
        ).agg(F.min_by(F.struct(*NAMES), "sale_channel_id").alias("hit"))
        lookup = lookup.withColumn("prefix_hash", F.xxhash64("prefix"))
        missing = F.col("channel_1").isNull()
        prefix = F.when(missing, F.substring("sale_channel_id", 1, length))
        same = (F.xxhash64(prefix) == F.col("prefix_hash")) & (prefix == F.col("prefix"))
        joined = lookup_join(filled, lookup, same)
        found = F.col("hit").isNotNull()
        filled = joined.withColumns(
            {
                **{name: F.when(found, F.col(f"hit.{name}")).otherwise(F.col(name)) for name in NAMES},
                "sale_channel_id": F.when(found, F.col("prefix")).otherwise(F.col("sale_channel_id")),
            }
        ).drop("prefix", "prefix_hash", "hit")
    return filled


def with_agent_suffix(orders: DataFrame) -> DataFrame:
    """Append the agent number to the level-3 name, where there is one."""
    suffixed = F.concat("channel_3", F.lit("_"), F.coalesce(F.col("agent_no"), F.lit("")))
    return orders.withColumn("channel_3", F.regexp_replace(suffixed, "_$", "")).drop("agent_no")


def with_company(orders: DataFrame, companies: DataFrame, online_skus: Sequence[str] = ()):
    """Add the company of the sku; skus of the online platform override it."""
    joined = lookup_join(orders, companies.select("sku_code", "company"), "sku_code")
    if not online_skus:
        return joined
    online = F.coalesce(F.col("sku_code").isin(*online_skus), F.lit(False))
    return joined.withColumn("company", F.when(online, L.ONLINE_COMPANY).otherwise(F.col("company")))


def with_payway(orders: DataFrame, payways: DataFrame) -> DataFrame:
    return (
        lookup_join(orders, payways.select("payway_code", "payway"), "payway_code")
        .withColumn("payway", F.coalesce(F.col("payway"), F.lit(L.OTHER)))
        .drop("payway_code")
    )


def drop_test_rows(df: DataFrame, column: str = "name") -> DataFrame:
    """Drop test orders; rows without a name go as well."""
    return df.filter(~F.col(column).contains(TEST_WORD))


def enrich_self_orders(
    items: DataFrame,
    insured: DataFrame,
    applicants: DataFrame,
    channels: DataFrame,
    companies: DataFrame,
    payways: DataFrame,
    policies: DataFrame | None = None,
    online_skus: Sequence[str] = (),
    remarks: DataFrame | None = None,
) -> DataFrame:
    """Individual orders with people, policy, payment, channel and company."""
    described = with_agent_suffix(with_channels(with_payway(items, payways), channels))
    described = with_company(described, companies, online_skus)
    orders = described.join(applicants, "pk_main_order", "left")
    orders = drop_test_rows(orders.join(insured, "order_item_id", "left"))
    for extra in (policies, remarks):
        if extra is not None:
            orders = orders.join(extra, "order_item_id", "left")
    return orders.distinct()


def with_order_info(items: DataFrame, *per_order: DataFrame) -> DataFrame:
    """Add tables keyed by corporate order to its items.

    The tables are put together on the distinct orders first, so the items, of which
    one company may hold a large part, are matched once. The id's hash is a second
    key, so that this join has shuffles of its own, where a large order can be split.
    """
    ids = items.select("order_id").distinct()
    info = reduce(lambda left, right: left.join(right, "order_id", "left"), per_order, ids)
    coded = F.xxhash64("order_id")
    joined = items.withColumn("order_hash", coded).join(info.withColumn("order_hash", coded), ["order_hash", "order_id"], "left")
    return joined.drop("order_hash")


def enrich_com_orders(
    items: DataFrame,
    insured: DataFrame,
    payments: DataFrame,
    main_orders: DataFrame,
    policies: DataFrame,
    channels: DataFrame,
    companies: DataFrame,
    payways: DataFrame,
    online_skus: Sequence[str] = (),
) -> DataFrame:
    """Corporate orders with people, payment, policy, channel and company.

    The payment time becomes the creation time; the original one is kept.
    """
    paid = with_payway(with_order_info(items, payments, main_orders, policies), payways)
    described = with_company(with_channels(paid, channels), companies, online_skus)
    return (
        described.join(insured, "order_item_id", "left")
        .withColumnsRenamed(
            {"date_created": "date_created_origin", "date_updated_pay": "date_created"}
        )
        .distinct()
    )


def all_orders(self_orders: DataFrame, com_orders: DataFrame) -> DataFrame:
    """Individual and corporate orders together; absent columns are NULL."""
    both = self_orders.unionByName(com_orders, allowMissingColumns=True)
    return both.withColumn(
        "is_automatic_deduction", F.coalesce(F.col("is_automatic_deduction"), F.lit(0))
    )


def latest_created(df: DataFrame) -> DataFrame:
    """Newest creation time, to see whether the source is up to date."""
    return df.agg(F.max("date_created").alias("latest_created"))


def replace_rows(df: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """``df`` with the rows whose key occurs in ``newer`` replaced by those."""
    kept = df.join(newer.select(key).distinct(), key, "left_anti")
    return reduce(DataFrame.unionByName, [kept, newer])
