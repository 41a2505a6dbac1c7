"""Exclusion list: who must be kept out of an automatic deduction, and why."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import compact_date
from orderlens.functions.nulls import count_rows, null_safe

SIGNED_FIELDS = (
    "ad_group", "order_item_id", "pk_main_order", "sub_order_no", "company", "sku_code",
    "sale_channel_id", "customer_id", "open_id", "applicant_name", "applicant_id_type",
    "applicant_id_no", "applicant_tel", "name", "id_type", "id_no", "sex", "birthday", "tel",
)

# Deduction attempts that failed: at the start, or in the callback.
FAILED_STATUSES = ("31", "41")


@dataclass(frozen=True)
class BatchRule:
    """Orders of these companies, skus and creation days form a batch."""

    batch: str
    companies: Sequence[str] = ()
    skus: Sequence[str] = ()
    first_day: str | None = None
    last_day: str | None = None

    def matches(self) -> Column:
        condition = F.lit(True)
        if self.companies:
            condition = condition & F.col("company").isin(*self.companies)
        if self.skus:
            condition = condition & F.col("sku_code").isin(*self.skus)
        day = F.to_date("date_created")
        if self.first_day:
            condition = condition & (day >= F.lit(self.first_day).cast("date"))
        if self.last_day:
            condition = condition & (day <= F.lit(self.last_day).cast("date"))
        return condition


def assign_batches(df: DataFrame, rules: Sequence[BatchRule]) -> DataFrame:
    """Label orders with their batch, first rule wins; others are dropped."""
    batch = F
    for rule in rules:
        batch = batch.when(rule.matches(), rule.batch)
    return df.withColumn("ad_group", batch).filter("ad_group is not null")


def person_id(df: DataFrame) -> DataFrame:
    """Add ``unique_id``; it is NULL as soon as one part is NULL."""
    return df.withColumn(
        "unique_id",
        F.concat(
            F.col("name").cast("string"),
            F.col("id_type").cast("string"),
            F.col("id_no").cast("string"),
        ),
    )


def signed_orders(df: DataFrame, fields: Sequence[str] = SIGNED_FIELDS) -> DataFrame:
    """Orders with the deduction agreement, with the person's id.

    ``account`` is the open id, or the customer id where that is an empty text.
    The rules read this table several times, so a job writes it once first.
    """
    signed = df.filter("automatic_deduction = 1").select(*fields)
    account = F.when(F.col("open_id") == "", F.col("customer_id")).otherwise(F.col("open_id"))
    return person_id(signed).withColumn("account", account)


@dataclass(frozen=True)
class Rule:
    """Signed orders whose columns ``on`` occur in ``keys``; NULL matches NULL.

    Every rule boils down to distinct keys, counted by a partial aggregation
    where counting is needed, so one account or person with very many orders
    is never gathered in a single task.
    """

    keys: DataFrame
    on: tuple[str, ...]


def listed_people(listed: DataFrame) -> Rule:
    """Insured persons on a given list (deceased and others)."""
    return Rule(listed.select("id_no").distinct(), ("id_no",))


def rebought(orders: DataFrame) -> Rule:
    """Insured persons who already have one of ``orders`` this year."""
    return Rule(orders.select("id_no").distinct(), ("id_no",))


def over_limit(signed: DataFrame, limit: int) -> Rule:
    """Accounts with more than ``limit`` orders in a batch."""
    counted = signed.groupBy("ad_group", "account").agg(count_rows().alias("n"))
    return Rule(
        counted.filter(F.col("n") > limit).select("ad_group", "account"), ("ad_group", "account")
    )


def failed_attempts(attempts: DataFrame, tasks: Sequence[str]) -> Rule:
    """Orders whose deduction failed in one of the listed tasks."""
    failed = attempts.filter(
        F.col("auto_deduction_base_config_id").isin(*tasks)
        & F.col("deal_status").isin(*FAILED_STATUSES)
    )
    keys = failed.select(F.col("old_order_item_id").alias("order_item_id")).distinct()
    return Rule(keys, ("order_item_id",))


def _distinct_with_null(column: str) -> Column:
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))


def multiple_ids(signed: DataFrame, key: str, other: str) -> Rule:
    """Values of ``key`` that go with two or more values of ``other`` in a batch.

    Orders without an open id do not take part when open ids are involved.
    """
    rows = signed
    if "open_id" in (key, other):
        rows = rows.filter("open_id is not null and open_id <> ''")
    counted = rows.groupBy("ad_group", key).agg(_distinct_with_null(other).alias("n"))
    return Rule(counted.filter("n >= 2").select(key).distinct(), (key,))


def same_day_accounts(signed: DataFrame) -> Rule:
    """Accounts with orders in two or more batches, matched on the open id as stored."""
    counted = signed.groupBy("account").agg(_distinct_with_null("ad_group").alias("n"))
    keys = counted.filter("n >= 2").select(F.col("account").alias("open_id"))
    return Rule(keys, ("open_id",))


def listed_applicants(listed: DataFrame) -> Rule:
    """Orders whose applicant is on a given list (medical accounts)."""
    keys = listed.select(F.col("id_no").alias("applicant_id_no")).distinct()
    return Rule(keys, ("applicant_id_no",))


def caught(signed: DataFrame, rule: Rule) -> DataFrame:
    """The signed orders a single rule catches."""
    matched = signed.join(rule.keys, null_safe(signed, rule.keys, rule.on), "left_semi")
    return matched.drop("account")


def rule_flags(signed: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Signed orders with one 0/1 flag per rule."""
    flagged = signed
    for name, rule in rules.items():
        marked = rule.keys.select(
            *[F.col(key).alias(f"{name}_{key}") for key in rule.on], F.lit(1).alias(name)
        )
        condition = reduce(
            Column.__and__,
            [F.col(key).eqNullSafe(F.col(f"{name}_{key}")) for key in rule.on],
        )
        flagged = (
            flagged.join(marked, condition, "left")
            .drop(*[f"{name}_{key}" for key in rule.on])
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)))
        )
    return flagged


def exclusion_list(signed: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """All signed orders of every person some rule caught, one 0/1 flag per rule.

    The orders get their row flags in one pass, the flags meet in one
    aggregation per person, and the orders are matched to those persons once.
    """
    any_rule = F.greatest(*rules, F.lit(0)) == 1
    people = (
        rule_flags(signed, rules)
        .filter(any_rule)
        .groupBy("unique_id")
        .agg(*[F.max(name).alias(name) for name in rules])
    )
    listed = signed.join(people, null_safe(signed, people, ["unique_id"]))
    return listed.drop(people["unique_id"]).drop("account")


def exclusion_sheet(excluded: DataFrame) -> DataFrame:
    """The columns handed over to the deduction system."""
    return excluded.select(
        "name", "id_type", "id_no", "sex", compact_date(F.col("birthday")).alias("birthday")
    )


def people_without_key(signed: DataFrame) -> DataFrame:
    """How many signed orders have no person id and so match each other."""
    return signed.agg(F.count_if(F.col("unique_id").isNull()).alias("orders_without_person"))
