"""Caller-side column names and the canonical names the operators work on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Columns:
    """Maps each canonical column to its name in the caller's DataFrame."""

    order_item_id: str = "order_item_id"
    date_created: str = "date_created"
    date_updated: str = "date_updated"
    status: str = "policy_order_status"
    group: str = "group"
    company: str = "company"
    channel_1: str = "channel_1"
    channel_2: str = "channel_2"
    channel_3: str = "channel_3"
    channel_id: str = "sale_channel_id"
    customer_id: str = "customer_id"
    open_id: str = "open_id"
    com_id: str = "com_id"
    applicant: str = "applicant_id_no"
    name: str = "name"
    id_type: str = "id_type"
    id_no: str = "id_no"
    sex: str = "sex"
    birthday: str = "birthday"
    relation: str = "relation_ship"
    auto_deduct: str = "automatic_deduction"
    is_auto_deduct: str = "is_automatic_deduction"
    medical_flag: str = "medical_insure_flag"
    payway: str = "payway"
    price: str = "payment_amount"


def pick(df: DataFrame, cols: Columns, *fields: str) -> DataFrame:
    """Keep only ``fields``, under their canonical names."""
    return df.select(*[F.col(getattr(cols, field)).alias(field) for field in fields])


def as_day(column: str) -> Column:
    return F.to_date(F.col(column))


# Statuses of a refunded order, by kind of order.
REFUND_STATUS = {
    "self": ("04",),
    "com": ("05",),
    "all": ("04", "05"),
}


def refund_statuses(kind: str) -> tuple[str, ...]:
    if kind not in REFUND_STATUS:
        raise ValueError(f"kind must be one of {sorted(REFUND_STATUS)}, got {kind!r}")
    return REFUND_STATUS[kind]
