"""Refund-then-rebuy, renewals and what is left of the deduction agreements."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.columns import Columns, as_day, pick, refund_statuses
from orderlens.functions.labels import ONLINE_COMPANY
from orderlens.functions.nulls import count_rows, is_in, na_text, not_in, null_safe
from orderlens.functions.numbers import share
from orderlens.operators.netting import in_period

MEDICAL_PAYWAY = "医保个账"
PERSON_FIELDS = ("name", "id_type", "id_no", "birthday", "sex")


def person_key(*columns: Column) -> Column:
    """Composite key of a person; absent parts are written as ``NA``."""
    return F.concat_ws("_", *[na_text(column) for column in columns])


def _lured_pairs(df: DataFrame, cols: Columns, kind: str, level: str, labels: list[str], refund_time: str):
    """Orders with a person key, first refunds, and refund-to-order pairs.

    A person contributes one refund, and valid orders are reduced to distinct
    (person, seller, time) first, so pairs stay linear in the orders. The
    person's hash is a second join key: both sides then reach the join through
    a shuffle of its own, where adaptive execution can split a hot person
    (all those without any personal data are one).
    """
    statuses = refund_statuses(kind)
    fields = dict.fromkeys(
        ["order_item_id", "date_created", "status", level, *labels, *PERSON_FIELDS]
        + (["date_updated"] if refund_time == "updated" else [])
    )
    rows = pick(df, cols, *fields).withColumn(
        "person", person_key(*[F.col(field) for field in PERSON_FIELDS])
    )
    refunded_at = "date_updated" if refund_time == "updated" else "date_created"
    picked = F.struct(F.col(refunded_at).alias("at"), *dict.fromkeys([level, *labels]))
    first = F.struct("date_created", "order_item_id", *dict.fromkeys([level, *labels]))
    refunds = (
        rows.filter(is_in(F.col("status"), statuses))
        .groupBy("person")
        .agg(F.min_by(picked, first).alias("refund"))
        .select("person", "refund.*")
    )
    bought = (
        rows.filter(not_in(F.col("status"), statuses))
        .select("person", F.col(level).alias("to"), F.col("date_created").alias("bought"))
        .distinct()
    )
    coded = F.xxhash64("person").alias("person_hash")
    pairs = refunds.select("*", coded).join(
        bought.select("*", coded), ["person_hash", "person"]
    ).filter(
        (F.col("bought") >= F.col("at")) & (F.col(level) != F.col("to"))
    )
    return rows, refunds, pairs


def _gains(rows: DataFrame, pairs: DataFrame, level: str) -> DataFrame:
    """Orders won through lured refunds per seller, and all its orders."""
    lured = pairs.groupBy(F.col("to").alias(level)).agg(count_rows().alias("lured_orders"))
    totals = rows.groupBy(level).agg(count_rows().alias("total_orders"))
    return lured.join(totals, level, "left").withColumn(
        "lured_orders_share", share(F.col("lured_orders"), F.col("total_orders"), 4)
    )


def lured_refunds_company(
    df: DataFrame, cols: Columns = Columns(), kind: str = "all", refund_time: str = "created"
) -> DataFrame:
    """Companies that lost and won orders through refund-and-rebuy.

    A person's first refund is lured by every later valid order (same day
    included) with another company. ``refund_time`` compares against the
    refunded order's creation, or its update.
    """
    rows, refunds, pairs = _lured_pairs(df, cols, kind, "company", [], refund_time)
    figures = ("total_orders", "lured_orders", "total_refunds", "lured_refunds")

    def figure(company: str, name: str) -> Column:
        """One company's count ``n`` as the figure of this name, others 0."""
        return F.struct(
            F.col(company).alias("company"), *[(F.col("n") if f == name else F.lit(0)).cast("long").alias(f) for f in figures]
        )

    # Pairs are counted once per loser and winner; both sides come from that small table.
    moved = pairs.groupBy("company", "to").agg(count_rows().alias("n"))
    sides = moved.select(F.inline(F.array(figure("company", "lured_refunds"), figure("to", "lured_orders"))))
    lost = refunds.groupBy("company").agg(count_rows().alias("n"))
    sold = rows.groupBy("company").agg(count_rows().alias("n"))
    lost = lost.select(figure("company", "total_refunds").alias("f")).select("f.*")
    sold = sold.select(figure("company", "total_orders").alias("f")).select("f.*")
    sums = sides.unionByName(lost).unionByName(sold).groupBy("company").agg(*[F.sum(f).alias(f) for f in figures])
    won, gone = F.col("lured_orders") > 0, F.col("lured_refunds") > 0
    shown = sums.filter((won | gone) & F.col("company").isNotNull()).select(
        "company",
        *[F.when(won, F.col(f)).alias(f) for f in figures[:2]],
        *[F.when(gone, F.col(f)).alias(f) for f in figures[2:]],
    )
    return shown.select(
        "company",
        "total_orders",
        "lured_orders",
        share(F.col("lured_orders"), F.col("total_orders"), 4).alias("lured_orders_share"),
        "total_refunds",
        "lured_refunds",
        share(F.col("lured_refunds"), F.col("total_refunds"), 4).alias("lured_refunds_share"),
    )


def lured_refunds_channel(
    df: DataFrame, cols: Columns = Columns(), kind: str = "all", refund_time: str = "created"
) -> DataFrame:
    """Level-3 channels that both lost and won orders, the online platform aside."""
    labels = ["company", "channel_1", "channel_2"]
    rows, _, pairs = _lured_pairs(df, cols, kind, "channel_3", labels, refund_time)
    losers = pairs.select(*labels, "channel_3").distinct()
    gains = _gains(rows, pairs, "channel_3")
    return (
        losers.filter(F.col("company") != ONLINE_COMPANY)
        .join(gains, "channel_3")
        .select(*labels, "channel_3", "total_orders", "lured_orders", "lured_orders_share")
    )


def member_flag(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """Add ``name`` 1 where ``on`` occurs in ``keys``, else 0; NULL matches NULL."""
    marked = keys.select(F.col(on).alias("member")).distinct().withColumn("found", F.lit(1))
    return (
        df.join(marked, F.col(on).eqNullSafe(F.col("member")), "left")
        .withColumn(name, F.coalesce(F.col("found"), F.lit(0)))
        .drop("member", "found")
    )


#: Bits of a person's state: in which year, and how, the person bought.
OLD_SELF, OLD_COM, NEW_SELF, NEW_COM = 1, 2, 4, 8
YEAR_BITS = {"old": {"self": OLD_SELF, "com": OLD_COM}, "new": {"self": NEW_SELF, "com": NEW_COM}}
Year = tuple[date | str, date | str]


def _valid(kind: str) -> Column:
    return (F.col("group") == kind) & not_in(F.col("status"), refund_statuses(kind))


def person_years(orders: DataFrame, last_year: Year, this_year: Year, cols: Columns = Columns()) -> DataFrame:
    """Per company and person: orders of both years and kinds, and the person's state everywhere.

    The orders are read once. ``old_self`` and ``old_com`` count all orders of last year,
    ``new_self`` and ``new_com`` the valid ones of this year; ``state`` holds the bits of
    all companies' orders of the person, NULL being a person like any other. Orders
    are summed per company and person before the state is spread, so the window sees at
    most one row per company for each person.
    """
    rows = pick(orders, cols, "company", "id_no", "date_created", "group", "status")
    created = as_day("date_created")
    old, new = in_period(created, *last_year), in_period(created, *this_year)
    parts = {
        "old_self": old & (F.col("group") == "self"),
        "old_com": old & (F.col("group") == "com"),
        "new_self": new & _valid("self"),
        "new_com": new & _valid("com"),
    }
    counted = rows.filter(old | new).groupBy("company", "id_no").agg(*[F.count_if(c).alias(n) for n, c in parts.items()])
    bits = [F.when(F.col(f"{y}_{k}") > 0, bit).otherwise(0) for y, kinds in YEAR_BITS.items() for k, bit in kinds.items()]
    state = reduce(lambda x, y: x.bitwiseOR(y), bits)
    return counted.withColumn("state", F.bit_or(state).over(Window.partitionBy("id_no")))


def _renewed(states: DataFrame, year: str, kinds: Sequence[str]) -> DataFrame:
    """Orders of ``year`` per company, and those whose person also bought in the other year, by kind."""
    other = sum(YEAR_BITS["new" if year == "old" else "old"].values())
    again = F.col("state").bitwiseAND(F.lit(other)) != 0
    measures = []
    for kind in kinds:
        n = F.col(f"{year}_{kind}")
        measures += [F.sum(n).cast("long").alias(f"{kind}_orders"), F.sum(F.when(again, n).otherwise(0)).cast("long").alias(f"{kind}_renewed")]
    bought = reduce(lambda x, y: x | y, [F.col(f"{year}_{kind}") > 0 for kind in kinds])
    return states.filter(bought).rollup("company").agg(F.grouping("company").cast("int").alias("is_total"), *measures)


def renewals(states: DataFrame, year: str, kind: str) -> DataFrame:
    """Per company: orders of a year and kind, those whose person bought in the other year, and the rate.

    ``states`` comes from :func:`person_years`; ``year`` is ``old`` (renewed this year) or ``new``
    (bought last year).
    """
    orders, renewed = F.col(f"{kind}_orders"), F.col(f"{kind}_renewed")
    found = _renewed(states, year, [kind])
    return found.select("company", "is_total", orders.alias("orders"), renewed.alias("renewed"), share(renewed, orders, 3).alias("rate"))


def merged_renewals(states: DataFrame, year: str, zeros: bool = True) -> DataFrame:
    """Individual and corporate renewals side by side.

    A company absent from one side gets zeros there, or NULL without ``zeros``.
    """
    found = _renewed(states, year, ["self", "com"])

    def of(kind: str) -> list[Column]:
        orders, renewed = F.col(f"{kind}_orders"), F.col(f"{kind}_renewed")
        shown = [orders, renewed, share(renewed, orders, 3)]
        shown = [F.coalesce(c, F.lit(0)) if zeros else F.when(orders > 0, c) for c in shown]
        return [c.alias(f"{kind}_{name}") for c, name in zip(shown, ("orders", "renewed", "rate"))]

    return found.select("company", "is_total", *of("self"), *of("com"))


def deduction_states(
    orders: DataFrame, last_year: Year, this_year: Year, cols: Columns = Columns(), by_payment: bool = False
) -> DataFrame:
    """The orders that matter to deduction agreements, summed by what they say about a person.

    ``part`` is ``signed`` for last year's individual orders with an agreement, which keep their
    company and payment, and ``own``, ``ad``, ``com`` or ``ad_refund`` for this year's; of valid
    individual ones the order id is kept, since a deducted order is not an own purchase.
    """
    paid = ["medical_flag", "payway"] if by_payment else []
    fields = ["company", "id_no", "date_created", "group", "status", "order_item_id", "auto_deduct", "is_auto_deduct", *paid]
    rows = pick(orders, cols, *fields)
    created = as_day("date_created")
    old, new = in_period(created, *last_year), in_period(created, *this_year)
    own, ad = F.col("group") == "self", F.col("is_auto_deduct") == 1
    # An order of both years, should they overlap, counts in both.
    parts = F.array(
        F.when(old & own & (F.col("auto_deduct") == 1), "signed"),
        F.when(new & _valid("self"), F.when(ad, "ad").otherwise("own")),
        F.when(new & _valid("com"), "com"),
        F.when(new & own & ad & is_in(F.col("status"), refund_statuses("self")), "ad_refund"),
    )
    signed, valid = F.col("part") == "signed", F.col("part").isin("own", "ad")
    spread = rows.select("*", F.explode(F.array_compact(parts)).alias("part"))
    return spread.groupBy(
        "part",
        "id_no",
        F.when(valid, F.col("order_item_id")).alias("order_item_id"),
        *[F.when(signed, F.col(c)).alias(c) for c in ("company", *paid)],
    ).agg(count_rows().alias("n"))


def auto_deduct_remaining(states: DataFrame, by_payment: bool = False) -> DataFrame:
    """Per company: deduction agreements of last year and what became of them.

    Counted in this order: bought again in a corporate order, else in an
    individual one (not by deduction), deducted and kept, and, only where none
    of these holds, deducted and refunded. What is left is the remainder; the
    first and the third overlap, as in the original definition. ``by_payment``
    splits the people left by how they had paid. ``states`` comes from
    :func:`deduction_states`; write it once, it is read several times here.
    """
    paid = ["medical_flag", "payway"] if by_payment else []
    signed = states.filter("part = 'signed'").groupBy("company", "id_no", *paid).agg(F.sum("n").alias("n"))
    ids = states.filter("part = 'ad'").select("order_item_id").distinct()
    bought = states.filter("part = 'own'")
    own = bought.join(ids, null_safe(bought, ids, ["order_item_id"]), "left_anti").withColumn("part", F.lit("self"))
    names = ["com", "self", "ad", "ad_refund"]
    marks = states.filter("part in ('com', 'ad', 'ad_refund')").select("part", "id_no").unionByName(own.select("part", "id_no"))
    flags = marks.groupBy("id_no").agg(*[F.max((F.col("part") == name).cast("int")).alias(name) for name in names])
    joined = signed.join(flags, null_safe(signed, flags, ["id_no"]), "left").drop(flags["id_no"])
    counted = joined.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in names})
    n = F.col("n")
    com, ad = F.col("com") == 1, F.col("ad") == 1
    bought_self = ~com & (F.col("self") == 1)
    untouched = ~com & ~bought_self & ~ad
    refund_only = untouched & (F.col("ad_refund") == 1)
    left = untouched & (F.col("ad_refund") == 0)

    def people(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")

    measures = [
        F.sum("n").cast("long").alias("signed"),
        people(com).alias("bought_com"),
        people(bought_self).alias("bought_self"),
        people(ad).alias("deducted"),
        people(refund_only).alias("deducted_refunded"),
    ]
    if by_payment:
        medical = F.col("medical_flag")
        by_medical = F.col("payway") == MEDICAL_PAYWAY
        measures += [
            people(left & (medical == 0) & ~by_medical).alias("left_own_money"),
            people(left & (medical == 1) & ~by_medical).alias("left_medical_failed"),
            people(left & (medical == 1) & by_medical).alias("left_medical_paid"),
        ]
    result = counted.rollup("company").agg(
        F.grouping("company").cast("int").alias("is_total"), *measures
    )
    done = F.col("bought_com") + F.col("bought_self") + F.col("deducted") + F.col("deducted_refunded")
    return result.withColumn("remaining", F.col("signed") - done).withColumn(
        "remaining_share", share(F.col("remaining"), F.col("signed"), 3)
    )
