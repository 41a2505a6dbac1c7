"""Gross, refunded and net orders per day, company and channel, with totals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.columns import Columns, as_day, pick, refund_statuses
from orderlens.functions.dates import day_of
from orderlens.functions.nulls import count_distinct_na, count_rows, is_in, not_in
from orderlens.functions.numbers import share


def in_period(day: Column, start: date | str | None, end: date | str | None) -> Column:
    """Inclusive date filter; an absent bound does not filter, an absent day does not pass."""
    condition = day.isNotNull()
    if start is not None:
        condition = condition & (day >= day_of(start))
    if end is not None:
        condition = condition & (day <= day_of(end))
    return condition


def split_refunds(df: DataFrame, kind: str, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Valid and refunded orders; an order without a status is valid."""
    statuses = refund_statuses(kind)
    return df.filter(not_in(F.col(status), statuses)), df.filter(is_in(F.col(status), statuses))


def buyers(kind: str) -> tuple[Column, Column]:
    """Who counts as user and as applicant: the corporate id where it applies.

    Ids are compared as text, since the three may come in different types.
    """
    refund_statuses(kind)
    com, user, applicant = (
        F.col(name).cast("string") for name in ("com_id", "open_id", "applicant")
    )
    if kind == "self":
        return user, applicant
    if kind == "com":
        return com, com
    return F.coalesce(com, user), F.coalesce(com, applicant)


BUYER_FIELDS = {
    "self": ("open_id", "applicant"),
    "com": ("com_id",),
    "all": ("open_id", "applicant", "com_id"),
}


def _buyer_days(df, cols, kind, start, end, by, total_by, required) -> DataFrame:
    """One row per day, ``by`` and who bought: users and applicants, each in their role.

    Each order row is read once and spread into its dated events. ``orders``,
    ``refunds`` and ``deduct`` stand on rows of users only; refunds without a
    buyer. ``is_first`` marks the first day with orders of each user and
    applicant within ``total_by``.
    """
    with_deduct = kind == "self"
    statuses = refund_statuses(kind)
    fields = dict.fromkeys(
        ["date_created", "date_updated", "status", *BUYER_FIELDS[kind], *by]
        + (["auto_deduct"] if with_deduct else [])
    )
    user, applicant = buyers(kind)
    created, updated = as_day("date_created"), as_day("date_updated")
    refunded = is_in(F.col("status"), statuses)
    deduct = F.when(~refunded, F.col("auto_deduct")).otherwise(0) if with_deduct else F.lit(0)
    nobody = F.lit(None).cast("string")

    def event(day, is_order, role, who, deduct=F.lit(0)) -> Column:
        return F.struct(
            day.alias("date"),
            F.lit(is_order).alias("is_order"),
            F.lit(role).alias("role"),
            who.alias("who"),
            deduct.cast("int").alias("deduct"),
        )

    bought = [event(created, 1, "user", user, deduct)]
    if kind != "com":
        bought.append(event(created, 1, "applicant", applicant))
    returned = [event(updated, 0, "user", nobody)]
    rows = pick(df, cols, *fields).filter(in_period(created, start, end))
    if required:
        rows = rows.dropna(subset=required)
    events = rows.select(
        *by, F.inline(F.when(refunded, F.array(*bought, *returned)).otherwise(F.array(*bought)))
    )
    # Down to one row per buyer and day before anything else; a hot buyer, and all
    # rows without one, collapse on the map side.
    days = events.groupBy(*by, "date", "role", "who").agg(
        F.sum("is_order").cast("long").alias("orders"),
        F.sum(1 - F.col("is_order")).cast("long").alias("refunds"),
        F.sum("deduct").cast("long").alias("deduct"),
    )
    has_orders = F.col("orders") > 0
    own_days = Window.partitionBy(*total_by, "role", "who").orderBy(
        F.when(has_orders, 0).otherwise(1), F.col("date").asc_nulls_last(), *by
    )
    return days.withColumn("is_first", has_orders & (F.row_number().over(own_days) == 1))


def _per_day(days: DataFrame, kind: str, by: list[str]) -> DataFrame:
    """One row per day and ``by`` from :func:`_buyer_days`; no distinct is left to count."""
    of_user, has_orders = F.col("role") == "user", F.col("orders") > 0
    other = "user" if kind == "com" else "applicant"
    of_applicant = F.col("role") == other
    return days.groupBy("date", *by).agg(
        F.count_if(of_user & has_orders).alias("users"),
        F.count_if(of_applicant & has_orders).alias("applicants"),
        F.count_if(of_user & F.col("is_first")).alias("first_users"),
        F.count_if(of_applicant & F.col("is_first")).alias("first_applicants"),
        *[F.sum(F.when(of_user, F.col(name)).otherwise(0)).alias(name) for name in ("orders", "refunds", "deduct")],
    )


def _counted(days: DataFrame, kind: str, by: list[str], total_by: list[str]) -> DataFrame:
    """Daily rows and totals from :func:`_buyer_days`."""
    keys = ["date", *by]
    daily = _per_day(days, kind, by)
    total = F.grouping("date") == 1
    counts = [
        *[F.when(total, F.sum(f"first_{name}")).otherwise(F.sum(name)).alias(name) for name in ("users", "applicants")],
        F.sum("orders").alias("orders"),
        F.sum("refunds").alias("refunds"),
        *([F.sum("deduct").alias("auto_deduct")] if kind == "self" else []),
        F.grouping("date").cast("int").alias("is_total"),
    ]
    # One row per day and key goes in here, not the orders.
    result = daily.groupingSets(
        [[F.col(key) for key in keys], [F.col(key) for key in total_by]],
        *[F.col(key) for key in keys],
    ).agg(*counts)
    measures = ["users", "applicants", "orders", "refunds"]
    net = (F.col("orders") - F.col("refunds")).alias("net_orders")
    return result.select(*keys, "is_total", *measures, net, *(["auto_deduct"] if kind == "self" else []))


def net_orders(
    df: DataFrame,
    cols: Columns = Columns(),
    kind: str = "all",
    start: date | str | None = None,
    end: date | str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Users, applicants, orders, refunds and net orders per day and ``by``.

    Orders count on the day they were created, refunds on the day they were
    updated, so days that hold only refunds appear. Totals (``is_total`` 1)
    count users afresh over all days, as the sum of each user's first day.
    Rows with a NULL in ``by`` are left out. Individual orders also get
    ``auto_deduct``, the valid orders with the deduction agreement.
    """
    by = list(by)
    return _counted(_buyer_days(df, cols, kind, start, end, by, by, by), kind, by, by)


def daily_net(df, cols=Columns(), kind="all", start=None, end=None) -> DataFrame:
    return net_orders(df, cols, kind, start, end)


def daily_company_net(df, cols=Columns(), kind="all", start=None, end=None) -> DataFrame:
    return net_orders(df, cols, kind, start, end, by=["company"])


def daily_channel1_net(df, cols=Columns(), kind="all", start=None, end=None) -> DataFrame:
    return net_orders(df, cols, kind, start, end, by=["company", "channel_1"])


def daily_channel2_net(df, cols=Columns(), kind="all", start=None, end=None) -> DataFrame:
    return net_orders(df, cols, kind, start, end, by=["company", "channel_1", "channel_2"])


def daily_channel3_net(df, cols=Columns(), kind="all", start=None, end=None) -> DataFrame:
    """Per day, company, channel id and the names its orders carry; totals per channel id.

    Users, orders and refunds are counted per day, company and channel id. A
    row stands for each combination of names among that day's orders and
    refunds: it shows the orders if its names are among the orders, and the
    refunds if they are among the refunds. Totals show company and names of
    the channel's first order.
    """
    names, measures = ["channel_1", "channel_2", "channel_3"], ["users", "applicants", "orders", "refunds", "deduct"]
    cells = _channel_cells(df, cols, kind, start, end, names)

    def row(is_total, date, company, named, best, *counts) -> Column:
        return F.struct(
            F.lit(is_total).alias("is_total"),
            date.alias("date"),
            company.alias("company"),
            *[named(n).alias(n) for n in names],
            best.alias("best"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in zip([*measures, "no_user", "no_applicant"], counts)],
        )

    no, yes = F.lit(False), F.col("best")

    def of_path(p) -> Column:
        shown = [F.when(F.array_contains("back" if n == "refunds" else "sold", p), F.col(n)) for n in measures]
        return row(0, F.col("date"), F.col("company"), lambda n: p[n], F.when(no, yes), *shown, F.lit(0), F.lit(0))

    def nothing(name) -> Column:
        return F.when(no, F.col("company") if name == "company" else F.get("sold", F.lit(0))[name])

    total = row(
        1, F.when(no, F.col("date")), nothing("company"), nothing, yes,
        F.col("is_user"), F.col("is_applicant"), *map(F.col, measures[2:]), F.col("no_user"), F.col("no_applicant"),
    )
    keys = ["channel_id", *names, "company", "date", "is_total"]
    sums = [*[F.sum(n).alias(n) for n in measures], *[F.max(n).alias(n) for n in ("no_user", "no_applicant")]]
    shown = cells.select("channel_id", "slot", F.inline(F.concat(F.transform(F.array_union("sold", "back"), of_path), F.array(total))))
    # Totals meet in their slot first, then in their channel, which is left with days and slots of totals.
    slots = shown.groupBy("channel_id", "slot", *keys[1:]).agg(F.min("best").alias("best"), *sums)
    rows = slots.repartition("channel_id").groupBy(*keys).agg(F.min("best").alias("best"), *sums)
    is_total = F.col("is_total") == 1
    places = [F.when(is_total, F.col("best.path")[n]).otherwise(F.col(n)).alias(n) for n in ("company", *names)]
    net = (F.col("orders") - F.col("refunds")).alias("net_orders")
    return rows.filter(~is_total | F.col("best").isNotNull()).select(
        "date", places[0], "channel_id", *places[1:], "is_total",
        *[(F.col(n) + F.col(none)).alias(n) for n, none in (("users", "no_user"), ("applicants", "no_applicant"))],
        "orders", "refunds", net,
        *([F.col("deduct").alias("auto_deduct")] if kind == "self" else []),
    )


#: Places over which the days and the buyers of a channel are spread, so that one with many orders is no single task.
CHANNEL_SLOTS = 32
#: Types whose values are equal where their texts are.
PLAIN_TYPES = ("tinyint", "smallint", "int", "bigint", "string")


def _channel_cells(df, cols, kind, start, end, names: list[str]) -> DataFrame:
    """One row per channel id, company and day, and one per channel id and buyer.

    Each order is dealt once to its day, a refund to its own, and each once to its buyers: narrow rows, one for a buyer who
    is user and applicant. Rows of days have counts, in ``sold`` and ``back`` the combinations of ``names`` of orders and refunds, and
    ``best``, the first order; ``no_user`` and ``no_applicant`` say that some order has none. Rows of buyers say
    whether the buyer is user or applicant of an order.
    """
    statuses, with_deduct = refund_statuses(kind), kind == "self"
    fields = dict.fromkeys(
        ["date_created", "date_updated", "status", "company", "channel_id", "order_item_id", *names, *BUYER_FIELDS[kind]]
        + (["auto_deduct"] if with_deduct else [])
    )
    picked = pick(df, cols, *fields)
    types = dict(picked.dtypes)
    user, applicant = buyers(kind)
    # Ids of one plain type need not become text, which takes more room.
    if len({types[name] for name in BUYER_FIELDS[kind]}) == 1 and types[BUYER_FIELDS[kind][0]] in PLAIN_TYPES:
        com, own, other = (F.col(name) if name in fields else None for name in ("com_id", "open_id", "applicant"))
        user, applicant = (own, other) if kind == "self" else (com, com) if kind == "com" else (F.coalesce(com, own), F.coalesce(com, other))
    created, updated = as_day("date_created"), as_day("date_updated")
    refunded = is_in(F.col("status"), statuses)
    deduct = F.when(~refunded, F.col("auto_deduct")).otherwise(0) if with_deduct else F.lit(0)
    no = F.lit(False)
    # What a row of a day carries, by name; rows of buyers have who and what they are.
    carried = {
        **{n: F.col(n) for n in ("company", *names)},
        "user": user,
        "applicant": applicant,
        "at": F.col("date_created"),
        "id": F.col("order_item_id"),
        "deduct": deduct.cast("int"),
    }
    of_refunds = {"company", *names}

    def event(role, date, who, has) -> Column:
        return F.struct(
            date.alias("date"),
            who.alias("who"),
            F.lit(role).cast("tinyint").alias("role"),
            *[(c if n in has else F.when(no, c)).alias(n) for n, c in carried.items()],
        )

    nobody, never, same = F.when(no, user), F.when(no, created), user.eqNullSafe(applicant)
    events = F.array(
        event(SOLD, created, nobody, carried),
        F.when(refunded, event(BACK, updated, nobody, of_refunds)),
        F.when(user.isNotNull() & same, event(USER + APPLICANT, never, user, ())),
        F.when(user.isNotNull() & ~same, event(USER, never, user, ())),
        F.when(applicant.isNotNull() & ~same, event(APPLICANT, never, applicant, ())),
    )
    rows = picked.filter(in_period(created, start, end) & F.col("channel_id").isNotNull())
    dealt = rows.select("channel_id", F.inline(F.array_compact(events)))
    slot = F.pmod(F.hash("company", "date", "who"), F.lit(CHANNEL_SLOTS)).cast("tinyint")
    dealt = dealt.withColumn("slot", slot).repartition("channel_id", "slot")
    sold, back, role = F.col("role") == SOLD, F.col("role") == BACK, F.col("role")

    def found(condition) -> Column:
        return F.max(F.when(condition, 1).otherwise(0))

    def distinct(name) -> Column:
        return F.size(F.collect_set(F.when(sold, F.struct(name))))

    first = F.struct(F.col("at").alias("date_created"), F.col("id").cast("string").alias("id"))
    path = F.struct(*names)
    return dealt.groupBy("channel_id", "slot", "company", "date", "who").agg(
        distinct("user").alias("users"),
        distinct("applicant").alias("applicants"),
        F.count_if(sold).alias("orders"),
        F.count_if(back).alias("refunds"),
        F.sum(F.when(sold, F.col("deduct"))).alias("deduct"),
        F.collect_set(F.when(sold, path)).alias("sold"),
        F.collect_set(F.when(back, path)).alias("back"),
        F.min(F.when(sold, F.struct(first.alias("first"), F.struct("company", *names).alias("path")))).alias("best"),
        found(role.bitwiseAND(USER) > 0).alias("is_user"),
        found(role.bitwiseAND(APPLICANT) > 0).alias("is_applicant"),
        found(sold & F.col("user").isNull()).alias("no_user"),
        found(sold & F.col("applicant").isNull()).alias("no_applicant"),
    )


#: What a dealt row stands for; the last two may come together.
SOLD, BACK, USER, APPLICANT = 0, 16, 1, 2


def company_rank(df: DataFrame, cols: Columns = Columns(), start=None, end=None) -> DataFrame:
    """Companies by number of orders of the period; ``sort_key`` 1 is the largest."""
    rows = pick(df, cols, "company", *(["date_created"] if (start, end) != (None, None) else []))
    if "date_created" in rows.columns:
        rows = rows.filter(in_period(as_day("date_created"), start, end))
    sizes = rows.filter("company is not null").groupBy("company").agg(count_rows().alias("orders"))
    by_size = Window.orderBy(F.desc("orders"), "company")
    return sizes.withColumn("sort_key", F.row_number().over(by_size))


def _valid_with_user(df, cols, kind, start, end, *fields: str) -> DataFrame:
    needed = dict.fromkeys([*fields, "date_created", "status", *BUYER_FIELDS[kind]])
    rows = pick(df, cols, *needed).filter(in_period(as_day("date_created"), start, end))
    valid, _ = split_refunds(rows, kind)
    return valid.select(*fields, buyers(kind)[0].alias("user"))


def orders_vs_users(
    df: DataFrame, cols: Columns = Columns(), kind: str = "all", start=None, end=None
) -> DataFrame:
    """Distinct valid orders, distinct users and orders per user."""
    totals = _valid_with_user(df, cols, kind, start, end, "order_item_id").agg(
        count_distinct_na(F.col("order_item_id")).cast("long").alias("orders"),
        count_distinct_na(F.col("user")).cast("long").alias("users"),
    )
    return totals.withColumn("orders_per_user", share(F.col("orders"), F.col("users"), 2))


def user_order_histogram(
    df: DataFrame, cols: Columns = Columns(), kind: str = "all", start=None, end=None
) -> DataFrame:
    """How many users hold 1, 2, ... 9 and more than 9 valid orders."""
    valid = _valid_with_user(df, cols, kind, start, end)
    per_user = valid.dropna().groupBy("user").agg(count_rows().alias("n"))
    bucket = F.when(F.col("n") > 9, 10).otherwise(F.col("n")).cast("int")
    return (
        per_user.groupBy(bucket.alias("sort_key"))
        .agg(count_rows().alias("users"))
        .withColumn(
            "orders_per_user",
            F.when(F.col("sort_key") == 10, ">9").otherwise(F.col("sort_key").cast("string")),
        )
    )


def duplicate_orders(df: DataFrame, key: str = "order_item_id") -> DataFrame:
    """All rows whose order id occurs more than once.

    The repeated ids come from a partial aggregation and are joined back, so
    one very frequent id never has to sit in a single window group.
    """
    repeated = df.groupBy(key).agg(count_rows().alias("n")).filter("n > 1").select(key)
    return df.join(repeated, df[key].eqNullSafe(repeated[key]), "left_semi")


def company_daily_stack(company_daily: DataFrame) -> DataFrame:
    """Orders of all companies stacked per day, from :func:`daily_company_net`."""
    return (
        company_daily.filter("is_total = 0")
        .groupBy("date")
        .agg(F.sum("orders").cast("long").alias("stack_height"))
    )
