"""Net orders per region and day, week or month, with premiums and shares."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.columns import Columns, as_day, pick, refund_statuses
from orderlens.functions.dates import day_of, month_label, week_start
from orderlens.functions.labels import OTHER
from orderlens.functions.lookup import lookup_join
from orderlens.functions.nulls import count_rows, is_in
from orderlens.functions.numbers import share
from orderlens.operators.demography import sold_between, top_with_ties
from orderlens.operators.netting import in_period

REST = "其他地区"
CITY = "市区"


def region_codes(regions: DataFrame, region: str = "region", codes: str = "codes") -> DataFrame:
    """One row per region and code, from a list such as ``"4401, 4402"``."""
    return regions.select(
        F.col(region).alias("region"), F.explode(F.split(F.col(codes), ", ")).alias("code")
    )


def with_region(df: DataFrame, codes: DataFrame, id_no: Column, prefix_len: int) -> DataFrame:
    """Add the region of the id's prefix; ids outside the list get ``其他``.

    A code listed under two regions puts the order into both.
    """
    coded = df.withColumn("code", F.substring(id_no, 1, prefix_len))
    return lookup_join(coded, codes, "code").withColumn(
        "region", F.coalesce(F.col("region"), F.lit(OTHER))
    )


def check_group_order(df: DataFrame, column: str, order: Sequence[str]) -> None:
    """Raise when the declared order does not list as many groups as the data has."""
    found = df.agg(
        F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))
    ).first()[0]
    if len(set(order)) != found:
        raise ValueError(f"group order lists {len(set(order))} groups, the data has {found}")


def _net_by_region(
    df: DataFrame,
    codes: DataFrame,
    cols: Columns,
    period,
    prefix_len: int,
    extra: Sequence[str],
    start,
    end,
    since,
) -> DataFrame:
    """Distinct orders and refunds per region, ``period`` and ``extra``.

    Every row becomes its one or two dated events, and the side of the event
    is a grouping key, so one distinct count serves both sides.
    """
    needed = dict.fromkeys(
        ["order_item_id", "date_created", "date_updated", "status", "id_no", *extra]
    )
    created = as_day("date_created")
    rows = pick(df, cols, *needed).filter(in_period(created, start, end))
    if since is not None:
        rows = rows.filter(created >= day_of(since))
    refunded = is_in(F.col("status"), refund_statuses("all"))
    order_event = F.struct(F.lit(0).alias("is_refund"), created.alias("day"))
    refund_event = F.struct(F.lit(1).alias("is_refund"), as_day("date_updated").alias("day"))
    events = with_region(rows, codes, F.col("id_no"), prefix_len).select(
        "region",
        "order_item_id",
        *extra,
        F.explode(
            F.when(refunded, F.array(order_event, refund_event)).otherwise(F.array(order_event))
        ).alias("event"),
    )
    keys = ["region", "period", *extra]
    counted = (
        events.withColumn("period", period(F.col("event.day")))
        .groupBy(*keys, F.col("event.is_refund").alias("is_refund"))
        .agg(
            (
                F.count_distinct("order_item_id")
                + F.max(F.col("order_item_id").isNull().cast("int"))
            ).alias("n")
        )
    )
    refunds = F.sum(F.when(F.col("is_refund") == 1, F.col("n")).otherwise(0))
    orders = F.sum(F.when(F.col("is_refund") == 0, F.col("n")).otherwise(0))
    return (
        counted.groupBy(*keys)
        .agg(orders.cast("long").alias("orders"), refunds.cast("long").alias("refunds"))
        .withColumn("net_orders", F.col("orders") - F.col("refunds"))
    )


def region_net_daily(
    df: DataFrame,
    codes: DataFrame,
    cols: Columns = Columns(),
    prefix_len: int = 2,
    group: str | None = None,
    price: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    since: date | str | None = None,
) -> DataFrame:
    """Orders, refunds and net orders per region and day, and per ``group``.

    With ``price`` (cents) the premium is added: net orders are taken per
    price, multiplied and summed. ``since`` keeps orders created from that day.
    """
    keys = [group] if group else []
    extra = [*keys, *([price] if price else [])]
    daily = _net_by_region(
        df, codes, cols, lambda day: day, prefix_len, extra, start, end, since
    ).withColumnRenamed("period", "date")
    if price:
        cents = F.col("net_orders") * F.col(price).cast("long")
        daily = daily.groupBy("region", "date", *keys).agg(
            F.sum("orders").cast("long").alias("orders"),
            F.sum("refunds").cast("long").alias("refunds"),
            F.sum("net_orders").cast("long").alias("net_orders"),
            (F.sum(cents) / 100).cast("decimal(18,2)").alias("premium"),
        )
    return daily


def region_premium(daily: DataFrame, group: str | None = None) -> DataFrame:
    """Net orders and premium of the whole period per region and group.

    Rows with ``is_total`` 1 hold all groups together.
    """
    measures = [F.sum("net_orders").cast("long").alias("net_orders")]
    if "premium" in daily.columns:
        measures.append(F.sum("premium").cast("decimal(18,2)").alias("premium"))
    if group is None:
        return daily.groupBy("region").agg(*measures)
    return daily.groupingSets(
        [[F.col("region"), F.col(group)], [F.col("region")]], F.col("region"), F.col(group)
    ).agg(F.grouping(group).cast("int").alias("is_total"), *measures)


PERIODS = {
    "day": lambda day: day,
    "week": week_start,
    "month": month_label,
}


def region_share(
    df: DataFrame,
    codes: DataFrame,
    cols: Columns = Columns(),
    grain: str = "day",
    prefix_len: int = 2,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Net orders per region and period, and the share of that period's net.

    Rows with ``is_total`` 1 hold the region's net over all periods and its
    share of everything. Weeks are 7-day blocks from 1 January, numbered from
    the first one in the data.
    """
    if grain not in PERIODS:
        raise ValueError(f"grain must be one of {sorted(PERIODS)}, got {grain!r}")
    net = _net_by_region(df, codes, cols, PERIODS[grain], prefix_len, [], start, end, None)
    if grain == "week":
        # One row per region and week here, far fewer than the orders.
        by_time = Window.orderBy(F.col("period").asc_nulls_last())
        net = net.withColumn("period", F.dense_rank().over(by_time))
    counted = net.groupingSets(
        [[F.col("region"), F.col("period")], [F.col("region")]], F.col("region"), F.col("period")
    ).agg(
        F.grouping("period").cast("int").alias("is_total"),
        F.sum("net_orders").cast("long").alias("net_orders"),
    )
    of_period = Window.partitionBy("is_total", "period")
    return counted.withColumn(
        "share", share(F.col("net_orders"), F.sum("net_orders").over(of_period), 3)
    )


#: Columns that a wide table has for its periods at most.
MOST_PERIODS = 10_000


def found_periods(
    long: DataFrame, column: str = "period", group: str | None = None, most: int = MOST_PERIODS
) -> list[tuple[str | None, str]]:
    """(group, period) of all rows with a period, as texts, newest first; group is None without one.

    One small aggregation of ``long``; with more than ``most`` of them it raises
    instead of leaving any out.
    """
    kind = F.col(group).cast("string") if group else F.lit(None).cast("string")
    pairs = long.filter(F.col(column).isNotNull()).groupBy(kind.alias("kind"), F.col(column).alias("period")).agg(F.lit(1))
    found = pairs.orderBy(F.desc("period")).select("kind", F.col("period").cast("string").alias("period")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} periods for columns; take a coarser period or a shorter time")
    return [(row["kind"], row["period"]) for row in found]


def region_wide(
    long: DataFrame,
    periods: Sequence | None = None,
    column: str = "period",
    group: str | None = None,
    groups: Sequence[str] = (),
    shares: bool = False,
    most: int = MOST_PERIODS,
) -> DataFrame:
    """One row per region: total net orders, then one column per period, newest first.

    With ``group`` come the net orders of each of ``groups``, in that order, and
    their periods as ``<group>_<period>``; the premium is totalled if there is
    one. ``shares`` adds ``share_<period>`` behind each period. Periods without orders show 0.

    Without ``periods`` the columns are those found in ``long`` (see :func:`found_periods`; each
    group has its own), which is then read twice and should be a written table. The total
    holds all rows, also those without a period and those of periods the caller did not name.
    """
    if periods is None:
        found = found_periods(long, column, group, most)
    else:
        newest = [str(period) for period in sorted(periods, reverse=True)]
        found = [(name, period) for name in (groups if group else [None]) for period in newest]
    measures = [F.sum("net_orders").cast("long").alias("net_orders")]
    if "premium" in long.columns:
        measures.append(F.sum("premium").cast("decimal(18,2)").alias("premium"))
    of_group = [F.sum(F.when(F.col(group) == name, F.col("net_orders"))) for name in groups]
    measures += [
        F.coalesce(total, F.lit(0)).cast("long").alias(f"{name}_total") for name, total in zip(groups, of_group)
    ]
    period = F.col(column).cast("string")
    place = period if group is None else F.concat(F.col(group), F.lit("_"), period)
    names = [p for _, p in found] if group is None else [f"{name}_{p}" for name in groups for kind, p in found if kind == name]
    values = [F.sum("net_orders").alias("net")] + ([F.max("share").alias("share")] if shares else [])
    # A pivot holds one array per region, whatever the number of columns.
    placed = long.select(F.col("region").alias("of_region"), place.alias("place"), "net_orders", *(["share"] if shares else []))
    wide = placed.groupBy("of_region").pivot("place", names).agg(*values)

    def shown(name: str) -> list[Column]:
        net = F.coalesce(F.col(f"`{name}_net`" if shares else f"`{name}`"), F.lit(0)).cast("long").alias(name)
        part = [F.coalesce(F.col(f"`{name}_share`"), F.lit(0.0)).alias(f"share_{name}")] if shares else []
        return [net, *part]

    totals = long.groupBy("region").agg(*measures)
    joined = totals.join(wide, F.col("region").eqNullSafe(F.col("of_region")))
    return joined.select(*totals.columns, *[c for name in names for c in shown(name)])


def region_counts(
    df: DataFrame,
    codes: DataFrame,
    cols: Columns = Columns(),
    prefix_len: int = 6,
    top: int | None = None,
    **scope,
) -> DataFrame:
    """Valid orders per region, the rest as ``其他地区``, and shares.

    ``top`` keeps the largest regions (with ties) and leaves out the rest row.
    ``scope`` is start, end and drop_refunds of :func:`sold_between`.
    """
    per_code = (
        sold_between(df, cols, ["id_no"], **scope)
        .groupBy(F.substring("id_no", 1, prefix_len).alias("code"))
        .agg(count_rows().alias("n"))
    )
    regions = codes.groupBy("code").agg(F.collect_list("region").alias("regions"))
    nowhere = F.array(F.lit(None).cast("string"))
    # Each code counts for its regions, and once more without one: the sum of all.
    spread = lookup_join(per_code, regions, "code").select(
        "n", F.explode(F.concat(F.coalesce("regions", F.slice(nowhere, 1, 0)), nowhere)).alias("region")
    )
    found = spread.unionByName(codes.select("region", F.lit(0).cast("long").alias("n")))
    sums = found.groupBy("region").agg(F.sum("n").alias("n"))
    # One row per region from here on.
    placed = F.sum(F.when(F.col("region").isNotNull(), F.col("n")).otherwise(0)).over(Window.partitionBy())
    both = sums.select(
        F.coalesce("region", F.lit(REST)).alias("region"),
        F.when(F.col("region").isNull(), F.col("n") - placed).otherwise(F.col("n")).alias("people"),
    )
    total = F.sum("people").over(Window.partitionBy())
    result = both.select(
        "region",
        F.col("people").cast("long").alias("people"),
        share(F.col("people"), total, 3).alias("share"),
    )
    return result if top is None else top_with_ties(result.filter(F.col("region") != REST), "people", top)


def region_counts_by_name(
    df: DataFrame,
    names: Sequence[str],
    cols: Columns = Columns(),
    columns: Sequence[str] = ("channel_1",),
    **scope,
) -> DataFrame:
    """Valid orders whose channel names contain a region's name, first name wins.

    Once an order id is placed in a region its other rows are not counted
    again; what no name matches goes to ``市区``.
    """
    rows = sold_between(df, cols, ["order_item_id", *columns], **scope)
    place = F
    for i, name in enumerate(names):
        found = F.lit(False)
        for column in columns:
            found = found | F.coalesce(F.col(column).contains(name), F.lit(False))
        place = place.when(found, i)
    placed = rows.groupBy("order_item_id", place.otherwise(len(names)).alias("place")).agg(
        count_rows().alias("n")
    )
    first = placed.groupBy("order_item_id").agg(F.min(F.struct("place", "n")).alias("hit"))
    counts = first.groupBy(F.col("hit.place").alias("place")).agg(F.sum("hit.n").alias("n"))
    template = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(name) for name in [*names, CITY]])).alias("place", "region")
    )
    size = placed.agg(F.sum("n").alias("everyone"))
    shown = template.join(counts, "place", "left").select(
        "region", F.coalesce(F.col("n"), F.lit(0)).alias("people"), F.lit(0).alias("everyone")
    )
    total = size.select(F.lit(None).cast("string").alias("region"), F.lit(0).alias("people"), "everyone")
    everyone = F.max("everyone").over(Window.partitionBy())
    return (
        shown.unionByName(total)
        .select("region", F.col("people").cast("long").alias("people"), everyone.alias("everyone"))
        .filter("region is not null")
        .select("region", "people", share(F.col("people"), F.col("everyone"), 3).alias("share"))
    )


def region_counts_checked(
    df: DataFrame,
    cols: Columns = Columns(),
    codes: DataFrame | None = None,
    names: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Regions by id prefix (``codes``) or by channel name (``names``), not both."""
    if (codes is None) == (names is None):
        raise ValueError("give either region codes or region names")
    if codes is not None:
        return region_counts(df, codes, cols, **options)
    return region_counts_by_name(df, names, cols, **options)


def top_regions(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` regions with most people, the rest row aside."""
    return (
        counts.filter(F.col("region") != REST)
        .filter("people <> 0")
        .orderBy(F.desc("people"), "region")
        .limit(n)
    )
