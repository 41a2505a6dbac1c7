"""Agent productivity: per day, cumulative, at milestones, against the registry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.columns import Columns, as_day, pick, refund_statuses
from orderlens.functions.dates import day_of
from orderlens.functions.nulls import count_rows, is_in, not_in, null_safe
from orderlens.functions.numbers import ratio, share
from orderlens.operators.netting import in_period

UNMATCHED = "Unmatched"

# Channel family whose orders count per level-3 name.
NAMED_CHANNEL_PATTERN = "展[E|e]保"


def agent_registry(channels: DataFrame, company_channels: DataFrame) -> DataFrame:
    """Registered agents of the listed level-1 channels.

    ``channels`` holds channel_id, channel_1..3 and registered; the agents are
    the channels whose level 2 and level 3 names differ.
    """
    return (
        channels.join(company_channels.select("channel_1", "company"), "channel_1")
        .filter(F.col("channel_2") != F.col("channel_3"))
        .withColumn("registered", F.to_date("registered"))
        .distinct()
    )


def check_company_order(df: DataFrame, order: Sequence[str], cols: Columns = Columns()) -> None:
    """Raise when the declared companies and those in the orders differ."""
    names = pick(df, cols, "company").distinct()
    known = F.col("company").isin(*order)
    row = names.agg(
        F.count_if(known).alias("known"), F.count_if(~F.coalesce(known, F.lit(False))).alias("other")
    ).first()
    if row["known"] != len(order) or row["other"]:
        raise ValueError("company order does not match the companies in the orders")


def agent_days(
    df: DataFrame, cols: Columns = Columns(), own_purchases: bool = False
) -> DataFrame:
    """Orders and refunds per company, agent and day: the base of the agent reports.

    Order rows are spread into dated events and summed before anything is
    grouped by agent alone, so a hot agent is down to one row per day. A job
    that runs several agent reports writes this table once and reads it back.
    ``own_purchases`` leaves out orders made by automatic deduction.
    """
    fields = ["company", "channel_id", "date_created", "date_updated", "status"]
    rows = pick(df, cols, *fields, *(["is_auto_deduct"] if own_purchases else []))
    if own_purchases:
        rows = rows.filter(F.coalesce(F.col("is_auto_deduct"), F.lit(0)) == 0)
    refunded = is_in(F.col("status"), refund_statuses("all"))
    bought = F.struct(as_day("date_created").alias("date"), F.lit(1).alias("o"), F.lit(0).alias("r"))
    returned = F.struct(as_day("date_updated").alias("date"), F.lit(0).alias("o"), F.lit(1).alias("r"))
    return (
        rows.filter("company is not null")
        .select(
            "company",
            "channel_id",
            F.inline(F.when(refunded, F.array(bought, returned)).otherwise(F.array(bought))),
        )
        .groupBy("company", "channel_id", "date")
        .agg(F.sum("o").cast("long").alias("orders"), F.sum("r").cast("long").alias("refunds"))
    )


def _company_days(days: DataFrame) -> DataFrame:
    """Per company and day: orders, refunds, agents with orders, agents seen first."""
    per_agent = Window.partitionBy("company", "channel_id")
    sold = F.col("orders") > 0
    first_day = F.min(F.when(sold, F.col("date"))).over(per_agent)
    return (
        days.withColumn("is_first", sold & (F.col("date") == first_day))
        .groupBy("company", "date")
        .agg(
            F.sum("orders").cast("long").alias("orders"),
            F.sum("refunds").cast("long").alias("refunds"),
            F.count_if(sold).alias("agents"),
            F.count_if(F.col("is_first")).alias("new_agents"),
        )
    )


def _running(company_days: DataFrame) -> DataFrame:
    """Add running sums per company; one row per company and day goes in."""
    so_far = (
        Window.partitionBy("company")
        .orderBy(F.col("date").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return company_days.withColumns(
        {
            "cum_orders": F.sum("orders").over(so_far),
            "cum_refunds": F.sum("refunds").over(so_far),
            "cum_agents": F.sum("new_agents").over(so_far),
        }
    )


def agent_orders(
    days: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Daily and cumulative orders, refunds, agents and orders per agent.

    A company has a row on each day of the period on which it sold something.
    Cumulative figures also hold what came before the period, including
    refunds of days without orders. Agents with a NULL id count as one.
    ``days`` comes from :func:`agent_days`, here and below.
    """
    running = _running(_company_days(days))
    shown = (F.col("orders") > 0) & in_period(F.col("date"), start, end)
    return running.filter(shown).select(
        "company",
        "date",
        "orders",
        "refunds",
        "agents",
        share(F.col("orders"), F.col("agents"), 3).alias("avg_orders"),
        "cum_orders",
        "cum_refunds",
        "cum_agents",
        share(F.col("cum_orders"), F.col("cum_agents"), 1).alias("cum_avg_orders"),
    )


def agent_daily(days: DataFrame, start=None, end=None) -> DataFrame:
    return agent_orders(days, start, end).select(
        "company", "date", "orders", "refunds", "agents", "avg_orders"
    )


def agent_cumulative(days: DataFrame, start=None, end=None) -> DataFrame:
    return agent_orders(days, start, end).select(
        "company", "date", "cum_orders", "cum_refunds", "cum_agents", "cum_avg_orders"
    )


def agent_calendar(days: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Every company on every day of the period, with what it sold and what it had sold by then.

    Days without orders carry the cumulative figures of the day before; before a
    company's first order they are 0 and the average is NULL. Without ``start`` or
    ``end`` a company's own first or last day counts. A day's zeros are added as rows of
    their own, so the calendar needs no join: one row per company and day is summed.
    """
    sums = _company_days(days)
    own = sums.filter("date is not null").groupBy("company").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    first = F.col("first") if start is None else day_of(start)
    last = F.col("last") if end is None else day_of(end)
    calendar = own.filter(first <= last).select("company", F.explode(F.sequence(first, last)).alias("date"))
    figures = ("orders", "refunds", "agents", "new_agents")
    empty = calendar.withColumns({**{f: F.lit(0).cast("long") for f in figures}, "shown": F.lit(True)})
    both = sums.withColumn("shown", F.lit(False)).unionByName(empty)
    filled = both.groupBy("company", "date").agg(
        *[F.sum(f).cast("long").alias(f) for f in figures], F.max("shown").alias("shown")
    )
    return _running(filled).filter("shown").select(
        "company",
        "date",
        "orders",
        "refunds",
        "agents",
        "cum_orders",
        "cum_refunds",
        "cum_agents",
        share(F.col("cum_orders"), F.col("cum_agents"), 1).alias("cum_avg_orders"),
    )


def milestones(start: date, end: date, ended: bool) -> list[tuple[str, date]]:
    """Names and cut-off days of the milestone report."""
    # Milestone names and their distance in days from the start or end.
    after_start = (("前3天", 3), ("前5天", 5), ("前10天", 10), ("前20天", 20), ("前30天", 31))
    before_end = (("倒数10天", 10), ("倒数5天", 5))
    points = [(name, start + timedelta(days=n)) for name, n in after_start]
    if ended:
        points += [(name, end - timedelta(days=n)) for name, n in before_end]
    return [*points, ("投保期全长", end)]


def agent_milestones(
    days: DataFrame, start: date, end: date, ended: bool = True, registry: DataFrame | None = None
) -> DataFrame:
    """Cumulative orders, refunds and agents up to each milestone.

    The few milestones meet the daily totals, not the orders; a company
    without orders up to a milestone has no row for it. With a registry come
    the agents registered by then and those below the company's average.
    """
    points = F.array(
        *[
            F.struct(F.lit(name).alias("milestone"), F.lit(day).alias("cutoff"))
            for name, day in milestones(start, end, ended)
        ]
    )
    reached = F.filter(points, lambda point: point["cutoff"] >= F.col("date"))
    report = (
        _company_days(days)
        .select("company", "orders", "refunds", "new_agents", F.inline(reached))
        .groupBy("company", "milestone", "cutoff")
        .agg(
            F.sum("orders").cast("long").alias("cum_orders"),
            F.sum("refunds").cast("long").alias("cum_refunds"),
            F.sum("new_agents").cast("long").alias("cum_agents"),
        )
        .filter("cum_orders > 0")
        .withColumn("cum_avg_orders", share(F.col("cum_orders"), F.col("cum_agents"), 1))
    )
    if registry is None:
        return report
    dates = report.select("company", F.col("cutoff").alias("date"), F.col("cum_avg_orders").alias("need"))
    known = _with_registered(dates.select("company", "date").distinct(), registry).drop("registered")
    found = known.join(_reaching(days, registry, dates), ["company", "date"], "left")
    found = found.select(
        "company",
        F.col("date").alias("cutoff"),
        F.coalesce(F.col("cum_registered"), F.lit(0)).alias("cum_registered"),
        (F.coalesce(F.col("cum_registered"), F.lit(0)) - F.coalesce(F.col("reaching"), F.lit(0))).alias("below_average"),
    )
    return report.join(found, ["company", "cutoff"])


def _with_registered(report: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the agents registered on, and up to, the date of each report row.

    Registrations per day join the report rows as rows of their own, so the
    running sum is a single window over one row per company and day.
    """
    joined = registry.groupBy("company", F.col("registered").alias("date")).agg(
        count_rows().alias("n")
    )
    both = report.withColumns({"n": F.lit(0).cast("long"), "shown": F.lit(True)}).unionByName(
        joined, allowMissingColumns=True
    )
    same_day = Window.partitionBy("company", "date")
    up_to_day = Window.partitionBy("company").orderBy("date")
    return (
        both.withColumns(
            {
                "cum_registered": F.sum("n").over(up_to_day),
                "registered": F.sum("n").over(same_day),
            }
        )
        .filter("shown")
        .drop("n", "shown")
    )


def _places(needs: DataFrame, levels: DataFrame) -> DataFrame:
    """How many of a company's different needs lie at or below each of its needs and levels.

    Both have company and ``value``; the result adds ``is_need`` and ``place``. What goes in is
    distinct, so the window holds a company's different averages and order counts.
    """
    marks = needs.withColumn("is_need", F.lit(1)).unionByName(levels.withColumn("is_need", F.lit(0)))
    # Equal values are peers: a level that meets a need exactly reaches it.
    return marks.withColumn("place", F.sum("is_need").over(Window.partitionBy("company").orderBy("value")))


def _reaching(days: DataFrame, registry: DataFrame, asked: DataFrame) -> DataFrame:
    """How many registered agents reach a number of orders by a date.

    ``asked`` has company, date and ``need``. An agent's orders only grow, so it passes
    each of the company's different needs once: on an order day, or when it is
    registered later. Passings are summed per company, place of the need and day; each
    date asked for is a row in the one place that it needs, and a running sum over a
    place gives its answer. Nothing multiplies order counts with dates.
    """
    per_agent = Window.partitionBy("company", "channel_id").orderBy("date")
    levels = (
        days.filter("orders > 0 and channel_id is not null and date is not null")
        .withColumn("to", F.sum("orders").over(per_agent))
        .withColumn("from", F.col("to") - F.col("orders"))
    )
    since = registry.groupBy("company", "channel_id").agg(F.min("registered").alias("since"))
    moves = levels.join(since, ["company", "channel_id"])
    moves = moves.groupBy("company", F.greatest("date", "since").alias("date"), "from", "to").agg(count_rows().alias("n"))
    asked = asked.filter("need is not null").distinct()
    met = moves.select("company", F.explode(F.array(F.col("from").cast("double"), F.col("to").cast("double"))).alias("value")).distinct()
    places = _places(asked.select("company", F.col("need").alias("value")).distinct(), met)

    def place_of(value: str, name: str, is_need: int) -> DataFrame:
        return places.filter(F.col("is_need") == is_need).select("company", F.col("value").alias(value), F.col("place").alias(name))

    passed = (
        moves.select("company", "date", "n", F.col("from").cast("double").alias("from"), F.col("to").cast("double").alias("to"))
        .join(place_of("from", "above", 0), ["company", "from"])
        .join(place_of("to", "up_to", 0), ["company", "to"])
        .filter("above < up_to")
        .groupBy("company", "date", "above", "up_to")
        .agg(F.sum("n").alias("n"))
        .select("company", "date", "n", F.explode(F.sequence(F.col("above") + 1, F.col("up_to"))).alias("place"))
        .groupBy("company", "place", "date")
        .agg(F.sum("n").alias("n"))
    )
    shown = asked.join(place_of("need", "place", 1), ["company", "need"]).select("company", "place", "date", F.lit(True).alias("shown"))
    up_to_day = Window.partitionBy("company", "place").orderBy("date")
    return (
        passed.unionByName(shown, allowMissingColumns=True)
        .withColumn("reaching", F.coalesce(F.sum("n").over(up_to_day), F.lit(0)))
        .filter("shown")
        .select("company", "date", "reaching")
    )


def agent_registered(
    days: DataFrame,
    registry: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    fixed_average: float | None = None,
) -> DataFrame:
    """The daily report with registered agents and those below the average.

    An agent is below the average of a day unless it was registered by then
    and its orders so far reach the rounded company average of that day (or
    ``fixed_average``).
    """
    report = agent_orders(days, start, end)
    need = F.col("cum_avg_orders") if fixed_average is None else F.lit(float(fixed_average))
    reaching = _reaching(days, registry, report.select("company", "date", need.alias("need")))
    return (
        _with_registered(report, registry)
        .join(reaching, ["company", "date"], "left")
        .select(
            "company",
            "date",
            "orders",
            "refunds",
            "registered",
            "agents",
            "cum_orders",
            "cum_refunds",
            "cum_registered",
            "cum_agents",
            share(F.col("cum_agents"), F.col("cum_registered"), 3).alias("producing_rate"),
            "cum_avg_orders",
            (F.col("cum_registered") - F.coalesce(F.col("reaching"), F.lit(0))).alias("below_average"),
        )
    )


def agents_below_average(
    days: DataFrame,
    registry: DataFrame,
    end: date | str | None = None,
    fixed_average: float | None = None,
) -> DataFrame:
    """Registered agents with fewer orders than the average, zero included.

    The average is all orders of the company over its registered agents,
    rounded to one decimal, unless ``fixed_average`` is given.
    """
    per_agent = (
        days.filter(F.col("orders") > 0)
        .filter(in_period(F.col("date"), None, end))
        .groupBy("company", "channel_id")
        .agg(F.sum("orders").cast("long").alias("orders"))
    )
    agents = registry if end is None else registry.filter(F.col("registered") <= day_of(end))
    if fixed_average is None:
        sizes = per_agent.select("company", "orders", F.lit(0).alias("agents")).unionByName(
            agents.select("company", F.lit(0).cast("long").alias("orders"), F.lit(1).alias("agents"))
        )
        averages = sizes.groupBy("company").agg(
            share(F.sum("orders"), F.sum("agents"), 1).alias("average")
        )
    else:
        averages = registry.select("company").distinct().withColumn(
            "average", F.lit(float(fixed_average))
        )
    return (
        agents.join(per_agent, ["company", "channel_id"], "left")
        .withColumn("orders", F.coalesce(F.col("orders"), F.lit(0)).cast("long"))
        .join(averages, "company")
        .filter(F.col("orders") < F.col("average"))
        .select("company", "channel_1", "channel_2", "channel_3", "channel_id", "orders")
    )


def agent_order_rate(
    df: DataFrame,
    channels: DataFrame,
    company_channels: DataFrame,
    start: date,
    end: date,
    cols: Columns = Columns(),
    own_purchases: bool = False,
) -> DataFrame:
    """Valid orders per channel id and per day on sale, agents without orders included.

    One channel family counts per level-3 name instead of its id. Channels
    outside the company list show company ``Unmatched``.
    """
    days = float((end - start).days)
    fields = ["order_item_id", "status", "channel_1", "channel_2", "channel_3", "channel_id"]
    rows = pick(df, cols, *fields, *(["is_auto_deduct"] if own_purchases else []))
    if own_purchases:
        rows = rows.filter(F.coalesce(F.col("is_auto_deduct"), F.lit(0)) == 0)
    # An unknown level 1 leaves the counted id unknown, too.
    counted_id = F.when(
        F.col("channel_1").rlike(NAMED_CHANNEL_PATTERN), F.col("channel_3")
    ).when(F.col("channel_1").isNotNull(), F.col("channel_id").cast("string"))
    valid = rows.filter(not_in(F.col("status"), refund_statuses("all"))).withColumn(
        "channel_id", counted_id
    )
    names = ["channel_1", "channel_2", "channel_3"]
    # Distinct (id, order) pairs serve both the counts and the names in use.
    per_id = valid.groupBy("channel_id").agg(
        F.count_distinct("order_item_id").alias("n"),
        F.max(F.col("order_item_id").isNull().cast("int")).alias("null_id"),
    ).select("channel_id", (F.col("n") + F.col("null_id")).cast("long").alias("orders"))
    in_use = valid.select("channel_id", *names).distinct()
    companies = company_channels.select("channel_1", "company")
    sold = (
        in_use.join(per_id, null_safe(in_use, per_id, ["channel_id"]))
        .select(*names, "orders")
        .distinct()
        .join(companies, "channel_1", "left")
        .select("company", *names, "orders", ratio(F.col("orders"), F.lit(days)).alias("daily_orders"))
    )
    selling = per_id.select("channel_id")
    idle = (
        channels.filter(F.to_date("registered") <= day_of(end))
        .withColumn("channel_id", F.col("channel_id").cast("string"))
        .join(companies, "channel_1")
    )
    idle = idle.join(selling, null_safe(idle, selling, ["channel_id"]), "left_anti").select(
        "company", *names, F.lit(0).cast("long").alias("orders"), F.lit(0.0).alias("daily_orders")
    )
    return (
        sold.unionByName(idle)
        .distinct()
        .withColumn("company", F.coalesce(F.col("company"), F.lit(UNMATCHED)))
    )


def agent_summary(registered_report: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Latest figures per company from :func:`agent_registered`, and a total row.

    ``idle`` agents are registered without orders; the flags mark the company
    with most agents and the one with the highest average.
    """
    rows = registered_report
    if exclude:
        rows = rows.filter(~F.col("company").isin(*exclude))
    newest = F.max_by(
        F.struct("cum_registered", "cum_agents", "cum_orders", "cum_avg_orders"), "date"
    )
    latest = rows.groupBy("company").agg(newest.alias("last")).select("company", "last.*")
    by_agents = Window.orderBy(F.desc("cum_registered"), F.desc("company"))
    by_average = Window.orderBy(F.desc("cum_avg_orders"), F.desc("company"))
    companies = latest.select(
        "company",
        F.lit(0).alias("is_total"),
        F.col("cum_registered").alias("registered"),
        F.col("cum_agents").alias("agents"),
        (F.col("cum_registered") - F.col("cum_agents")).alias("idle"),
        F.col("cum_orders").alias("orders"),
        F.col("cum_avg_orders").alias("avg_orders"),
        (F.row_number().over(by_agents) == 1).cast("int").alias("most_agents"),
        (F.row_number().over(by_average) == 1).cast("int").alias("best_average"),
    )
    total = companies.agg(
        F.sum("registered").cast("long").alias("registered"),
        F.sum("agents").cast("long").alias("agents"),
        F.sum("idle").cast("long").alias("idle"),
        F.sum("orders").cast("long").alias("orders"),
    ).select(
        F.lit("合计").alias("company"),
        F.lit(1).alias("is_total"),
        "registered",
        "agents",
        "idle",
        "orders",
        share(F.col("orders"), F.col("registered"), 1).alias("avg_orders"),
        F.lit(0).alias("most_agents"),
        F.lit(0).alias("best_average"),
    )
    return companies.unionByName(total)
