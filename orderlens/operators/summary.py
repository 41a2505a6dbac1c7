"""Key figures of the standard report, from the tables of the other operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.numbers import percent_text, share
from orderlens.sources.tables import materialised

# Payment methods paid in cash, and the medical account.
CASH_LABELS = ("微信支付", "支付宝支付", "银联支付")
MEDICAL_LABEL = "医保个账支付"


def kpi_summary(daily: DataFrame, run_days: int) -> DataFrame:
    """Refund rate, averages, first day and best day, from :func:`net_orders`."""
    total = F.col("is_total") == 1
    day = ~total
    net = F.col("net_orders")
    first = F.when(day, F.col("date"))
    best = F.when(day, F.struct(net, -F.unix_date("date")))
    figures = daily.agg(
        *[
            F.max(F.when(total, F.col(name))).alias(name)
            for name in ("applicants", "orders", "refunds", "net_orders")
        ],
        F.min(first).alias("first_day"),
        F.min_by(net, first).alias("first_day_net"),
        F.max_by(F.col("date"), best).alias("best_day"),
        F.max(F.when(day, net)).alias("best_day_net"),
    )
    return figures.select(
        "orders",
        "refunds",
        "net_orders",
        "applicants",
        share(F.col("refunds"), F.col("orders"), 2).alias("refund_rate"),
        share(net, F.lit(run_days), 1).alias("orders_per_day"),
        share(net, F.col("applicants"), 1).alias("orders_per_applicant"),
        "first_day",
        "first_day_net",
        "best_day",
        "best_day_net",
    )


def payment_summary(methods: DataFrame) -> DataFrame:
    """Orders paid in cash, by medical account and otherwise."""
    people = F.col("people")

    def paid(condition):
        return F.coalesce(F.sum(F.when(condition, people)), F.lit(0)).cast("long")

    label = F.col("label")
    sums = methods.agg(
        F.sum("people").cast("long").alias("everyone"),
        paid(label.isin(*CASH_LABELS)).alias("cash"),
        paid(label == MEDICAL_LABEL).alias("medical"),
    )
    return sums.select(
        "cash", "medical", (F.col("everyone") - F.col("cash") - F.col("medical")).alias("other")
    )


def age_sex_long(bands: DataFrame) -> DataFrame:
    """Men and women per age band as rows, for a chart."""
    rows = bands.filter("is_total = 0")
    return rows.unpivot(["band_start", "age_band"], ["men", "women"], "sex_group", "people")


def agent_long(report: DataFrame) -> DataFrame:
    """Producing agents and orders per agent as rows, for a chart with two axes."""
    figures = report.withColumn("cum_agents", F.col("cum_agents").cast("double"))
    return figures.unpivot(
        ["company", "date"], ["cum_agents", "cum_avg_orders"], "measure", "value"
    )


def agents_long(summary: DataFrame) -> DataFrame:
    """Producing and idle agents per company as rows."""
    rows = summary.filter("is_total = 0")
    return rows.unpivot(["company"], ["agents", "idle"], "state", "people")


def show_percent(df: DataFrame, words: tuple[str, ...] = ("share", "rate")) -> DataFrame:
    """Write columns whose name holds one of ``words`` as percent text."""
    return df.withColumns(
        {
            name: percent_text(F.col(name))
            for name in df.columns
            if any(word in name for word in words)
        }
    )


def show_totals(df: DataFrame, text: str, column: str = "date") -> DataFrame:
    """Write ``column`` as text, with ``text`` on total rows."""
    label = F.when(F.col("is_total") == 1, text).otherwise(F.col(column).cast("string"))
    return df.withColumn(column, label)


def numbered(df: DataFrame, *keys: Column) -> DataFrame:
    """Rows with their place ``row_no``, from 1, in the order of the keys and then of all columns.

    The order is kept where files are read in any order. Rows are dealt to tasks by ranges and
    numbered inside them; ranges start behind the rows of those before, so no task sees all rows.
    """
    order = [*keys, *[F.col(name).asc_nulls_first() for name in df.columns]]
    place = F.monotonically_increasing_id().alias("at")
    ranged = materialised(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", place))
    # An id has its task in the upper bits and counts within it in the lower 33.
    ranged = ranged.withColumns({"task": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    sizes = ranged.groupBy("task").agg(F.count("*").alias("rows"))
    starts = sizes.select("task", (F.sum("rows").over(Window.orderBy("task")) - F.col("rows")).alias("start"))
    # One row per task of the sort.
    placed = ranged.join(F.broadcast(starts), "task")
    return placed.select(*df.columns, (F.col("start") + F.col("at") + 1).alias("row_no"))


def numbered_report(df: DataFrame, ranks: DataFrame, *then: str) -> DataFrame:
    """A report with ``row_no``, in the order of :func:`sorted_report`."""
    ranked = df.join(ranks.select("company", "sort_key"), "company", "left")
    keys = [F.col("sort_key").asc_nulls_last(), *[F.col(name).asc_nulls_first() for name in then], F.asc("is_total")]
    return numbered(ranked, *keys, F.col("date").asc_nulls_last()).drop("sort_key")


def sorted_report(df: DataFrame, ranks: DataFrame | None, *then: str) -> DataFrame:
    """Order a report by company rank, further keys, and totals after their days."""
    if ranks is None:
        return df.orderBy(*then, "is_total", F.col("date").asc_nulls_last())
    order = ranks.select("company", "sort_key")
    return (
        df.join(order, "company", "left")
        .orderBy(F.col("sort_key").asc_nulls_last(), *then, "is_total", F.col("date").asc_nulls_last())
        .drop("sort_key")
    )
