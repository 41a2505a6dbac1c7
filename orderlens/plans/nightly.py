"""The nightly job of one project: enrich the orders once, then run every report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.columns import Columns
from orderlens.functions.labels import ONLINE_COMPANY
from orderlens.functions.nulls import not_in
from orderlens.operators import agents as A
from orderlens.operators import demography as P
from orderlens.operators import netting as N
from orderlens.operators import prepare as E
from orderlens.operators import regions as R
from orderlens.operators import retention as T
from orderlens.operators import summary as S
from orderlens.sources.tables import publish, remove_folder, run_folder, snapshot, write_reports


# Row order of the written reports; a minus sign means largest first.
ROW_ORDER = {
    "lured_refunds_company": ("-total_orders",),
    "lured_refunds_channel": ("company", "channel_1", "channel_2", "-total_orders"),
    "fact_sheet": ("sort_key",),
    "star_signs": ("-people",),
    "zodiac": ("-people",),
    "regions": ("-people",),
    "surnames": ("-people",),
    "hours": ("hour",),
    "agent_registered": ("company", "date"),
    "agent_milestones": ("company", "cutoff"),
    "agents_below_average": ("company", "-orders"),
}


#: Reports of which each company gets its own list.
COMPANY_LISTS = ("agents_below_average",)


def row_order(name: str, report: DataFrame) -> list[Column]:
    """The keys that a report is sorted by where it is shown; none if it has no order."""
    keys = [
        F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in ROW_ORDER.get(name, ())
    ]
    if name.startswith("age_sex"):
        by = ["company"] if "company" in report.columns else []
        keys = [*map(F.asc, by), F.asc("is_total"), F.asc_nulls_last("band_start")]
    return keys


def in_row_order(name: str, report: DataFrame) -> DataFrame:
    """The report sorted as it is shown; reports without an order stay as they are."""
    keys = row_order(name, report)
    return report.orderBy(*keys) if keys else report


def with_row_order(name: str, report: DataFrame) -> DataFrame:
    """The report with the places of its rows as ``row_no``, if it has an order."""
    keys = row_order(name, report)
    return S.numbered(report, *keys) if keys else report


#: Creation time of a corporate order; its creation column holds the payment time.
ORDER_TIME = "date_created_origin"


@dataclass(frozen=True)
class Project:
    """One city's project: its period, prices, skus and report switches."""

    city: str
    year: str
    start: datetime
    end: datetime
    prices: Sequence[str]
    self_skus: Sequence[str]
    com_skus: Sequence[str] = ()
    online_skus: Sequence[str] = ()
    ended: bool = False
    with_relation: bool = False
    unpaid_com: bool = False
    online_pattern: str = ONLINE_COMPANY
    top: int | None = None
    id_prefix: int = 6
    columns: Columns = field(default_factory=Columns)

    @property
    def first_day(self) -> date:
        return self.start.date()

    @property
    def last_day(self) -> date:
        return self.end.date()

    @property
    def days(self) -> int:
        return (self.last_day - self.first_day).days


def enrich(project: Project, raw: Mapping[str, DataFrame], lookups: Mapping[str, DataFrame]) -> DataFrame:
    """All orders of the project from the raw tables, individual and corporate."""
    start, end = project.start, project.end
    channels = E.channel_table(raw["sales_channel"])
    self_orders = E.enrich_self_orders(
        E.self_order_items(raw["order_item"], start, end, project.prices, project.self_skus),
        E.self_insured(raw["order_service_obj"], start, end),
        E.self_applicants(raw["order_insurance_applicant"], start, end),
        channels,
        lookups["self_companies"],
        lookups["self_payways"],
        E.self_policies(raw["policy_order"], start, end) if "policy_order" in raw else None,
        project.online_skus,
    )
    if not project.com_skus:
        return self_orders.withColumn("com_id", F.lit(None).cast("string"))
    com_orders = E.enrich_com_orders(
        E.com_order_items(
            raw["com_order_item"], start, end, project.prices, project.com_skus, project.unpaid_com
        ),
        E.com_insured(raw["com_order_item_info"], start, end),
        E.com_payments(raw["com_order_payment"], start, end),
        E.com_main_orders(raw["com_order"], start, end),
        E.com_policies(raw["com_order_policy"], start, end),
        channels,
        lookups["com_companies"],
        lookups["com_payways"],
        project.online_skus,
    )
    return E.all_orders(self_orders, com_orders)


def order_reports(orders: DataFrame, project: Project) -> dict[str, DataFrame]:
    """Daily, age and refund-and-rebuy reports for each kind of order."""
    start, end = project.first_day, project.last_day
    reports: dict[str, DataFrame] = {}
    for kind in ("self", "com", "all"):
        cols = project.columns
        rows = orders if kind == "all" else orders.filter(F.col(cols.group) == kind)
        if kind == "com" and ORDER_TIME in orders.columns:
            # Corporate reports go by the time of the order, paid or not.
            cols = replace(cols, date_created=ORDER_TIME)
        ranks = N.company_rank(rows, cols, start, end)
        daily = N.daily_net(rows, cols, kind, start, end)
        reports[f"daily_{kind}"] = S.sorted_report(daily, None)
        reports[f"daily_company_{kind}"] = S.sorted_report(
            N.daily_company_net(rows, cols, kind, start, end), ranks
        )
        reports[f"daily_channel1_{kind}"] = S.sorted_report(
            N.daily_channel1_net(rows, cols, kind, start, end), ranks, "channel_1"
        )
        reports[f"daily_channel2_{kind}"] = S.sorted_report(
            N.daily_channel2_net(rows, cols, kind, start, end), ranks, "channel_1", "channel_2"
        )
        reports[f"age_sex_{kind}"] = P.age_sex(rows, cols, kind, start, end)
        reports[f"age_sex_company_{kind}"] = P.age_sex(rows, cols, kind, start, end, by="company")
        if kind != "all":
            # The two kinds come from tables with ids of their own.
            reports[f"duplicate_orders_{kind}"] = N.duplicate_orders(rows, cols.order_item_id)
    cols = project.columns
    reports["kpi"] = S.kpi_summary(N.daily_net(orders, cols, "all", start, end), project.days)
    reports["lured_refunds_company"] = T.lured_refunds_company(orders, cols)
    reports["lured_refunds_channel"] = T.lured_refunds_channel(orders, cols)
    return reports


def people_reports(orders: DataFrame, project: Project, codes: DataFrame) -> dict[str, DataFrame]:
    """The fact sheet and what belongs to it."""
    cols = project.columns
    scope = {"start": project.start, "end": project.end}
    bought = cols.date_created
    valid = P.sold_between(orders, cols, ["date_created"], **scope)
    methods = P.payment_method_share(orders, cols, **scope)
    return {
        "fact_sheet": P.fact_sheet(
            orders, cols, **scope, online=project.online_pattern, with_medical=True
        ),
        "star_signs": P.star_sign_counts(orders, cols, project.top, **scope),
        "zodiac": P.zodiac_counts(orders, cols, project.top, **scope),
        "regions": R.region_counts(orders, codes, cols, project.id_prefix, project.top, **scope),
        "payment_methods": methods,
        "payment_summary": S.payment_summary(methods),
        "relationship": P.relationship_share(orders, cols, project.with_relation, **scope),
        "youngest_oldest": P.youngest_oldest(orders, cols, **scope),
        "surnames": P.surname_counts(orders, cols, **scope),
        "hours": P.hour_profile(valid.withColumnRenamed("date_created", bought), bought),
    }


def agent_reports(
    orders: DataFrame, project: Project, channels: DataFrame, company_channels: DataFrame, folder: str
) -> dict[str, DataFrame]:
    """Agent reports; the per-agent days they share are written once below ``folder``.

    Milestones count orders made by automatic deduction as well.
    """
    offline = orders.filter(not_in(F.col(project.columns.company), [ONLINE_COMPANY]))
    days = snapshot(A.agent_days(offline, project.columns, own_purchases=True), "agent_days", folder)
    every_day = A.agent_days(offline, project.columns)
    registry = A.agent_registry(channels, company_channels)
    start, end = project.first_day, project.last_day
    registered = A.agent_registered(days, registry, start, end)
    return {
        "agent_registered": registered,
        "agent_milestones": A.agent_milestones(every_day, start, end, project.ended, registry),
        "agents_below_average": A.agents_below_average(days, registry, end),
        "agent_summary": A.agent_summary(registered),
    }


def run(
    project: Project,
    raw: Mapping[str, DataFrame],
    lookups: Mapping[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    run_time: str | None = None,
) -> list[str]:
    """Enrich, write the orders to the shared folder, run and write the reports below.

    With ``run_time`` the reports go into tables that hold all cities and runs (see
    :func:`orderlens.sources.tables.publish`), those of ``COMPANY_LISTS`` apart by company;
    without it, into a folder of the city and year. What is kept in between lies in a folder of this run and is removed afterwards.
    """
    spark = raw["order_item"].sparkSession
    scratch = run_folder(spark, f"{project.city}-{project.year}")
    try:
        return _run(project, raw, lookups, folder, fmt, scratch, run_time)
    finally:
        remove_folder(spark, scratch)


def _run(project, raw, lookups, folder, fmt, scratch, run_time) -> list[str]:
    orders = snapshot(enrich(project, raw, lookups), "orders", scratch)
    channels = E.channel_table(raw["sales_channel"]).withColumnsRenamed(
        {"sale_channel_id": "channel_id", "channel_date_created": "registered"}
    )
    reports = {
        **order_reports(orders, project),
        **people_reports(orders, project, R.region_codes(lookups["regions"])),
        **agent_reports(orders, project, channels, lookups["company_channels"], scratch),
    }
    if run_time is not None:
        numbered = {name: with_row_order(name, report) for name, report in reports.items()}
        return publish(numbered, folder, project.city, run_time, COMPANY_LISTS)
    shown = {name: in_row_order(name, report) for name, report in reports.items()}
    return write_reports(shown, f"{folder.rstrip('/')}/{project.city}/{project.year}", fmt)
