"""Queries over the test tables, one per report operator.

Each callable takes the session and the folder of a scale factor. Dates are
shown as ISO text and money as doubles, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from orderlens.columns import Columns
from orderlens.functions.dates import parse_timestamp
from orderlens.operators import agents as A
from orderlens.operators import deduction as D
from orderlens.operators import demography as P
from orderlens.operators import exclusion as X
from orderlens.operators import netting as N
from orderlens.operators import prepare as E
from orderlens.operators import regions as R
from orderlens.operators import retention as T
from orderlens.operators import summary as S
from orderlens.plans.nightly import row_order
from orderlens.plans.roles import fact, raw, table
from orderlens.sources.lookups import LOOKUPS, of_project, read_lookup, rejected_rows
from orderlens.sources.tables import materialised, newest, publish, read_published, remove_folder, run_folder

Query = Callable[[SparkSession, str], DataFrame]

START, END = date(1996, 1, 1), date(2000, 12, 31)
LAST_YEAR = ("1999-01-01", "1999-12-31")
THIS_YEAR = ("2000-01-01", "2000-12-31")
RUN_DAYS = 2404
SINCE = "1997-01-01"
ONLINE_PATTERN = "线上平台|Brand#2"
PRODUCTS = ("v0", "v1", "v2")
REGION_NAMES = ("NATION_1", "NATION_2", "展E保")
PRICES = ("7900", "19900", "8000")
SKUS = ("sku0", "sku1", "sku2", "sku3", "sku4")
ONLINE_SKUS = ("sku4",)
COMPANY_OF_SKU = {
    "sku0": "甲保险",
    "sku1": "乙保险",
    "sku2": "丙保险",
    "sku3": "丁保险",
    "sku4": "戊保险",
}
PAYWAYS = {"0": "微信", "1": "支付宝", "2": "银联", "3": "医保个账"}
BATCHES = (
    X.BatchRule("1", skus=("sku0", "sku1", "sku2")),
    X.BatchRule("2", companies=("BUILDING",), first_day="1999-03-01"),
    X.BatchRule("3", skus=("sku5",), last_day="1999-06-30"),
)
ACCOUNT_LIMIT = 2
FAILED_TASKS = ("1", "3")
SELLER = Columns(company="seller")

NET_ROLES = (
    "date_created", "date_updated", "group", "policy_order_status", "open_id", "applicant_id_no",
    "com_id", "automatic_deduction",
)
PERSON_ROLES = ("name", "id_type", "id_no", "birthday", "sex")


def show(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as doubles."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            casts[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
    return df.withColumns(casts) if casts else df


def literal(spark: SparkSession, names: tuple[str, str], rows: dict[str, str]) -> DataFrame:
    """A small two-column lookup."""
    pairs = [F.struct(F.lit(k).alias(names[0]), F.lit(v).alias(names[1])) for k, v in rows.items()]
    return spark.range(1).select(F.inline(F.array(*pairs)))


# Orders per day -----------------------------------------------------------


def _net(spark, sf_dir, kind="all", by=(), report=N.net_orders, extra=()):
    rows = fact(spark, sf_dir, *NET_ROLES, *by, *extra)
    if kind != "all":
        rows = rows.filter(F.col("group") == kind)
    return report(rows, kind=kind)


def company_rank(spark, sf_dir):
    return N.company_rank(fact(spark, sf_dir, "company"))


def orders_vs_users(spark, sf_dir):
    return N.orders_vs_users(fact(spark, sf_dir, "order_item_id", *NET_ROLES))


def user_order_histogram(spark, sf_dir):
    return N.user_order_histogram(fact(spark, sf_dir, *NET_ROLES))


def duplicate_orders(spark, sf_dir):
    return N.duplicate_orders(
        fact(spark, sf_dir, "order_item_id", "date_updated", "sku_code", "sale_channel_id")
    )


def company_daily_stack(spark, sf_dir):
    return N.company_daily_stack(_net(spark, sf_dir, by=("company",), report=N.daily_company_net))


def kpi_summary(spark, sf_dir):
    return S.kpi_summary(_net(spark, sf_dir, report=N.daily_net), RUN_DAYS)


# People -------------------------------------------------------------------

AGE_ROLES = ("date_created", "policy_order_status", "birthday", "sex")


def age_sex(spark, sf_dir):
    return P.age_sex(fact(spark, sf_dir, *AGE_ROLES))


def _age_sex_of(spark, sf_dir, kind, gap):
    rows = fact(spark, sf_dir, *AGE_ROLES, "group").filter(F.col("group") == kind)
    return P.age_sex(rows, kind=kind, gap=gap)


def age_sex_percent(spark, sf_dir):
    return S.show_percent(age_sex(spark, sf_dir))


def age_sex_company(spark, sf_dir):
    return P.age_sex(fact(spark, sf_dir, *AGE_ROLES, "company"), gap=10, by="company")


def age_sex_long(spark, sf_dir):
    return S.age_sex_long(age_sex(spark, sf_dir))


def age_decades(spark, sf_dir):
    return P.age_decades(P.age_sex(fact(spark, sf_dir, *AGE_ROLES)))


def _facts(spark, sf_dir):
    rows = fact(
        spark, sf_dir, *AGE_ROLES, "group", "seller", "id_type", "id_no", "medical_insure_flag"
    )
    return P.fact_sheet(rows, SELLER, START, END, online=ONLINE_PATTERN, with_medical=True)


def top_age_band(spark, sf_dir):
    return P.top_age_band(_facts(spark, sf_dir)).drop("sort_key")


def _signs(spark, sf_dir, report, top=None):
    return report(fact(spark, sf_dir, "date_created", "policy_order_status", "birthday"), top=top)


def _payment(spark, sf_dir):
    return P.payment_method_share(
        fact(spark, sf_dir, "date_created", "policy_order_status", "payway")
    )


def payment_summary(spark, sf_dir):
    return S.payment_summary(_payment(spark, sf_dir))


def relationship_share(spark, sf_dir):
    return P.relationship_share(
        fact(spark, sf_dir, "date_created", "policy_order_status", "group", "relation_ship")
    )


def relationship_by_customer(spark, sf_dir):
    rows = fact(spark, sf_dir, "date_created", "policy_order_status", "customer_id")
    return P.relationship_share(rows, by_relation=False)


def youngest_oldest(spark, sf_dir):
    return P.youngest_oldest(fact(spark, sf_dir, *AGE_ROLES))


def surname_counts(spark, sf_dir):
    return P.surname_counts(fact(spark, sf_dir, "date_created", "policy_order_status", "name"))


def hour_profile(spark, sf_dir):
    return P.hour_profile(table(spark, sf_dir, "events"), bought="ts")


# Regions ------------------------------------------------------------------

REGION_ROLES = ("order_item_id", "date_created", "date_updated", "policy_order_status", "id_no")


def _codes2(spark, sf_dir):
    return raw(spark, sf_dir, "region_codes_2").filter("region is not null")


def _codes6(spark, sf_dir):
    """Six-digit codes; one of them belongs to two regions."""
    codes = _codes2(spark, sf_dir).select(
        "region", F.explode(F.array(F.lit("0001"), F.lit("0002"))).alias("tail"), "code"
    )
    codes = codes.select("region", F.concat("code", "tail").alias("code"))
    shared = codes.filter("code = '120001'").select(F.lit("HARBOUR").alias("region"), "code")
    return codes.unionByName(shared)


def region_net_daily(spark, sf_dir):
    return R.region_net_daily(fact(spark, sf_dir, *REGION_ROLES), _codes2(spark, sf_dir))


def _region_money(spark, sf_dir, since=SINCE):
    rows = fact(spark, sf_dir, *REGION_ROLES, "payment_amount", "product")
    return R.region_net_daily(
        rows.withColumnRenamed("product", "group"),
        _codes2(spark, sf_dir),
        group="group",
        price="price",
        since=since,
    )


def region_premium(spark, sf_dir, since=SINCE):
    return R.region_premium(_region_money(spark, sf_dir, since), group="group")


def _region_share(spark, sf_dir, grain):
    return R.region_share(fact(spark, sf_dir, *REGION_ROLES), _codes2(spark, sf_dir), grain=grain)


def _named(df, prefix=""):
    """Periods without minus signs in the names of columns."""
    kept = ("region", "net_orders", "premium")
    return df.withColumnsRenamed({c: prefix + c.replace("-", "_") for c in df.columns if c not in kept})


def region_period_wide(spark, sf_dir, grain):
    long = materialised(_region_share(spark, sf_dir, grain).filter("is_total = 0"))
    return _named(R.region_wide(long), "net_")


def region_share_monthly_wide(spark, sf_dir):
    long = materialised(_region_share(spark, sf_dir, "month").filter("is_total = 0"))
    wide = R.region_wide(long, shares=True)
    return _named(wide.withColumnsRenamed({c: f"net_{c}" for c in wide.columns if c[0].isdigit()}))


def region_group_wide(spark, sf_dir):
    daily = _region_money(spark, sf_dir, since=None)
    monthly = materialised(daily.withColumn("period", F.date_format("date", "yyyy-MM")))
    return _named(R.region_wide(monthly, group="group", groups=PRODUCTS))


def _region_counts(spark, sf_dir, top=None):
    rows = fact(spark, sf_dir, "date_created", "policy_order_status", "id_no")
    return R.region_counts(rows, _codes6(spark, sf_dir), top=top)


def region_counts_by_name(spark, sf_dir):
    rows = fact(
        spark, sf_dir, "order_item_id", "date_created", "policy_order_status", "channel_1", "channel_2"
    )
    return R.region_counts_by_name(rows, REGION_NAMES, columns=("channel_1", "channel_2"))


def top_regions(spark, sf_dir):
    return R.top_regions(_region_counts(spark, sf_dir))


# Agents -------------------------------------------------------------------


def _agent_days(spark, sf_dir, own_purchases=False):
    rows = fact(
        spark, sf_dir, "company", "sale_channel_id", "date_created", "date_updated",
        "policy_order_status", "is_automatic_deduction",
    )
    # Reports read this table several times; it is much smaller than the orders.
    return materialised(A.agent_days(rows, own_purchases=own_purchases))


def _registry(spark, sf_dir):
    return A.agent_registry(raw(spark, sf_dir, "agents"), raw(spark, sf_dir, "company_channels"))


def agent_daily(spark, sf_dir):
    return A.agent_daily(_agent_days(spark, sf_dir, own_purchases=True), START, END)


def agent_cumulative(spark, sf_dir):
    return A.agent_cumulative(_agent_days(spark, sf_dir), START, END)


def agent_calendar(spark, sf_dir):
    return A.agent_calendar(_agent_days(spark, sf_dir), START, END)


def agent_milestones(spark, sf_dir, registered=False):
    registry = _registry(spark, sf_dir) if registered else None
    return A.agent_milestones(_agent_days(spark, sf_dir), START, END, registry=registry)


def agent_registered(spark, sf_dir):
    return A.agent_registered(_agent_days(spark, sf_dir), _registry(spark, sf_dir), START, END)


def agents_below_average(spark, sf_dir):
    return A.agents_below_average(_agent_days(spark, sf_dir), _registry(spark, sf_dir), END)


def agent_order_rate(spark, sf_dir):
    rows = fact(
        spark, sf_dir, "order_item_id", "policy_order_status", "channel_1", "channel_2", "channel_3",
        "sale_channel_id",
    )
    return A.agent_order_rate(
        rows, raw(spark, sf_dir, "agents"), raw(spark, sf_dir, "company_channels"), START, END
    )


def agent_long(spark, sf_dir):
    return S.agent_long(agent_cumulative(spark, sf_dir))


def agent_summary(spark, sf_dir):
    return A.agent_summary(agent_registered(spark, sf_dir), exclude=("FURNITURE",))


def agents_long(spark, sf_dir):
    return S.agents_long(agent_summary(spark, sf_dir))


# Rebuying and renewals ----------------------------------------------------


def lured_refunds_company(spark, sf_dir):
    rows = fact(
        spark, sf_dir, "order_item_id", "date_created", "policy_order_status", "seller", *PERSON_ROLES
    )
    return T.lured_refunds_company(rows, SELLER)


def lured_refunds_channel(spark, sf_dir):
    rows = fact(
        spark, sf_dir, "order_item_id", "date_created", "policy_order_status", "seller",
        "channel_1", "channel_2", "channel_3", *PERSON_ROLES,
    )
    return T.lured_refunds_channel(rows, SELLER)


def _orders_of_people(spark, sf_dir, *roles):
    """Orders of both years; id is the applicant."""
    rows = fact(
        spark, sf_dir, "date_created", "policy_order_status", "group", "company", "applicant_id_no", *roles,
    )
    return rows.withColumn("id_no", F.expr("nullif(applicant_id_no, 7)"))


def renewal(spark, sf_dir, year, kind):
    return T.renewals(T.person_years(_orders_of_people(spark, sf_dir), LAST_YEAR, THIS_YEAR), year, kind)


def merged_renewal(spark, sf_dir, year, zeros=True):
    return T.merged_renewals(T.person_years(_orders_of_people(spark, sf_dir), LAST_YEAR, THIS_YEAR), year, zeros)


def auto_deduct_remaining(spark, sf_dir):
    orders = _orders_of_people(
        spark, sf_dir, "order_item_id", "automatic_deduction", "is_automatic_deduction",
        "medical_insure_flag", "payway",
    )
    states = T.deduction_states(orders, LAST_YEAR, THIS_YEAR, by_payment=True)
    return T.auto_deduct_remaining(materialised(states), by_payment=True)


# Deduction ----------------------------------------------------------------


def _stage_counts(spark, sf_dir):
    exceptions = fact(spark, sf_dir, "order_item_id", "task_id", "step", "message").select(
        "order_item_id",
        F.col("task_id").alias("auto_deduction_base_id"),
        "step",
        F.col("message").alias("exception_describe"),
    )
    return D.deduction_stage_counts(
        raw(spark, sf_dir, "task_totals"), exceptions, _tasks(spark, sf_dir)
    )


def _tasks(spark, sf_dir):
    return D.deduction_tasks(raw(spark, sf_dir, "task_config"), city="A")


def deduction_funnel(spark, sf_dir):
    return D.deduction_funnel(_stage_counts(spark, sf_dir), _tasks(spark, sf_dir))


SIGNED_ROLES = (
    "order_item_id", "date_created", "company", "sku_code", "open_id", "customer_id",
    "applicant_id_no", "automatic_deduction", *PERSON_ROLES,
)
SIGNED_COLUMNS = (
    "ad_group", "order_item_id", "company", "sku_code", "open_id", "customer_id",
    "applicant_id_no", *PERSON_ROLES,
)


# Some open ids are empty texts; some orders carry another customer or open id.
SIGNED_CUSTOMER = (
    "cast(customer_id as string) || case when order_item_id % 40 = 3 then 'c' else '' end"
)
SIGNED_OPEN_ID = (
    "case when open_id is null and customer_id % 2 = 0 then '' "
    "else cast(open_id as string) || case when order_item_id % 30 = 1 then 'o' else '' end end"
)


def _signed(spark, sf_dir):
    """Last year's signed orders, in batches."""
    rows = fact(spark, sf_dir, *SIGNED_ROLES).filter(F.col("date_created").between(*LAST_YEAR))
    rows = rows.withColumns(
        {
            "customer_id": F.expr(SIGNED_CUSTOMER),
            "open_id": F.expr(SIGNED_OPEN_ID),
        }
    )
    return X.signed_orders(X.assign_batches(rows, BATCHES), SIGNED_COLUMNS)


def _ids(spark, sf_dir, condition):
    """Insured persons of some customers, as a given list."""
    customers = fact(spark, sf_dir, "applicant_id_no", "id_no").filter(condition)
    return customers.select("id_no").distinct()


def _rules(spark, sf_dir, signed):
    com = fact(spark, sf_dir, "date_created", "group", "id_no").filter(
        F.col("date_created").between(*THIS_YEAR) & (F.col("group") == "com")
    )
    medical = fact(spark, sf_dir, "applicant_id_no").filter("applicant_id_no % 41 = 0")
    attempts = fact(spark, sf_dir, "order_item_id", "task_id", "step").select(
        F.col("order_item_id").alias("old_order_item_id"),
        F.col("task_id").cast("string").alias("auto_deduction_base_config_id"),
        F.expr("case step when 1 then '31' when 2 then '40' when 3 then '41' else '10' end").alias(
            "deal_status"
        ),
    )
    return {
        "listed": X.listed_people(_ids(spark, sf_dir, "applicant_id_no % 97 = 0")),
        "rebought": X.rebought(com),
        "over_limit": X.over_limit(signed, ACCOUNT_LIMIT),
        "failed": X.failed_attempts(attempts, FAILED_TASKS),
        "same_day": X.same_day_accounts(signed),
        "medical": X.listed_applicants(medical.select(F.col("applicant_id_no").alias("id_no"))),
    }


def _rule(spark, sf_dir, name):
    signed = _signed(spark, sf_dir)
    return X.caught(signed, _rules(spark, sf_dir, signed)[name])


def _multiple(spark, sf_dir, key, other):
    signed = _signed(spark, sf_dir)
    return X.caught(signed, X.multiple_ids(signed, key, other))


def exclusion_list(spark, sf_dir):
    signed = materialised(_signed(spark, sf_dir))
    return X.exclusion_list(signed, _rules(spark, sf_dir, signed))


def exclusion_sheet(spark, sf_dir):
    return X.exclusion_sheet(exclusion_list(spark, sf_dir))


def people_without_key(spark, sf_dir):
    return X.people_without_key(_signed(spark, sf_dir))


# Extraction ---------------------------------------------------------------


def latest_refund_remark(spark, sf_dir):
    return E.latest_refund_remarks(raw(spark, sf_dir, "order_trade_record"))


def _channels(spark, sf_dir):
    parts = [raw(spark, sf_dir, name) for name in ("sales_channel", "sales_channel_2", "sales_channel_1")]
    return E.channel_table(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _self_orders(spark, sf_dir):
    def read(name):
        return raw(spark, sf_dir, name)

    start, end = str(START), str(END)
    return E.enrich_self_orders(
        E.self_order_items(read("order_item"), start, end, PRICES, SKUS),
        E.self_insured(read("order_service_obj"), start, end),
        E.self_applicants(read("order_insurance_applicant"), start, end),
        _channels(spark, sf_dir),
        literal(spark, ("sku_code", "company"), COMPANY_OF_SKU),
        literal(spark, ("payway_code", "payway"), PAYWAYS),
        E.self_policies(read("policy_order"), start, end),
        ONLINE_SKUS,
    )


def _com_orders(spark, sf_dir):
    def read(name):
        return raw(spark, sf_dir, name)

    start, end = str(START), str(END)
    return E.enrich_com_orders(
        E.com_order_items(read("com_order_item"), start, end, PRICES, SKUS),
        E.com_insured(read("com_order_item_info"), start, end),
        E.com_payments(read("com_order_payment"), start, end),
        E.com_main_orders(read("com_order"), start, end),
        E.com_policies(read("com_order_policy"), start, end),
        _channels(spark, sf_dir),
        literal(spark, ("sku_code", "company"), COMPANY_OF_SKU),
        literal(spark, ("payway_code", "payway"), PAYWAYS),
        ONLINE_SKUS,
    )


def all_orders(spark, sf_dir):
    both = E.all_orders(_self_orders(spark, sf_dir), _com_orders(spark, sf_dir))
    return both.select(
        "order_item_id", "group", "date_created", "company", "channel_1", "channel_2", "channel_3",
        "policy_order_status", "is_automatic_deduction", "payway", "id_no", "com_id", "open_id",
    )


def channel_prefix_fallback(spark, sf_dir):
    items = E.self_order_items(raw(spark, sf_dir, "order_item"), None, None, PRICES, SKUS)
    items = items.select("order_item_id", "sale_channel_id")
    return E.with_channels_by_prefix(
        E.with_channels(items, _channels(spark, sf_dir)).drop("channel_date_created"),
        _channels(spark, sf_dir),
        (10, 14, 16),
    )


def latest_created(spark, sf_dir):
    return E.latest_created(raw(spark, sf_dir, "order_item"))


def latest_in_files(spark, sf_dir):
    return newest(spark, f"{sf_dir}/orders.parquet", "o_orderdate")


def com_items_unpaid(spark, sf_dir):
    return E.com_order_items(raw(spark, sf_dir, "com_order_item"), str(START), str(END), PRICES, SKUS, unpaid=True)


def company_profiles(spark, sf_dir):
    return E.company_profiles(raw(spark, sf_dir, "com_info"))


def parsed_stamps(spark, sf_dir):
    return raw(spark, sf_dir, "stamps").select("event_id", parse_timestamp(F.col("stamp")).alias("stamp"))


def replaced_rows(spark, sf_dir):
    """Every tenth order comes again, as two rows with a new amount."""
    items = raw(spark, sf_dir, "order_item").select("id", "payment_amount", "sku_code")
    newer = items.filter("id % 10 = 0").withColumn("payment_amount", F.explode(F.array(F.lit("1"), F.lit("2"))))
    return E.replace_rows(items, newer, "id")


# Sources and sinks --------------------------------------------------------


def _from_folder(spark, name, work):
    """What ``work`` reads from a folder of its own, which is removed afterwards."""
    folder = run_folder(spark, name)
    try:
        return materialised(work(folder))
    finally:
        remove_folder(spark, folder)


def _written_lookup(spark, sf_dir, folder):
    """The companies as a CSV file, line by line as they are."""
    header = ",".join(LOOKUPS["companies"])
    lines = raw(spark, sf_dir, "company_lines").withColumnRenamed("line", header)
    # A line is one field here, with a separator and a quote that it does not hold.
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(f"{folder}/companies")
    return f"{folder}/companies"


def lookup_read_back(spark, sf_dir):
    def work(folder):
        lookup = read_lookup(spark, "companies", _written_lookup(spark, sf_dir, folder))
        return of_project(lookup, "徐州", "2022", "self")

    return _from_folder(spark, "lookup", work)


def lookup_rejected(spark, sf_dir):
    return _from_folder(
        spark, "lookup", lambda folder: rejected_rows(spark, "companies", _written_lookup(spark, sf_dir, folder))
    )


def published_ranks(spark, sf_dir):
    """Two cities and three runs, one of which is written twice."""
    rows = fact(spark, sf_dir, "company", "group")

    def ranks(kind=None):
        return N.company_rank(rows if kind is None else rows.filter(F.col("group") == kind))

    def work(folder):
        for city, run, kind in (("甲", "007", None), ("乙", "007", "com"), ("甲", "007", "self"), ("甲", "010", None)):
            publish({"company_rank": ranks(kind)}, folder, city, run, per_company=("company_rank",))
        return read_published(spark, folder, "company_rank", latest=False)

    return _from_folder(spark, "published", work)


# Row order ----------------------------------------------------------------


def daily_company_ordered(spark, sf_dir):
    daily = materialised(_net(spark, sf_dir, by=("company",), report=N.daily_company_net))
    return S.numbered_report(daily, company_rank(spark, sf_dir))


def surnames_ordered(spark, sf_dir):
    return S.numbered(surname_counts(spark, sf_dir), F.desc("people"))


def lured_channels_ordered(spark, sf_dir):
    report = lured_refunds_channel(spark, sf_dir)
    return S.numbered(report, *row_order("lured_refunds_channel", report))


def _self_net(by, report):
    return partial(_net, kind="self", by=by, report=report)


REPORTS: dict[str, Query] = {
    "daily_net_orders": partial(_net, report=N.daily_net),
    "daily_net_self": _self_net((), N.daily_net),
    "daily_net_com": partial(_net, kind="com", report=N.daily_net),
    "daily_company_net": partial(_net, by=("company",), report=N.daily_company_net),
    "daily_company_self": _self_net(("company",), N.daily_company_net),
    "daily_channel1_net": partial(
        _net, by=("company", "channel_1"), report=N.daily_channel1_net
    ),
    "daily_channel2_net": partial(
        _net, by=("company", "channel_1", "channel_2"), report=N.daily_channel2_net
    ),
    "daily_channel3_net": partial(
        _net,
        by=("company", "channel_1", "channel_2", "channel_3", "sale_channel_id"),
        report=N.daily_channel3_net,
        extra=("order_item_id",),
    ),
    "company_rank": company_rank,
    "orders_vs_users": orders_vs_users,
    "user_order_histogram": user_order_histogram,
    "duplicate_orders": duplicate_orders,
    "company_daily_stack": company_daily_stack,
    "kpi_summary": kpi_summary,
    "age_sex": age_sex,
    "age_sex_company": age_sex_company,
    "age_sex_long": age_sex_long,
    "age_sex_self": partial(_age_sex_of, kind="self", gap=1),
    "age_sex_com": partial(_age_sex_of, kind="com", gap=5),
    "age_sex_percent": age_sex_percent,
    "age_decades": age_decades,
    "fact_sheet": _facts,
    "top_age_band": top_age_band,
    "star_sign_counts": partial(_signs, report=P.star_sign_counts),
    "star_sign_top3": partial(_signs, report=P.star_sign_counts, top=3),
    "zodiac_counts": partial(_signs, report=P.zodiac_counts),
    "zodiac_top3": partial(_signs, report=P.zodiac_counts, top=3),
    "payment_method_share": _payment,
    "payment_summary": payment_summary,
    "relationship_share": relationship_share,
    "relationship_by_customer": relationship_by_customer,
    "youngest_oldest": youngest_oldest,
    "surname_counts": surname_counts,
    "hour_profile": hour_profile,
    "region_net_daily": region_net_daily,
    "region_net_daily_price": _region_money,
    "region_premium": region_premium,
    "region_premium_full": partial(region_premium, since=None),
    "region_net_daily_price_full": partial(_region_money, since=None),
    "region_share_daily": partial(_region_share, grain="day"),
    "region_share_weekly": partial(_region_share, grain="week"),
    "region_share_monthly": partial(_region_share, grain="month"),
    "region_daily_wide": partial(region_period_wide, grain="day"),
    "region_monthly_wide": partial(region_period_wide, grain="month"),
    "region_share_monthly_wide": region_share_monthly_wide,
    "region_group_wide": region_group_wide,
    "region_counts": _region_counts,
    "region_counts_top3": partial(_region_counts, top=3),
    "region_counts_by_name": region_counts_by_name,
    "top_regions": top_regions,
    "agent_daily": agent_daily,
    "agent_cumulative": agent_cumulative,
    "agent_calendar": agent_calendar,
    "agent_long": agent_long,
    "agent_milestones": agent_milestones,
    "agent_milestones_registered": partial(agent_milestones, registered=True),
    "agent_registered": agent_registered,
    "agents_long": agents_long,
    "agents_below_average": agents_below_average,
    "agent_order_rate": agent_order_rate,
    "agent_summary": agent_summary,
    "lured_refunds_company": lured_refunds_company,
    "lured_refunds_channel": lured_refunds_channel,
    "renewal_last_year_self": partial(renewal, year="old", kind="self"),
    "renewal_last_year_com": partial(renewal, year="old", kind="com"),
    "renewal_this_year_self": partial(renewal, year="new", kind="self"),
    "renewal_this_year_com": partial(renewal, year="new", kind="com"),
    "renewal_last_year": partial(merged_renewal, year="old"),
    "renewal_last_year_nulls": partial(merged_renewal, year="old", zeros=False),
    "renewal_this_year": partial(merged_renewal, year="new"),
    "auto_deduct_remaining": auto_deduct_remaining,
    "deduction_stage_counts": _stage_counts,
    "deduction_funnel": deduction_funnel,
    "exclusion_listed": partial(_rule, name="listed"),
    "exclusion_rebought": partial(_rule, name="rebought"),
    "exclusion_over_limit": partial(_rule, name="over_limit"),
    "exclusion_failed": partial(_rule, name="failed"),
    "exclusion_same_day": partial(_rule, name="same_day"),
    "exclusion_medical": partial(_rule, name="medical"),
    "exclusion_multi_open_ids": partial(_multiple, key="customer_id", other="open_id"),
    "exclusion_multi_customers": partial(_multiple, key="open_id", other="customer_id"),
    "exclusion_multi_applicants": partial(_multiple, key="customer_id", other="applicant_id_no"),
    "exclusion_list": exclusion_list,
    "exclusion_sheet": exclusion_sheet,
    "people_without_key": people_without_key,
    "latest_refund_remark": latest_refund_remark,
    "channel_repair": _channels,
    "channel_prefix_fallback": channel_prefix_fallback,
    "enriched_orders": _self_orders,
    "enriched_com_orders": _com_orders,
    "all_orders": all_orders,
    "latest_created": latest_created,
    "latest_in_files": latest_in_files,
    "com_items_unpaid": com_items_unpaid,
    "company_profiles": company_profiles,
    "parsed_stamps": parsed_stamps,
    "replaced_rows": replaced_rows,
    "lookup_read_back": lookup_read_back,
    "lookup_rejected": lookup_rejected,
    "published_ranks": published_ranks,
    "daily_company_ordered": daily_company_ordered,
    "surnames_ordered": surnames_ordered,
    "lured_channels_ordered": lured_channels_ordered,
}


def _shown(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: partial(_shown, query) for name, query in REPORTS.items()}
