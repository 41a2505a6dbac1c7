"""Time bounds, names from one row, repairs and launch day on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.columns import Columns
from orderlens.operators import demography as P
from orderlens.operators import netting as N
from orderlens.operators import prepare as E
from orderlens.plans.catalog import queries
from tests.conftest import d, rows


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_wall_clock_bounds_whatever_the_process_zone(spark, kind):
    """The process runs in its own zone, the session in Shanghai."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    times = ["2021-12-31 23:59:59", "2022-01-01 00:30:00", "2022-01-31 23:30:00", "2022-02-01 00:30:00"]
    df = session.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind).alias("date_created"))
    start, end = dt.datetime(2022, 1, 1), dt.datetime(2022, 2, 1)
    kept = E.created_between(df, start, end).select(F.col("date_created").cast("string")).collect()
    assert sorted(r[0] for r in kept) == times[1:3]
    late = E.created_between(df, dt.datetime(2022, 1, 31, 23, 0), None).count()
    assert late == 2
    sold = P.sold_between(df, Columns(), [], dt.datetime(2022, 1, 1, 0, 30), dt.datetime(2022, 1, 31, 23, 30), drop_refunds=False)
    assert sold.count() == 2
    assert df.filter(N.in_period(F.to_date("date_created"), start, end)).count() == 3


CHANNEL3 = (
    "order_item_id string, date_created date, date_updated date, policy_order_status string, company string, "
    "channel_1 string, channel_2 string, channel_3 string, sale_channel_id string, open_id string, applicant_id_no string, com_id string"
)


def test_level_three_rows_carry_names_that_exist(spark):
    day, later = d("2022-01-01"), d("2022-01-02")
    data = [
        ("2", day, day, "00", "A", "Z1", "B2", "C9", "k", "u", "u", None),
        ("1", day, day, "00", "B", "A1", "Z2", "A9", "k", "u", "u", None),
        ("3", day, later, "04", "A", "Z1", "B2", "C9", "k", "v", "v", None),
        ("4", later, later, "00", "A", "A1", "B2", "C9", "k", "u", "u", None),
    ]
    got = rows(N.daily_channel3_net(spark.createDataFrame(data, CHANNEL3)), "date", "company", "channel_1", "channel_2", "channel_3", "users", "orders", "refunds", "net_orders")
    assert got == [
        (None, "B", "A1", "Z2", "A9", 2, 4, 1, 3),
        (day, "A", "Z1", "B2", "C9", 2, 2, 0, 2),
        (day, "B", "A1", "Z2", "A9", 1, 1, 0, 1),
        (later, "A", "A1", "B2", "C9", 1, 1, 0, 1),
        (later, "A", "Z1", "B2", "C9", 0, 0, 1, -1),
    ]


def test_level_three_reads_the_orders_once(spark, tmp_path):
    day, later = d("2022-01-01"), d("2022-01-02")
    data = [
        ("1", day, None, "04", None, "A1", None, "C1", "k", "u", "v", None),
        ("2", day, later, "00", "A", "A1", "B1", "C1", "k", "u", "u", "m"),
        ("3", None, later, "04", "A", "A1", "B1", "C1", "k", "u", "u", None),
        ("4", day, later, "04", "A", "A1", "B1", "C1", None, "u", "u", None),
    ]
    spark.createDataFrame(data, CHANNEL3).write.parquet(str(tmp_path / "orders"))
    report = N.daily_channel3_net(spark.read.schema(CHANNEL3).parquet(str(tmp_path / "orders")))
    assert rows(report, "date", "company", "channel_1", "channel_2", "channel_3", "is_total", "users", "applicants", "orders", "refunds", "net_orders") == [
        (None, None, "A1", None, "C1", 0, 0, 0, 0, 1, -1),
        (None, None, "A1", None, "C1", 1, 2, 2, 2, 1, 1),
        (day, None, "A1", None, "C1", 0, 1, 1, 1, 0, 1),
        (day, "A", "A1", "B1", "C1", 0, 1, 1, 1, 0, 1),
    ]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_level_three_deals_orders_once_and_spreads_a_hot_channel(spark):
    """One shuffle of orders, refunds and buyers, one of days and totals; days and buyers of a channel lie in many slots."""
    day = d("2022-01-01")
    data = [
        (str(k), day + dt.timedelta(k % 60), day + dt.timedelta(k % 50), "04" if k % 3 == 0 else "00", "A", "A1", f"B{k % 2}", "C1", "k",
         f"u{k % 70}" if k % 5 else None, f"p{k % 90}" if k % 7 else None, "m" if k % 11 == 0 else None)
        for k in range(600)
    ]
    df = spark.createDataFrame(data, CHANNEL3)
    report = N.daily_channel3_net(df)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan
    users, applicants = ({r[11] or r[c] for r in data} for c in (9, 10))
    refunds = sum(r[3] == "04" for r in data)
    total = [(None, len(users), len(applicants), 600, refunds, 600 - refunds)]
    assert rows(report.filter("is_total = 1"), "date", "users", "applicants", "orders", "refunds", "net_orders") == total
    for r in report.filter("is_total = 0").collect():
        sold = [x for x in data if x[1] == r.date]
        shown = any(x[6] == r.channel_2 for x in sold)
        assert (r.users, r.applicants, r.orders) == ((len({x[11] or x[9] for x in sold}), len({x[11] or x[10] for x in sold}), len(sold)) if shown else (0, 0, 0))
    cells = N._channel_cells(df, Columns(), "all", None, None, ["channel_1", "channel_2", "channel_3"])
    held = [r[0] for r in cells.groupBy("slot").count().select("count").collect()]
    assert len(held) > N.CHANNEL_SLOTS // 2 and max(held) < sum(held) / 4


def test_level_three_compares_ids_of_several_types_as_text(spark):
    day = d("2022-01-01")
    data = [(10, day, None, "00", "A", "A1", "B1", "C1", "k", "7", 7, None), (9, day, None, "00", "A", "A2", "B1", "C1", "k", "8", 7, 7)]
    schema = CHANNEL3.replace("order_item_id string", "order_item_id bigint").replace("applicant_id_no string, com_id string", "applicant_id_no bigint, com_id int")
    report = N.daily_channel3_net(spark.createDataFrame(data, schema))
    # The corporate id 7 is the user 7; of equal days the first order is the first by its text, 10.
    assert rows(report, "date", "channel_1", "users", "applicants", "orders") == [(None, "A1", 1, 1, 2), (day, "A1", 1, 1, 2), (day, "A2", 1, 1, 2)]


def test_repair_leaves_intact_channels_alone(spark):
    data = [("p", None, "A", "B", None, "P"), ("p", None, "A2", "B2", None, "P"), ("c", None, "X", "Y", "p", "C"), ("b", None, None, None, "p", "C")]
    df = spark.createDataFrame(data, "sale_channel_id string, channel_date_created date, channel_1 string, channel_2 string, parent_id string, channel_3 string")
    assert rows(E.repair_channels(df), "sale_channel_id", "channel_1", "channel_2") == [
        ("b", "A", "B"), ("c", "X", "Y"), ("p", "A", "B"), ("p", "A2", "B2"),
    ]


def test_launch_day_may_hold_refunds_only(spark):
    """The first day decides whose birthday counts, though all its orders came back."""
    data = [(d("2022-01-01"), "04", d("1990-01-01")), (d("2022-01-02"), "00", d("1980-01-01")), (d("2022-01-02"), "00", d("1980-01-02"))]
    df = spark.createDataFrame([(*r, "self", "A", "男", "身份证", "x") for r in data], "date_created date, policy_order_status string, birthday date, group string, company string, sex string, id_type string, id_no string")
    sheet = {r.label: r.people for r in P.fact_sheet(df).collect()}
    assert sheet["净投保量"] == 2 and sheet["和项目同一天生日"] == 1


def test_grouping_sets_see_daily_counts_not_orders(spark, sf_dir):
    for name in ("daily_net_orders", "daily_company_net", "daily_channel2_net", "daily_channel3_net"):
        lines = queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        for at in (k for k, line in enumerate(lines) if "Expand" in line):
            assert "Aggregate" in lines[at + 1], name
