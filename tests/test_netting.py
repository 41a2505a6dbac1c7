"""Daily net counts on micro tables, and their invariants on the test tables."""

import pytest
from pyspark.sql import functions as F

from orderlens.columns import Columns
from orderlens.operators import netting as N
from orderlens.operators import summary as S
from orderlens.plans.roles import fact
from tests.conftest import d, rows

SCHEMA = (
    "order_item_id string, date_created date, date_updated date, policy_order_status string, "
    "company string, open_id string, applicant_id_no string, com_id string, automatic_deduction int"
)
DATA = [
    ("1", d("2022-01-01"), d("2022-01-01"), "00", "A", "u1", "p1", None, 1),
    ("2", d("2022-01-01"), d("2022-01-03"), "04", "A", "u1", "p1", None, 1),
    ("3", d("2022-01-01"), d("2022-01-01"), None, "B", None, "p2", None, 0),
    ("4", d("2022-01-02"), d("2022-01-05"), "05", None, "u2", "p3", "c1", 0),
    ("5", d("2022-01-02"), d("2022-01-02"), "00", "B", "u2", "p3", "c1", 1),
    ("6", None, d("2022-01-02"), "04", "A", "u9", "p9", None, 1),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_daily_net_of_all_orders(orders):
    found = rows(N.daily_net(orders))
    assert found == [
        (None, 1, 3, 3, 5, 2, 3),
        (d("2022-01-01"), 0, 2, 2, 3, 0, 3),
        (d("2022-01-02"), 0, 1, 1, 2, 0, 2),
        (d("2022-01-03"), 0, 0, 0, 0, 1, -1),
        (d("2022-01-05"), 0, 0, 0, 0, 1, -1),
    ]


def test_kind_decides_what_a_refund_is(orders):
    # For individual orders 05 is no refund, and the corporate id is not the user.
    found = rows(N.daily_net(orders, kind="self").filter("is_total = 1"))
    assert found == [(None, 1, 3, 3, 5, 1, 4, 2)]
    with pytest.raises(ValueError):
        N.daily_net(orders, kind="both")


def test_company_report_leaves_out_unknown_companies(orders):
    found = rows(N.daily_company_net(orders), "company", "date", "is_total", "orders", "refunds")
    assert found == [
        ("A", None, 1, 2, 1),
        ("A", d("2022-01-01"), 0, 2, 0),
        ("A", d("2022-01-03"), 0, 0, 1),
        ("B", None, 1, 2, 0),
        ("B", d("2022-01-01"), 0, 1, 0),
        ("B", d("2022-01-02"), 0, 1, 0),
    ]


def test_period_selects_by_creation_but_refunds_may_be_later(orders):
    found = rows(N.daily_net(orders, start="2022-01-01", end="2022-01-01"), "date", "orders", "refunds")
    assert found == [(None, 3, 1), (d("2022-01-01"), 3, 0), (d("2022-01-03"), 0, 1)]


def test_users_and_orders(orders):
    assert rows(N.orders_vs_users(orders)) == [(3, 3, 1.0)]
    found = rows(N.user_order_histogram(orders, kind="self"), "sort_key", "users", "orders_per_user")
    assert found == [(1, 1, "1"), (2, 1, "2")]


def test_more_than_nine_orders_share_a_bucket(spark):
    data = [(str(i), d("2022-01-01"), None, "00", "A", "u", "p", None, 0) for i in range(12)]
    found = rows(N.user_order_histogram(spark.createDataFrame(data, SCHEMA), kind="self"))
    assert found == [(10, 1, ">9")]


def test_column_names_are_parameters(orders):
    renamed = orders.withColumnsRenamed({"company": "seller", "open_id": "user"})
    cols = Columns(company="seller", open_id="user")
    assert rows(N.daily_company_net(renamed, cols)) == rows(N.daily_company_net(orders))


def test_duplicates_keep_every_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "order_item_id string, n int")
    assert rows(N.duplicate_orders(df)) == [(None, 4), (None, 5), ("a", 1), ("a", 2)]


def test_company_rank(spark):
    df = spark.createDataFrame([("B",), ("A",), ("C",), ("C",), (None,)], "company string")
    assert rows(N.company_rank(df), "company", "orders", "sort_key") == [("A", 1, 2), ("B", 1, 3), ("C", 2, 1)]


def test_kpis(orders):
    row = S.kpi_summary(N.daily_net(orders), 4).first()
    assert (row.orders, row.refunds, row.net_orders, row.applicants) == (5, 2, 3, 3)
    assert (row.refund_rate, row.orders_per_day, row.orders_per_applicant) == (0.4, 0.8, 1.0)
    assert (row.first_day, row.first_day_net, row.best_day, row.best_day_net) == (
        d("2022-01-01"), 3, d("2022-01-01"), 3,
    )


def test_sorted_report_puts_totals_last(orders):
    ranks = N.company_rank(orders)
    shown = S.show_totals(S.sorted_report(N.daily_company_net(orders), ranks), "合计")
    found = [(r.company, r.date) for r in shown.collect()]
    assert found == [
        ("A", "2022-01-01"), ("A", "2022-01-03"), ("A", "合计"),
        ("B", "2022-01-01"), ("B", "2022-01-02"), ("B", "合计"),
    ]


def test_companies_and_the_unknown_one_add_up(spark, sf_dir):
    roles = ("date_created", "date_updated", "policy_order_status", "open_id", "applicant_id_no", "com_id", "company")
    all_rows = fact(spark, sf_dir, *roles)
    total = N.daily_net(all_rows).filter("is_total = 1").first()
    known = N.daily_company_net(all_rows).filter("is_total = 1")
    unknown = N.daily_net(all_rows.filter("company is null")).filter("is_total = 1")
    added = known.select("net_orders").union(unknown.select("net_orders")).agg(F.sum("net_orders")).first()[0]
    assert added == total.net_orders


def test_hot_buyer_and_missing_users(spark):
    """One user holds a third of all rows and another third has none."""
    data = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"u{i}"
        data.append((str(i), d("2022-01-01"), d("2022-01-02"), "04" if i % 2 else "00", "A", user, user, None, 0))
    found = rows(N.daily_company_net(spark.createDataFrame(data, SCHEMA), kind="self"), "date", "users", "orders", "refunds")
    assert found == [
        (None, 1002, 3000, 1500),
        (d("2022-01-01"), 1002, 3000, 0),
        (d("2022-01-02"), 0, 0, 1500),
    ]
