"""Agent reports on a micro table, against a day-by-day count in Python."""

import datetime as dt
import itertools
import random

import pytest

from orderlens.operators import agents as A
from tests.conftest import d, rows

SCHEMA = (
    "order_item_id string, company string, sale_channel_id string, date_created date, date_updated date, "
    "policy_order_status string, is_automatic_deduction int, channel_1 string, channel_2 string, channel_3 string"
)
START, END = dt.date(2022, 1, 5), dt.date(2022, 2, 20)


@pytest.fixture(scope="module")
def data():
    """A third of the orders belongs to one agent, others have none."""
    pick = random.Random(7)
    found = []
    for i in range(400):
        agent = "hot" if i % 3 == 0 else pick.choice([None, "a1", "a2", "a3", "a4"])
        made = dt.date(2022, 1, 1) + dt.timedelta(days=pick.randrange(50))
        back = made + dt.timedelta(days=pick.randrange(20))
        status = pick.choice(["00", "00", "04", "05", None])
        found.append((str(i), pick.choice(["A", "A", "B"]), agent, made, back, status, i % 5 == 0 and 1 or 0, "n1", "b", "s"))
    return found


@pytest.fixture(scope="module")
def days(spark, data):
    return A.agent_days(spark.createDataFrame(data, SCHEMA))


@pytest.fixture(scope="module")
def registry(spark):
    agents = [
        ("A", "n1", "b", "x1", "a1", d("2022-01-01")),
        ("A", "n1", "b", "x2", "a2", d("2022-01-20")),
        ("A", "n1", "b", "x3", "hot", d("2022-01-05")),
        ("A", "n1", "b", "x4", "idle", d("2022-02-01")),
        ("B", "n2", "b", "x5", "a3", d("2021-12-01")),
    ]
    return spark.createDataFrame(
        agents, "company string, channel_1 string, channel_2 string, channel_3 string, channel_id string, registered date"
    )


def cumulative(data, company, day):
    made = [r for r in data if r[1] == company and r[3] <= day]
    back = [r for r in data if r[1] == company and r[5] in ("04", "05") and r[4] <= day]
    return len(made), len(back), len({r[2] for r in made})


def spine(data):
    for offset, company in itertools.product(range((END - START).days + 1), ("A", "B")):
        day = START + dt.timedelta(days=offset)
        if any(r[1] == company and r[3] == day for r in data):
            yield company, day


def test_cumulative_counts_day_by_day(days, data):
    expected = [(c, day, *cumulative(data, c, day)) for c, day in spine(data)]
    found = rows(A.agent_cumulative(days, START, END), "company", "date", "cum_orders", "cum_refunds", "cum_agents")
    assert found == sorted(expected)


def test_daily_counts(days, data):
    expected = []
    for company, day in spine(data):
        made = [r for r in data if r[1] == company and r[3] == day]
        back = [r for r in data if r[1] == company and r[4] == day and r[5] in ("04", "05")]
        expected.append((company, day, len(made), len(back), len({r[2] for r in made})))
    assert rows(A.agent_daily(days, START, END), "company", "date", "orders", "refunds", "agents") == sorted(expected)


def test_last_day_holds_everything(days, data):
    last = rows(A.agent_cumulative(days), "company", "date", "cum_orders")[-1]
    assert last[2] == sum(r[1] == "B" for r in data)


def test_calendar_has_every_day(days, data):
    found = {(r.company, r.date): r for r in A.agent_calendar(days, START, END).collect()}
    every = [START + dt.timedelta(days=n) for n in range((END - START).days + 1)]
    assert sorted(found) == sorted((c, day) for c in ("A", "B") for day in every)
    for (company, day), row in found.items():
        own = [o for o in data if o[1] == company]
        so_far = [o for o in own if o[3] <= day]
        assert row.orders == sum(o[3] == day for o in own)
        assert row.refunds == sum(o[4] == day for o in own if o[5] in ("04", "05"))
        assert (row.cum_orders, row.cum_agents) == (len(so_far), len({o[2] for o in so_far}))
        assert row.cum_refunds == sum(o[4] <= day for o in own if o[5] in ("04", "05"))


def test_calendar_bounds(spark):
    made = [("1", "A", "a1", d("2022-01-03"), None, "00", 0, "n", "b", "s"), ("2", "A", None, d("2022-01-06"), d("2022-01-08"), "04", 0, "n", "b", "s")]
    days = A.agent_days(spark.createDataFrame(made, SCHEMA))
    own = rows(A.agent_calendar(days), "date", "orders", "cum_orders", "cum_agents", "cum_avg_orders")
    assert [r[0].day for r in own] == [3, 4, 5, 6, 7, 8]
    assert [r[2:] for r in own] == [(1, 1, 1.0)] * 3 + [(2, 2, 1.0)] * 3
    early = rows(A.agent_calendar(days, "2022-01-01", "2022-01-03"), "orders", "cum_orders", "cum_avg_orders")
    assert early == [(0, 0, None), (0, 0, None), (1, 1, 1.0)]
    assert A.agent_calendar(days, "2022-02-01", "2022-01-01").count() == 0
    assert A.agent_calendar(days.filter("false")).count() == 0


def test_milestones(days, data):
    found = rows(A.agent_milestones(days, START, END), "company", "milestone", "cutoff", "cum_orders", "cum_refunds", "cum_agents")
    points = A.milestones(START, END, True)
    assert dict(points)["前30天"] == START + dt.timedelta(days=31)
    expected = [(c, name, day, *cumulative(data, c, day)) for c in "AB" for name, day in points]
    assert found == sorted(expected)
    assert [name for name, _ in A.milestones(START, END, False)][-1] == "投保期全长"
    assert len(A.milestones(START, END, False)) == 6


def test_milestone_without_orders_has_no_row(spark):
    one = [("1", "A", "a", d("2022-03-01"), None, "00", 0, "n", "b", "s")]
    days = A.agent_days(spark.createDataFrame(one, SCHEMA))
    found = rows(A.agent_milestones(days, d("2022-01-01"), d("2022-03-02"), ended=False), "milestone")
    assert found == [("投保期全长",)]


@pytest.mark.parametrize("end", [END, None])
@pytest.mark.parametrize("fixed", [None, 3.0])
def test_registered_and_below_average(days, data, registry, end, fixed):
    agents = [tuple(r) for r in registry.collect()]
    report = A.agent_registered(days, registry, START, end, fixed_average=fixed)
    for row in report.collect():
        orders, _, producing = cumulative(data, row.company, row.date)
        known = [a for a in agents if a[0] == row.company and a[5] <= row.date]
        average = row.cum_avg_orders if fixed is None else fixed
        reaching = [
            a for a in known
            if (n := sum(r[1] == row.company and r[2] == a[4] and r[3] <= row.date for r in data)) >= average and n
        ]
        assert row.cum_orders == orders and row.cum_agents == producing
        assert row.cum_registered == len(known)
        assert row.registered == sum(a[5] == row.date for a in known)
        assert row.below_average == len(known) - len(reaching), row


def test_agents_below_average(days, data, registry):
    found = rows(A.agents_below_average(days, registry, END), "company", "channel_id", "orders")
    expected = []
    for company, ids in (("A", ["a1", "a2", "hot", "idle"]), ("B", ["a3"])):
        total = sum(r[1] == company and r[3] <= END for r in data)
        for agent in ids:
            n = sum(r[1] == company and r[2] == agent and r[3] <= END for r in data)
            if n < round(total / len(ids), 1):
                expected.append((company, agent, n))
    assert found == sorted(expected)
    fixed = rows(A.agents_below_average(days, registry, END, fixed_average=1.0), "channel_id")
    assert fixed == [("idle",)]


def test_own_purchases_leave_out_deductions(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    every = A.agent_days(df).agg({"orders": "sum"}).first()[0]
    own = A.agent_days(df, own_purchases=True).agg({"orders": "sum"}).first()[0]
    assert every - own == sum(r[6] == 1 for r in data)


def test_order_rate(spark):
    data = [
        ("1", "A", "a1", d("2022-01-01"), None, "00", 0, "n1", "b", "s1"),
        ("1", "A", "a1", d("2022-01-01"), None, "00", 0, "n1", "b", "s1"),
        ("2", "A", "a1", d("2022-01-01"), None, "04", 0, "n1", "b", "s1"),
        ("3", "A", "a2", d("2022-01-01"), None, "00", 0, "展e保", "b", "s2"),
        ("4", "A", "a3", d("2022-01-01"), None, None, 0, None, None, None),
    ]
    channels = spark.createDataFrame(
        [("a1", "n1", "b", "s1", d("2022-01-01")), ("a9", "n1", "b", "s9", d("2022-01-01")), ("late", "n1", "b", "x", d("2023-01-01"))],
        "channel_id string, channel_1 string, channel_2 string, channel_3 string, registered date",
    )
    companies = spark.createDataFrame([("n1", "A")], "channel_1 string, company string")
    found = rows(A.agent_order_rate(spark.createDataFrame(data, SCHEMA), channels, companies, d("2022-01-01"), d("2022-01-11")))
    assert found == [
        ("A", "n1", "b", "s1", 1, 0.1),
        ("A", "n1", "b", "s9", 0, 0.0),
        ("Unmatched", None, None, None, 1, 0.1),
        ("Unmatched", "展e保", "b", "s2", 1, 0.1),
    ]


def test_registry_and_company_order(spark, data):
    channels = spark.createDataFrame(
        [("a1", "n1", "b", "s", d("2022-01-01")), ("a2", "n1", "b", "b", d("2022-01-01")), ("a3", "nx", "b", "s", d("2022-01-01"))],
        "channel_id string, channel_1 string, channel_2 string, channel_3 string, registered date",
    )
    companies = spark.createDataFrame([("n1", "A")], "channel_1 string, company string")
    assert rows(A.agent_registry(channels, companies), "company", "channel_id") == [("A", "a1")]
    orders = spark.createDataFrame(data, SCHEMA)
    A.check_company_order(orders, ["B", "A"])
    for wrong in (["A"], ["A", "B", "C"]):
        with pytest.raises(ValueError):
            A.check_company_order(orders, wrong)
