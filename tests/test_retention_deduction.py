"""Rebuying, renewals, the funnel and the exclusion list on micro tables."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import deduction as D
from orderlens.operators import exclusion as X
from orderlens.operators import retention as T
from tests.conftest import d, rows

ORDERS = (
    "order_item_id string, date_created date, date_updated date, policy_order_status string, company string, "
    "channel_1 string, channel_2 string, channel_3 string, name string, id_type string, id_no string, "
    "birthday date, sex string"
)


def order(number, day, status, company, name, channel="x", updated=None):
    return (str(number), d(day), d(updated or day), status, company, "c1", "c2", channel, name, None, "i", None, None)


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        order(1, "2022-01-01", "04", "A", "zhao", "x", "2022-01-06"),
        order(2, "2022-01-02", "04", "B", "zhao", "y"),
        order(3, "2022-01-01", "00", "B", "zhao", "y"),
        order(4, "2022-01-05", None, "C", "zhao", "z"),
        order(5, "2022-01-05", "00", "A", "zhao", "x"),
        order(6, "2022-01-07", "04", "C", "qian", "z"),
        order(7, "2022-01-06", "00", "A", "qian", "x"),
        order(8, "2022-01-08", "00", "A", "qian", "x"),
        order(9, "2022-01-08", "00", None, "qian", None),
    ]
    return spark.createDataFrame(data, ORDERS)


def test_lured_refunds_between_companies(orders):
    # zhao's first refund (A) leads to B and C, qian's (C) to the later order with A.
    found = rows(T.lured_refunds_company(orders))
    assert found == [
        ("A", 4, 1, 0.25, 1, 2, 2.0),
        ("B", 2, 1, 0.5, None, None, None),
        ("C", 2, 1, 0.5, 1, 1, 1.0),
    ]


def test_refund_time_can_be_the_update(orders):
    found = rows(T.lured_refunds_company(orders, refund_time="updated"), "company", "lured_orders", "lured_refunds")
    assert found == [("A", 1, None), ("C", None, 1)]


def test_lured_channels_keep_those_on_both_sides(orders):
    found = rows(T.lured_refunds_channel(orders), "company", "channel_3", "total_orders", "lured_orders", "lured_orders_share")
    assert found == [("A", "x", 4, 1, 0.25), ("C", "z", 2, 1, 0.5)]


def test_person_key_writes_absent_parts(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(T.person_key(F.col("x"), F.col("y"))).first()[0] == "a_NA"


YEARS = (("2021-01-01", "2021-12-31"), ("2022-01-01", "2022-12-31"))
PEOPLE = (
    "order_item_id string, date_created date, group string, company string, id_no string, policy_order_status string, "
    "automatic_deduction int, is_automatic_deduction int, medical_insure_flag int, payway string"
)


def person(number, company, id_no, status="00", signed=1, deducted=0, medical=0, payway="微信"):
    return (str(number), company, id_no, status, signed, deducted, medical, payway)


def both_years(spark, old_self=(), old_com=(), new_self=(), new_com=()):
    """One table of orders, with two that lie in neither year."""
    sides = (("2021-12-31", "self", old_self), ("2021-01-01", "com", old_com), ("2022-01-01", "self", new_self), ("2022-12-31", "com", new_com))
    outside = [("2020-12-31", "self", [person(90, "A", "p2")]), ("2023-01-01", "self", [person(91, "Z", "p1")])]
    data = [(n, d(day), kind, *rest) for day, kind, orders in (*sides, *outside) for n, *rest in orders]
    return spark.createDataFrame(data, PEOPLE)


def test_renewals(spark):
    orders = both_years(
        spark,
        old_self=[person(1, "A", "p1"), person(2, "A", "p2"), person(3, None, None), person(4, "B", "p4")],
        new_self=[person(5, "A", "p1", "04"), person(6, "A", "p2"), person(7, "A", None)],
        new_com=[person(8, "A", "p4", "05"), person(9, "B", "p9")],
    )
    states = T.person_years(orders, *YEARS)
    assert rows(T.renewals(states, "old", "self"), "company", "is_total", "orders", "renewed", "rate") == [
        (None, 0, 1, 1, 1.0), (None, 1, 4, 2, 0.5), ("A", 0, 2, 1, 0.5), ("B", 0, 1, 0, 0.0),
    ]
    assert rows(T.renewals(states, "new", "self"), "company", "is_total", "orders", "renewed") == [(None, 1, 2, 2), ("A", 0, 2, 2)]
    assert rows(T.merged_renewals(states, "new"), "company", "is_total", "self_orders", "self_rate", "com_orders", "com_rate") == [
        (None, 1, 2, 1.0, 1, 0.0), ("A", 0, 2, 1.0, 0, 0.0), ("B", 0, 0, 0.0, 1, 0.0),
    ]
    assert rows(T.merged_renewals(states, "new", zeros=False), "company", "is_total", "self_orders", "com_orders", "com_rate") == [
        (None, 1, 2, 1, 0.0), ("A", 0, 2, None, None), ("B", 0, None, 1, 0.0),
    ]
    assert T.renewals(T.person_years(both_years(spark).filter("false"), *YEARS), "old", "self").filter("is_total = 0").count() == 0


def test_member_flag(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(T.member_flag(df, keys, "k", "hit")) == [(None, 1), ("a", 1), ("b", 0)]


def test_auto_deduct_remaining(spark):
    old = [
        person(1, "A", "com"), person(2, "A", "self"), person(3, "A", "both"), person(4, "A", "ad"),
        person(5, "A", "back"), person(6, "A", "left1"), person(7, "A", "left2", medical=1),
        person(8, "A", "left3", medical=1, payway="医保个账"), person(9, "A", "unsigned", signed=0),
    ]
    new_self = [
        person(11, "A", "self"), person(12, "A", "both"), person(13, "A", "ad", deducted=1),
        person(14, "A", "back", "04", deducted=1), person(15, "A", "left1", "04"),
        # The id of a deducted order counts as no own purchase, whoever else it names.
        person(13, "A", "left2"),
    ]
    orders = both_years(spark, old_self=old, new_self=new_self, new_com=[person(21, "A", "com"), person(22, "A", "both")])
    states = T.deduction_states(orders, *YEARS, by_payment=True)
    found = T.auto_deduct_remaining(states, by_payment=True).filter("is_total = 1").first().asDict()
    del found["company"], found["is_total"]
    assert found == {
        "signed": 8, "bought_com": 2, "bought_self": 1, "deducted": 1, "deducted_refunded": 1,
        "left_own_money": 1, "left_medical_failed": 1, "left_medical_paid": 1,
        "remaining": 3, "remaining_share": 0.375,
    }
    plain = T.auto_deduct_remaining(T.deduction_states(orders, *YEARS)).filter("is_total = 1").first()
    assert (plain["signed"], plain["remaining"]) == (8, 3)


def test_hot_person_counts_once_per_company(spark):
    """A third of the old orders belongs to one person, another third to nobody known."""
    data = [person(i, "A", "hot" if i % 3 == 0 else None if i % 3 == 1 else f"p{i}") for i in range(900)]
    orders = both_years(spark, old_self=data, new_self=[person(1, "A", "hot")], new_com=[person(2, "A", "q")])
    found = rows(T.renewals(T.person_years(orders, *YEARS), "old", "self"), "is_total", "orders", "renewed")
    assert found == [(0, 900, 300), (1, 900, 300)]


# Deduction ----------------------------------------------------------------


@pytest.fixture(scope="module")
def tasks(spark):
    config = spark.createDataFrame(
        [(1, "徐州一", "n1", "s1"), (2, "徐州测试", "n2", "s2"), (3, "昆明", "n3", "s3"), (4, None, None, None)],
        "id int, project_name string, advance_deduction_notice_time string, start_deduction_time string",
    )
    return config


def test_tasks(tasks):
    assert rows(D.deduction_tasks(tasks, city="徐州"), "id") == [(1,)]
    assert rows(D.deduction_tasks(tasks, ids=["1", "3"]), "id") == [(1,), (3,)]
    with pytest.raises(ValueError):
        D.deduction_tasks(tasks)


def test_funnel(spark, tasks):
    totals = spark.createDataFrame(
        [(1, 30, 60), (1, 10, 40), (3, 1, 0)],
        "auto_deduction_base_config_id int, deduction_pay_success_total int, send_msg_total int",
    )
    exceptions = spark.createDataFrame(
        [(f"o{i}", 1, step, text) for i, (step, text) in enumerate([
            (1, "商户号错误"), (1, "白名单"), (2, "有重复下单"), (2, "有重复下单"), (3, "有重复下单"),
            (4, "未成功签约"), (4, "签约协议不存在，请检查传入的签约协议是否正确"), (4, "当前用户账户已被限制交易"),
            (4, "银行维护"), (4, "用户银行卡暂不可用"), (4, "交易金额或次数超出限制，请检查后再试"),
        ])] + [("o0", 1, 1, "商户号错误"), ("z", 2, 1, "白名单")],
        "order_item_id string, auto_deduction_base_id int, step int, exception_describe string",
    )
    chosen = D.deduction_tasks(tasks, ids=["1", "3"])
    stages = D.deduction_stage_counts(totals, exceptions, chosen)
    assert (1, "Step 1：数据清洗", "签约关系不存在-商户号错误", 1) in rows(stages)
    funnel = D.deduction_funnel(stages, chosen)
    value = {r.line: r.value for r in funnel.filter("task_id = 1").collect()}
    assert value[1] == 1 and value[2] == 101 and value[3] == 1 and value[5] == 2 and value[7] == 1
    assert value[8] == 97 and value[12] == 40
    assert [value[i] for i in range(13, 18)] == [1, 2, 1, 1, 1]
    # [6] is the sum of [7] to [13].
    assert value[8] == sum(value[i] for i in range(12, 19))
    assert value[9] == 97 / 101 and value[21] == 2 / 97
    times = {r.item: r.time for r in funnel.filter("task_id = 1 and time is not null").collect()}
    assert times == {"消息发送时间": "n1", "发起扣费时间": "s1"}
    # Task 3 has no base: rates over zero stay unknown.
    assert rows(funnel.filter("task_id = 3 and line = 9"), "value") == [(None,)]
    wide = D.funnel_wide(funnel, [1, 3])
    assert wide.columns == ["line", "section", "item", "1", "3"] and wide.count() == 21


# Exclusion ----------------------------------------------------------------

SIGNED = (
    "sku_code string, company string, date_created date, automatic_deduction int, order_item_id string, open_id string, "
    "customer_id string, applicant_id_no string, name string, id_type string, id_no string, sex string, birthday string"
)
FIELDS = ("ad_group", "order_item_id", "open_id", "customer_id", "applicant_id_no", "name", "id_type", "id_no", "sex", "birthday")


@pytest.fixture(scope="module")
def signed(spark):
    def one(number, sku, open_id, customer, name, id_no, deduct=1, applicant="ap"):
        return (sku, "A", d("2022-01-01"), deduct, str(number), open_id, customer, applicant, name, "t", id_no, "男", "1990-01-02")

    data = [
        one(1, "s1", "w1", "k1", "n1", "i1"), one(2, "s1", "w1", "k1", "n2", "i2"), one(3, "s1", "w1", "k2", "n3", "i3"),
        one(4, "s2", "w1", "k1", "n4", "i4"), one(5, "s2", "", "k5", "n5", "i5", applicant="ill"),
        one(6, "s1", "", "k5", "n6", "i6"), one(7, "s3", "w7", "k7", "n7", "i7"), one(8, "s1", None, "k8", "n8", None),
        one(9, "s1", "w9", "k9", "n9", "i9", deduct=0), one(10, "s2", "w10", "k10", "n1", "i1"),
    ]
    rules = [X.BatchRule("one", skus=["s1"]), X.BatchRule("two", skus=["s2"], first_day="2022-01-01")]
    return X.signed_orders(X.assign_batches(spark.createDataFrame(data, SIGNED), rules), FIELDS)


def numbers(df):
    return sorted(int(r[0]) for r in df.select("order_item_id").collect())


def test_batches(spark, signed):
    assert numbers(signed) == [1, 2, 3, 4, 5, 6, 8, 10]
    early = X.BatchRule("x", companies=["A"], last_day="2021-12-31")
    assert X.assign_batches(spark.createDataFrame([], SIGNED), [early]).count() == 0


def test_single_rules(spark, signed):
    listed = spark.createDataFrame([("i2",), (None,)], "id_no string")
    assert numbers(X.caught(signed, X.listed_people(listed))) == [2, 8]
    assert numbers(X.caught(signed, X.over_limit(signed, 2))) == [1, 2, 3]
    # Order 4 shares w1 with another batch; the empty open ids do not match their account k5.
    assert numbers(X.caught(signed, X.same_day_accounts(signed))) == [1, 2, 3, 4]
    assert numbers(X.caught(signed, X.multiple_ids(signed, "open_id", "customer_id"))) == [1, 2, 3, 4]
    assert numbers(X.caught(signed, X.multiple_ids(signed, "customer_id", "open_id"))) == []
    attempts = spark.createDataFrame(
        [("4", "t1", "31"), ("5", "t1", "40"), ("6", "t2", "41")],
        "old_order_item_id string, auto_deduction_base_config_id string, deal_status string",
    )
    assert numbers(X.caught(signed, X.failed_attempts(attempts, ["t1"]))) == [4]
    sick = spark.createDataFrame([("ill",)], "id_no string")
    assert numbers(X.caught(signed, X.listed_applicants(sick))) == [5]


def test_list_takes_in_all_orders_of_a_person(spark, signed):
    listed = spark.createDataFrame([("i6",)], "id_no string")
    rules = {"listed": X.listed_people(listed), "over": X.over_limit(signed, 2)}
    found = X.exclusion_list(signed, rules)
    # Order 10 is the same person as order 1.
    assert rows(found.withColumn("n", F.col("order_item_id").cast("int")), "n", "listed", "over") == [
        (1, 0, 1), (2, 0, 1), (3, 0, 1), (6, 1, 0), (10, 0, 1),
    ]
    assert rows(X.exclusion_sheet(found.filter("order_item_id = 6"))) == [("n6", "t", "i6", "男", "19900102")]
    assert X.people_without_key(signed).first()[0] == 1


def test_hot_account_is_found_without_gathering_it(spark):
    """A third of the orders has no open id, another third shares one account."""
    data = [
        ("s1", "A", d("2022-01-01"), 1, str(i), "w" if i % 3 == 0 else None if i % 3 == 1 else f"w{i}",
         "k", "ap", f"n{i}", "t", f"i{i}", "男", "1990-01-02")
        for i in range(900)
    ]
    signed = X.signed_orders(X.assign_batches(spark.createDataFrame(data, SIGNED), [X.BatchRule("one")]), FIELDS)
    assert X.caught(signed, X.over_limit(signed, 5)).count() == 600
