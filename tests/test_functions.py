"""Null rules, rounding, dates, people and labels on hand-written values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import labels as L
from orderlens.functions import people as P
from orderlens.functions.dates import compact_date, parse_timestamp, week_block, week_label, week_start
from orderlens.functions.lookup import is_small, lookup_join
from orderlens.functions.nulls import (
    count_distinct_na,
    flag,
    is_in,
    na_text,
    not_in,
    null_safe,
    sum_na,
)
from orderlens.functions.numbers import percent_text, ratio, round_even, share
from tests.conftest import d, rows


def values(spark, schema, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_membership_never_unknown(spark):
    data = [("04",), ("00",), (None,)]
    found = values(
        spark, "s string", data, is_in(F.col("s"), ["04"]), not_in(F.col("s"), ["04"]), flag(F.col("s") == "04")
    )
    assert found == [(True, False, 1), (False, True, 0), (False, True, 0)]


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("b", 0)], "u string, o int")
    assert df.agg(count_distinct_na(F.col("u"))).first()[0] == 3
    assert df.agg(count_distinct_na(F.col("u"), F.col("o") == 1)).first()[0] == 2
    assert df.limit(0).agg(count_distinct_na(F.col("u"))).first()[0] == 0


def test_sum_na(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("y", None)], "k string, v int")
    assert rows(df.groupBy("k").agg(sum_na(F.col("v")).alias("s"))) == [("x", 3), ("y", None)]


def test_null_matches_null(spark):
    left = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([(None,), ("a",)], "k string")
    assert rows(left.join(right, null_safe(left, right, ["k"]), "left_semi")) == [(None,), ("a",)]
    assert rows(left.join(right, null_safe(left, right, ["k"]), "left_anti")) == [("b",)]


def test_na_text(spark):
    assert values(spark, "s string", [("x",), (None,)], na_text(F.col("s"))) == [("x",), ("NA",)]


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (0.125, 2, 0.12),
        (0.375, 2, 0.38),
        (0.15, 1, 0.1),
        (0.25, 1, 0.2),
        (0.35, 1, 0.3),
        (0.45, 1, 0.4),
        (2.5, 0, 2.0),
        (3.5, 0, 4.0),
        (2.665, 2, 2.66),
        (2.675, 2, 2.67),
        (2.68, 1, 2.7),
        (-0.125, 2, -0.12),
        (-2.4, 0, -2.0),
        (-0.0001, 2, 0.0),
        (12.0, 1, 12.0),
        (None, 2, None),
    ],
)
def test_round_even(spark, value, digits, expected):
    assert values(spark, "v double", [(value,)], round_even(F.col("v"), digits)) == [(expected,)]


def test_ratio_of_zero_is_unknown(spark):
    found = values(
        spark, "a int, b int", [(1, 0), (0, 0), (1, 3)], ratio(F.col("a"), F.col("b")), share(F.col("a"), F.col("b"), 3)
    )
    assert found == [(None, None), (None, None), (1 / 3, 0.333)]


def test_percent_text(spark):
    assert values(spark, "v double", [(0.123,), (None,)], percent_text(F.col("v")))[0] == ("12.3%",)


def test_weeks_are_seven_day_blocks(spark):
    days = ["2022-01-01", "2022-01-07", "2022-01-08", "2022-12-31", "2020-12-31"]
    found = values(
        spark, "d date", [(d(x),) for x in days], week_block(F.col("d")), week_label(F.col("d")), week_start(F.col("d"))
    )
    assert found == [
        (1, "2022_1", d("2022-01-01")),
        (1, "2022_1", d("2022-01-01")),
        (2, "2022_2", d("2022-01-08")),
        (53, "2022_53", d("2022-12-31")),
        (53, "2020_53", d("2020-12-30")),
    ]


def test_timestamp_with_zone_name(spark):
    data = [("2022-01-02 03:04:05 CST",), ("2022-01-02 03:04:05",), ("bad",)]
    found = values(spark, "t string", data, parse_timestamp(F.col("t")))
    stamp = dt.datetime(2022, 1, 2, 3, 4, 5)
    assert found == [(stamp,), (stamp,), (None,)]


def test_compact_date(spark):
    assert values(spark, "t string", [("2022-01-02",)], compact_date(F.col("t"))) == [("20220102",)]


def test_sex_from_id(spark):
    data = [
        ("F", "x"),
        ("W", "x"),
        (None, "440101199001010018"),
        (None, "440101199001010028"),
        (None, "4401011990010100X8"),
        (None, "4401"),
        (None, None),
    ]
    found = values(spark, "sex string, id string", data, P.sex_from_id(F.col("sex"), F.col("id")))
    assert [v for (v,) in found] == ["男", "女", "男", "女", "女", None, None]


def test_birthday_from_id(spark):
    data = [
        ("", "440101199002030018"),
        ("", "440101199913990018"),
        ("", "4401"),
        ("1980-05-06", "440101199002030018"),
        (None, "440101199002030018"),
    ]
    found = values(spark, "b string, id string", data, P.birthday_from_id(F.col("b"), F.col("id")))
    assert [v for (v,) in found] == [d("1990-02-03"), None, None, d("1980-05-06"), None]


def test_age_bands_at_their_edges(spark):
    days = [-5, 0, 364, 365, 729, 730, 36499, 36500, 36501, None]
    start = P.age_band_start(F.col("n"), 1)
    found = values(spark, "n int", [(n,) for n in days], P.age_band_label(start, 1))
    assert [v for (v,) in found] == [
        "0", "0", "0", "1-1", "1-1", "2-2", "99-99", "100-100", ">100", None,
    ]


def test_last_age_band_closes_at_100(spark):
    days = [365, 30 * 365, 31 * 365, 91 * 365, 36500]
    start = P.age_band_start(F.col("n"), 30)
    found = values(spark, "n int", [(n,) for n in days], P.age_band_label(start, 30))
    assert [v for (v,) in found] == ["1-30", "1-30", "31-60", "91-100", "91-100"]


def test_signs(spark):
    data = [("2021-01-20", "摩羯座"), ("2021-01-21", "水瓶座"), ("2021-02-19", "水瓶座"), ("2021-02-20", "双鱼座"),
            ("2021-12-22", "射手座"), ("2021-12-23", "摩羯座"), (None, "摩羯座")]
    found = values(spark, "b date", [(d(b),) for b, _ in data], P.star_sign(F.col("b")))
    assert [v for (v,) in found] == [sign for _, sign in data]
    found = values(
        spark, "b date", [(d("2020-05-05"),), (d("2021-05-05"),), (d("1992-05-05"),), (None,)], P.zodiac(F.col("b"))
    )
    assert [v for (v,) in found] == ["属鼠", "属牛", "属猴", None]


def test_birth_month_day(spark):
    data = [
        ("身份证", "440101199002030018", d("1980-05-06")),
        ("身份证", "440101900203001", d("1980-05-06")),
        ("护照", "440101199002030018", d("1980-05-06")),
        ("身份证", None, d("1980-05-06")),
    ]
    found = values(
        spark, "t string, id string, b date", data, P.birth_month_day(F.col("t"), F.col("id"), F.col("b"))
    )
    assert [v for (v,) in found] == ["02-03", "02-03", "05-06", "05-06"]


def test_refund_reasons_first_match_wins(spark):
    data = {
        "用户发起退款": "用户发起",
        "名字错误": "信息输入错误",
        "没有社保": "没有本地医保，无法购买",
        "不知道买了什么": "看不懂产品内容，不喜欢",
        "买了穗岁康": "别家的产品更适合我",
        "人在国外": "其他",
        "老人已经走了": "被保险人去世",
        "随便": "其他",
        "错误，已去世": "信息输入错误",
        None: None,
    }
    found = values(spark, "r string", [(r,) for r in data], L.refund_reason(F.col("r")))
    assert [v for (v,) in found] == list(data.values())


def test_deduction_kinds(spark):
    data = [
        (1, "商户号错误", "签约关系不存在-商户号错误"),
        (2, "商户号错误", "商户号错误"),
        (4, "当前用户账户已被限制交易", "账号异常/冻结"),
        (4, "当前银行卡有安全设置无法完成支付，如有疑问，请联系银行确认", "账号异常/冻结"),
        (4, "可用额度不足，请使用零钱或其他银行卡支付", "余额不足/卡号冻结等支付方式异常"),
        (4, "某某银行出错", "余额不足/卡号冻结等支付方式异常"),
        (3, "某某银行出错", "某某银行出错"),
        (4, "交易金额或次数超出限制，请检查后再试", "交易金额或次数超出限制"),
        (4, "签约协议不存在，请检查传入的签约协议是否正确", "解绑自动扣费-签约协议不存在"),
        (4, "未成功签约", "未成功签约"),
    ]
    found = values(
        spark, "s int, m string", [row[:2] for row in data], L.deduction_kind(F.col("s"), F.col("m"))
    )
    assert [v for (v,) in found] == [kind for *_, kind in data]


def test_lookup_join_above_and_below_the_bound(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "x"), ("c", "y")], "k string, name string")
    assert is_small(lookup, 2) and not is_small(lookup, 1)
    expected = [(None, 3, None), ("a", 1, "x"), ("b", 2, None)]
    for bound in (1, 2):
        assert rows(lookup_join(fact, lookup, "k", max_rows=bound)) == expected
