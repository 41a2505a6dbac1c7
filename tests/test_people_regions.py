"""Age, facts, regions and shares on micro tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators import demography as P
from orderlens.operators import regions as R
from orderlens.operators import summary as S
from tests.conftest import d, rows

SCHEMA = (
    "order_item_id string, date_created date, date_updated date, policy_order_status string, `group` string, "
    "company string, name string, id_type string, id_no string, sex string, birthday date, relation_ship string, "
    "customer_id string, payway string, payment_amount int, channel_1 string, medical_insure_flag int"
)
ID = "身份证"
DATA = [
    ("1", d("2022-01-01"), d("2022-01-01"), "00", "self", "A", "赵一", ID, "440101199001010018", "男",
     d("1990-01-01"), "本人", "c1", "微信", 1900, "北区一", 1),
    ("2", d("2022-01-01"), d("2022-01-09"), "04", "self", "A", "赵二", ID, "440101200001010018", "男",
     d("2000-01-01"), "本人", "c1", "微信", 1900, "北区一", 0),
    ("3", d("2022-01-08"), d("2022-01-08"), None, "com", "线上平台", "钱三", "护照", "990101", "女",
     None, None, "c2", None, 3800, "南区", 0),
    ("4", d("2022-01-08"), d("2022-01-08"), "00", "self", None, None, "港澳居民来往内地通行证", None, None,
     d("1920-01-01"), "子女", "c2", "医保个账", 3800, None, 0),
    ("5", d("2022-02-01"), d("2022-02-01"), "00", "self", "B", "孙五", ID, "440201202202010011", "女",
     d("2022-02-01"), None, "c3", "支付宝", 1900, "北区二", 0),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(DATA, SCHEMA)


@pytest.fixture(scope="module")
def codes(spark):
    lists = spark.createDataFrame([("东", "4401"), ("西", "4402, 9901")], "region string, codes string")
    return R.region_codes(lists)


def test_region_codes_are_split(codes):
    assert rows(codes) == [("东", "4401"), ("西", "4402"), ("西", "9901")]


def test_age_sex(orders):
    found = rows(P.age_sex(orders), "is_total", "age_band", "people", "men", "women", "band_share")
    assert found == [
        (0, None, 1, 0, 1, 0.25),
        (0, "0", 1, 0, 1, 0.25),
        (0, "32-32", 1, 1, 0, 0.25),
        (0, ">100", 1, 0, 0, 0.25),
        (1, None, 4, 1, 2, 1.0),
    ]


def test_age_sex_per_company_and_with_refunds(orders):
    found = rows(P.age_sex(orders, gap=10, by="company", drop_refunds=False), "company", "is_total", "age_band", "people")
    assert ("A", 0, "21-30", 1) in found and ("A", 1, None, 2) in found
    assert ("NA", 0, ">100", 1) in found and ("NA", 1, None, 1) in found


def test_fact_sheet(orders):
    facts = {
        r.label: (r.people, r.share)
        for r in P.fact_sheet(orders, start="2022-01-01", end="2022-12-31", with_medical=True).collect()
    }
    assert facts["净投保量"] == (4, 1.0)
    assert facts["个人净投保量"] == (3, 0.75)
    assert facts["企业净投保量"] == (1, 0.25)
    assert facts["线上平台"] == (1, 0.25)
    assert facts["线下保司"] == (3, 0.75)
    assert facts["男性"] == (1, 0.25)
    assert facts["女性"] == (2, 0.5)
    # The launch day is 1 January; bought on the birthday: orders 1 and 5.
    assert facts["和项目同一天生日"] == (2, 0.5)
    assert facts["生日当天购买"] == (2, 0.5)
    assert facts["港澳台同胞"] == (1, 0.25)
    assert facts["国际友人"] == (1, 0.25)
    assert facts["0岁"] == (1, 0.25)
    assert facts["21-40岁"] == (1, 0.25)
    assert facts[">100岁"] == (1, 0.25)
    assert facts["80岁及以上"] == (1, 0.25)
    assert facts["预约医保个张扣缴"] == (1, 0.25)


def test_launch_day_defaults_to_the_first_day(orders):
    def launch(**options):
        facts = P.fact_sheet(orders, **options).filter(F.col("label") == "和项目同一天生日")
        return facts.first().people

    assert launch() == 2
    assert launch(launch="2022-02-01") == 1


def test_signs_show_empty_classes_and_ties(orders):
    signs = rows(P.star_sign_counts(orders), "people", "label", "share")
    assert len(signs) == 12
    assert [row for row in signs if row[0]] == [(1, "水瓶座", 0.25), (3, "摩羯座", 0.75)]
    assert len(P.zodiac_counts(orders, top=1).collect()) == 3


def test_payment(orders):
    methods = P.payment_method_share(orders)
    assert rows(methods) == [
        (None, 1, 0.25), ("医保个账支付", 1, 0.25), ("微信支付", 1, 0.25), ("支付宝支付", 1, 0.25),
    ]
    assert rows(S.payment_summary(methods)) == [(2, 1, 1)]


def test_relationship(orders):
    assert rows(P.relationship_share(orders)) == [("为家人投保", 0.333), ("为自己投保", 0.333)]
    assert rows(P.relationship_share(orders, by_relation=False)) == [("为家人投保", 0.333), ("为自己投保", 0.667)]


def test_youngest_and_oldest(orders):
    found = {r.label: r.text for r in P.youngest_oldest(orders).collect()}
    assert found == {
        "年龄最小参保人": "参保年龄：出生第0天；出生日期：2022-02-01；性别：女性",
        "年龄最大参保人": "参保年龄：102岁；出生日期：1920-01-01；性别：NA",
    }


def test_surnames(orders):
    assert rows(P.surname_counts(orders)) == [(None, 1, 0.25), ("孙", 1, 0.25), ("赵", 1, 0.25), ("钱", 1, 0.25)]


def test_hours_take_the_earliest_date_on_ties(spark):
    stamps = ["2022-01-01 09:10:00", "2022-01-01 09:50:00", "2022-01-02 09:00:00", "2022-01-03 09:00:00",
              "2022-01-04 09:00:00", "2022-01-04 09:30:00", "2022-01-01 00:00:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps], "date_created timestamp_ntz")
    found = rows(P.hour_profile(df), "hour", "orders", "max_orders", "max_date", "min_orders", "min_date", "share")
    assert found == [
        ("00", 1, 1, d("2022-01-01"), 1, d("2022-01-01"), 0.143),
        ("09", 6, 2, d("2022-01-01"), 1, d("2022-01-02"), 0.857),
    ]


def test_region_net_daily(orders, codes):
    found = rows(R.region_net_daily(orders, codes, prefix_len=4))
    assert found == [
        ("东", d("2022-01-01"), 2, 0, 2),
        ("东", d("2022-01-09"), 0, 1, -1),
        ("其他", d("2022-01-08"), 1, 0, 1),
        ("西", d("2022-01-08"), 1, 0, 1),
        ("西", d("2022-02-01"), 1, 0, 1),
    ]


def test_premium_is_price_times_net(orders, codes):
    daily = R.region_net_daily(orders, codes, prefix_len=4, group="company", price="price", since="2022-01-01")
    by_company = rows(R.region_premium(daily, group="company"), "region", "is_total", "company", "net_orders", "premium")
    assert [(r, t, c, n, float(p)) for r, t, c, n, p in by_company] == [
        ("东", 0, "A", 1, 19.0), ("东", 1, None, 1, 19.0),
        ("其他", 0, None, 1, 38.0), ("其他", 1, None, 1, 38.0),
        ("西", 0, "B", 1, 19.0), ("西", 0, "线上平台", 1, 38.0), ("西", 1, None, 2, 57.0),
    ]
    only_price = R.region_net_daily(orders, codes, prefix_len=4, price="price")
    assert [(r, float(p)) for r, _, p in rows(R.region_premium(only_price))] == [("东", 19.0), ("其他", 38.0), ("西", 57.0)]


def test_region_shares(orders, codes):
    weekly = rows(R.region_share(orders, codes, grain="week", prefix_len=4), "is_total", "period", "region", "net_orders", "share")
    assert weekly == [
        (0, 1, "东", 2, 1.0),
        (0, 2, "东", -1, -1.0), (0, 2, "其他", 1, 1.0), (0, 2, "西", 1, 1.0),
        (0, 3, "西", 1, 1.0),
        (1, None, "东", 1, 0.25), (1, None, "其他", 1, 0.25), (1, None, "西", 2, 0.5),
    ]
    with pytest.raises(ValueError):
        R.region_share(orders, codes, grain="year")


def test_region_wide(orders, codes):
    long = R.region_share(orders, codes, grain="month", prefix_len=4).filter("is_total = 0")
    wide = R.region_wide(long, ["2022-01", "2022-02"])
    assert wide.columns == ["region", "net_orders", "2022-02", "2022-01"]
    assert rows(wide) == [("东", 1, 0, 1), ("其他", 1, 0, 1), ("西", 2, 1, 1)]


def test_region_wide_by_group(orders, codes):
    daily = R.region_net_daily(orders, codes, prefix_len=4, group="company", price="price")
    wide = R.region_wide(daily, [d("2022-01-01"), d("2022-01-08")], "date", "company", ["A", "线上平台"])
    assert wide.columns == [
        "region", "net_orders", "premium", "A_total", "线上平台_total",
        "A_2022-01-08", "A_2022-01-01", "线上平台_2022-01-08", "线上平台_2022-01-01",
    ]
    found = [(r[0], r[1], float(r[2]), *r[3:]) for r in rows(wide)]
    assert found == [
        ("东", 1, 19.0, 1, 0, 0, 2, 0, 0), ("其他", 1, 38.0, 0, 0, 0, 0, 0, 0), ("西", 2, 57.0, 0, 1, 0, 0, 1, 0),
    ]


def test_region_wide_finds_its_periods(spark):
    data = [("东", "2005-03", 2), ("东", "1999-12", 1), ("西", "2022-01", 4), ("西", None, 8), (None, "2022-01", 16)]
    long = spark.createDataFrame(data, "region string, period string, net_orders long")
    wide = R.region_wide(long)
    assert wide.columns == ["region", "net_orders", "2022-01", "2005-03", "1999-12"]
    assert rows(wide) == [(None, 16, 16, 0, 0), ("东", 3, 0, 2, 1), ("西", 12, 4, 0, 0)]
    assert R.region_wide(long, most=3).columns == wide.columns
    with pytest.raises(ValueError, match="more than 2 periods"):
        R.region_wide(long, most=2)
    assert R.region_wide(long.filter("false")).columns == ["region", "net_orders"]


def test_region_wide_finds_the_periods_of_each_group(spark):
    data = [("东", d("2022-01-01"), "A", 1), ("东", d("2022-01-03"), "B", 2), ("西", d("2022-01-03"), "C", 4), ("西", d("2022-01-02"), "A", 8)]
    long = spark.createDataFrame(data, "region string, date date, company string, net_orders long")
    wide = R.region_wide(long, column="date", group="company", groups=["B", "A"])
    assert wide.columns == ["region", "net_orders", "B_total", "A_total", "B_2022-01-03", "A_2022-01-02", "A_2022-01-01"]
    assert rows(wide) == [("东", 3, 2, 1, 2, 0, 1), ("西", 12, 0, 8, 0, 8, 0)]


def test_region_counts_with_a_shared_code(orders, codes, spark):
    shared = codes.union(spark.createDataFrame([("港", "4401")], "region string, code string"))
    assert rows(R.region_counts(orders, shared, prefix_len=4)) == [
        ("东", 1, 0.25), ("其他地区", 0, 0.0), ("港", 1, 0.25), ("西", 2, 0.5),
    ]
    assert rows(R.region_counts(orders, codes, prefix_len=4, top=1)) == [("西", 2, 0.5)]
    assert [r.region for r in R.top_regions(R.region_counts(orders, codes, prefix_len=4)).collect()] == ["西", "东"]


def test_region_counts_by_name(orders):
    assert rows(R.region_counts_by_name(orders, ["北区", "南区"])) == [
        ("北区", 2, 0.5), ("南区", 1, 0.25), ("市区", 1, 0.25),
    ]
    with pytest.raises(ValueError):
        R.region_counts_checked(orders)


def test_group_order_must_fit(orders):
    R.check_group_order(orders, "company", ["A", "B", "线上平台", "none"])
    with pytest.raises(ValueError):
        R.check_group_order(orders, "company", ["A"])
