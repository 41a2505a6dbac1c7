"""Sources, sinks, enrichment and the nightly job."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from orderlens.operators import prepare as E
from orderlens.operators import summary as S
from orderlens.plans import catalog, nightly
from orderlens.plans.roles import raw
from orderlens.sources import jdbc, lookups, tables
from tests.conftest import d, rows


def test_time_slices_cover_the_period_once():
    start, end = dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2)
    assert jdbc.time_slices(start, end, 2) == [
        "date_created >= '2022-01-01 00:00:00' AND date_created < '2022-01-01 12:00:00'",
        "date_created >= '2022-01-01 12:00:00' AND date_created < '2022-01-02 00:00:00'",
    ]
    assert jdbc.time_slices(start, end, 1, inclusive_end=True)[0].endswith("date_created <= '2022-01-02 00:00:00'")
    many = jdbc.time_slices(start, end, 7)
    for left, right in zip(many, many[1:]):
        assert left.split("< ")[1] == right.split(">= ")[1].split(" AND")[0]
    with pytest.raises(ValueError):
        jdbc.time_slices(end, start, 2)


def test_lookups_keep_codes_as_text(spark, tmp_path):
    (tmp_path / "companies.csv").write_text(
        "city,year,group,sku_code,company\n徐州,2022,个人,00000353,甲保险\n徐州,2022,企业,00000354,乙保险\n昆明,2022,个人,1,x\n"
    )
    lookup = lookups.read_lookup(spark, "companies", str(tmp_path / "companies.csv"))
    mine = lookups.of_project(lookup, "徐州", "2022", "self")
    assert rows(mine) == [("00000353", "甲保险")]
    assert lookups.require_rows(mine, "companies") is mine
    with pytest.raises(ValueError):
        lookups.require_rows(mine.filter("false"), "companies")


def test_snapshot_goes_to_the_shared_folder(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "company string, n int")
    back = tables.snapshot(df, "part", partition_by=["company"])
    assert rows(back, "company", "n") == [("A", 1), ("B", 2)]
    assert rows(tables.read_snapshot(spark, "part"), "company", "n") == [("A", 1), ("B", 2)]
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    paths = tables.write_reports({"one": df, "two": df.limit(0)}, str(tmp_path), "csv")
    assert spark.read.option("header", True).csv(paths[0]).count() == 2
    tables.write_per_company(df, str(tmp_path / "agents"))
    assert sorted(p.name for p in (tmp_path / "agents").glob("company=*")) == ["company=A", "company=B"]


def test_lookup_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "companies.csv"
    path.write_text("city,year,group,sku_code,company\n徐州,2022,个人,1,A\n徐州,2022\n,2022,个人,2,\"B,C\"\n徐州,2022,个人,3,D,x\n")
    lookup = lookups.read_lookup(spark, "companies", str(path))
    assert lookup.count() == 2
    assert rows(lookup, "sku_code", "company") == [("1", "A"), ("2", "B,C")]
    rejected = lookups.rejected_rows(spark, "companies", str(path))
    assert rejected.count() == 2
    assert rows(rejected) == [("companies", "徐州", "徐州,2022"), ("companies", "徐州", "徐州,2022,个人,3,D,x")]
    assert lookups.rejected_rows(spark, "companies", str(path)).filter("rejected like '%x'").count() == 1


def test_lookup_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "wrong.csv").write_text("city,year,kind,sku_code,company\n徐州,2022,个人,1,A\n")
    with pytest.raises(Exception, match="(?i)header"):
        lookups.read_lookup(spark, "companies", str(tmp_path / "wrong.csv")).collect()
    spark.createDataFrame([("a", 1)], "region string, code int").write.parquet(str(tmp_path / "regions"))
    with pytest.raises(ValueError, match="lacks codes"):
        lookups.read_lookup(spark, "regions", str(tmp_path / "regions"), "parquet")


def test_a_run_that_is_published_again_replaces_itself_only(spark, tmp_path):
    folder = str(tmp_path / "reports")

    def report(*companies):
        return spark.createDataFrame([(c, i) for i, c in enumerate(companies)], "company string, n int")

    assert tables.publish({}, folder, "A", "1") == []
    tables.publish({"one": report("x", "y"), "two": report("x")}, folder, "A", "007", per_company=["two"])
    tables.publish({"one": report("z")}, folder, "B", "007")
    tables.publish({"one": report("x", None)}, folder, "A", "010")
    kept = ("city", "run", "company", "n")
    assert rows(tables.read_published(spark, folder, "one"), *kept) == [("A", "010", None, 1), ("A", "010", "x", 0), ("B", "007", "z", 0)]
    # An empty report leaves its old files, but no row of them is seen.
    tables.publish({"one": report("w"), "two": report()}, folder, "A", "007", per_company=["two"])
    assert rows(tables.read_published(spark, folder, "one", latest=False), *kept) == [
        ("A", "007", "w", 0), ("A", "010", None, 1), ("A", "010", "x", 0), ("B", "007", "z", 0),
    ]
    assert rows(tables.read_published(spark, folder, "two", latest=False)) == []
    with pytest.raises(ValueError, match="column run"):
        tables.publish({"one": report("x").withColumn("run", F.lit(1))}, folder, "B", "007")
    # That run did not end.
    assert rows(tables.read_published(spark, folder, "one", latest=False).filter("city = 'B'")) == []


def test_newest_comes_from_the_footers(spark, sf_dir):
    df = tables.newest(spark, f"{sf_dir}/orders.parquet", "o_orderdate")
    assert "PushedAggregation: [MAX(o_orderdate)]" in df._jdf.queryExecution().executedPlan().toString()
    read = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert df.first()[0] == read.agg(F.max("o_orderdate")).first()[0]
    assert tables.newest(spark, f"{sf_dir}/orders.parquet", "o_orderkey").first()[0] == read.agg(F.max("o_orderkey")).first()[0]
    assert tables.newest(spark, f"{sf_dir}/orders.parquet", "o_orderpriority").first()[0] == read.agg(F.max("o_orderpriority")).first()[0]


@pytest.mark.parametrize("lengths", [(2, 4, 6), (6, 4, 2), (4, 2, 6), (4, 4)])
def test_lengths_left_out_of_the_prefix_fallback_find_nothing(spark, lengths):
    known = [(x, f"one {x}", None, f"three {x}") for x in ("aabbcc", "aabbdd", "aaxx", "bb", "b", "ccddee")] + [("ddeeff", None, None, None)]
    channels = spark.createDataFrame(known, "sale_channel_id string, channel_1 string, channel_2 string, channel_3 string")
    ids = ["aabbcc", "aabbzz", "aazz", "aa", "a", "b", "bbx", "ccddff", "ddeeff", "", None]
    orders = [(i, None, None, None) for i in ids] + [("aabbcc", "own", "own", "own")]
    df = spark.createDataFrame(orders, "sale_channel_id string, channel_1 string, channel_2 string, channel_3 string")

    def filled(order):
        for length in lengths:
            if order[1] is None and order[0] is not None:
                hits = sorted(c for c in known if c[1] and c[0][:length] == order[0][:length])
                if hits:
                    order = (order[0][:length], *hits[0][1:])
        return order

    found = E.with_channels_by_prefix(df, channels, lengths)
    columns = ("sale_channel_id", "channel_1", "channel_2", "channel_3")
    assert sorted(map(repr, rows(found, *columns))) == sorted(map(repr, map(filled, orders)))


def test_rising_prefix_lengths_take_one_join(spark):
    names = "sale_channel_id string, channel_1 string, channel_2 string, channel_3 string"
    channels, orders = spark.createDataFrame([("a", "1", "2", "3")], names), spark.createDataFrame([("a", None, None, None)], names)

    def joins(*lengths):
        found = E.with_channels_by_prefix(orders, channels, lengths)
        return found._jdf.queryExecution().analyzed().toString().count("Join LeftOuter")

    assert joins(10, 12, 16) == 1 and joins(16, 12, 10) == 3


def test_row_numbers(spark):
    data = [("b", 2), ("a", 1), ("a", None), (None, 3), ("a", 1), ("c", 2)]
    df = spark.createDataFrame(data, "k string, n int").repartition(4)
    found = [tuple(r) for r in S.numbered(df, F.desc("n")).orderBy("row_no").collect()]
    assert found == [(None, 3, 1), ("b", 2, 2), ("c", 2, 3), ("a", 1, 4), ("a", 1, 5), ("a", None, 6)]
    assert S.numbered(df.limit(0), F.desc("n")).collect() == []


def test_created_between(spark):
    df = spark.createDataFrame([(d("2022-01-01"),), (d("2022-01-02"),), (None,)], "date_created date")
    assert E.created_between(df, "2022-01-01", "2022-01-02").count() == 1
    assert E.created_between(df, "2022-01-01", "2022-01-02", inclusive_end=True).count() == 2


CHANNELS = [
    ("r1", None, 1, None, "North"),
    ("n1", None, 2, "North", "City"),
    ("s1", None, 3, "North,City", "n1#Agent 1"),
    ("s2", None, 3, None, "n1#Agent 2#x"),
    ("s3", None, 3, None, "gone#Agent 3"),
    ("s4", None, 3, None, "Agent 4"),
]


def test_channel_levels_and_repair(spark):
    raw_channels = spark.createDataFrame(
        CHANNELS, "channel_encode string, gmt_created timestamp, level int, ancestor_name string, channel_name string"
    )
    found = rows(E.channel_table(raw_channels), "sale_channel_id", "channel_1", "channel_2", "channel_3")
    assert found == [
        ("n1", "North", "City", "City"),
        ("r1", "North", "North", "North"),
        ("s1", "North", "City", "Agent 1"),
        ("s2", "North", "City", "Agent 2"),
        ("s3", None, None, "Agent 3"),
        ("s4", None, None, "Agent 4"),
    ]


def test_prefix_fallback_adds_no_rows(spark):
    channels = spark.createDataFrame(
        [("abcd1", "N", "C", "x"), ("abcd2", "N", "C", "y"), ("ab99", None, None, "z")],
        "sale_channel_id string, channel_1 string, channel_2 string, channel_3 string",
    )
    orders = spark.createDataFrame(
        [("abcd9", None, None, None), ("abzz", None, None, None), ("abcd1", "own", "o", "p"), (None, None, None, None)],
        "sale_channel_id string, channel_1 string, channel_2 string, channel_3 string",
    )
    found = rows(E.with_channels_by_prefix(orders, channels, (4, 2)), "sale_channel_id", "channel_1", "channel_3")
    assert found == [(None, None, None), ("ab", "N", "x"), ("abcd", "N", "x"), ("abcd1", "own", "p")]


def test_agent_suffix(spark):
    data = [("x", "7"), ("x", None), ("x", ""), (None, "7"), ("x_", None)]
    df = spark.createDataFrame(data, "channel_3 string, agent_no string")
    assert [r[0] for r in E.with_agent_suffix(df).collect()] == ["x_7", "x", "x", None, "x_"]


def test_company_payway_and_test_rows(spark):
    df = spark.createDataFrame([("s1", "1", "a"), ("s2", "9", "测试b"), ("s3", None, None)], "sku_code string, payway_code string, name string")
    companies = spark.createDataFrame([("s1", "A")], "sku_code string, company string")
    payways = spark.createDataFrame([("1", "微信")], "payway_code string, payway string")
    found = rows(E.with_payway(E.with_company(df, companies, ["s3"]), payways), "sku_code", "company", "payway")
    assert found == [("s1", "A", "微信"), ("s2", None, "其他"), ("s3", "线上平台", "其他")]
    assert rows(E.drop_test_rows(df), "sku_code") == [("s1",)]


def test_latest_remark(spark):
    data = [
        ("o1", d("2022-01-01"), "错误", "07"), ("o1", d("2022-01-02"), "去世", "07"), ("o1", d("2022-01-03"), "x", "08"),
        ("o2", d("2022-01-01"), "测试", "07"), ("o3", d("2022-01-01"), None, "07"),
    ]
    df = spark.createDataFrame(data, "pk_order_item string, date_updated date, remark string, event string")
    assert rows(E.latest_refund_remarks(df), "order_item_id", "refund_remark") == [("o1", "被保险人去世")]


def test_company_profiles(spark):
    df = spark.createDataFrame(
        [("c", "b", 2, "k", "n", "p", "m", "a"), ("d", "b", 7, "k", "n", "p", "m", "a")],
        "com_id string, business_name string, business_type int, credit_code string, name string, phone_num string, mail string, address string",
    )
    assert rows(E.company_profiles(df), "com_id", "business_type") == [("c", "事业单位"), ("d", None)]


def test_replace_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(E.replace_rows(old, spark.createDataFrame([("b", 9)], "k string, v int"), "k")) == [("a", 1), ("b", 9)]


def test_enriched_orders_are_not_shuffled_again_for_distinct(spark, sf_dir):
    df = catalog.REPORTS["enriched_orders"](spark, sf_dir)
    assert df.count() == df.distinct().count()
    no_broadcast = spark.newSession()
    no_broadcast.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = catalog.REPORTS["enriched_orders"](no_broadcast, sf_dir)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("SortMergeJoin")[0]
    assert "HashAggregate" in top and "Exchange" not in top


def test_nightly_run(spark, sf_dir, tmp_path):
    raw_tables = {
        name: raw(spark, sf_dir, name)
        for name in (
            "order_item", "order_service_obj", "order_insurance_applicant", "policy_order", "com_order_item",
            "com_order_item_info", "com_order_payment", "com_order", "com_order_policy",
        )
    }
    raw_tables["sales_channel"] = (
        raw(spark, sf_dir, "sales_channel").unionByName(raw(spark, sf_dir, "sales_channel_2")).unionByName(raw(spark, sf_dir, "sales_channel_1"))
    )
    companies = catalog.literal(spark, ("sku_code", "company"), catalog.COMPANY_OF_SKU)
    payways = catalog.literal(spark, ("payway_code", "payway"), catalog.PAYWAYS)
    lookup = {
        "self_companies": companies, "com_companies": companies, "self_payways": payways, "com_payways": payways,
        "regions": catalog.literal(spark, ("region", "codes"), {"东": "440101, 440102", "西": "440103"}),
        "company_channels": raw(spark, sf_dir, "company_channels"),
    }
    project = nightly.Project(
        "城", "2000", dt.datetime(1996, 1, 1), dt.datetime(2000, 12, 31), catalog.PRICES, catalog.SKUS, catalog.SKUS,
        catalog.ONLINE_SKUS, ended=True, with_relation=True,
    )
    paths = nightly.run(project, raw_tables, lookup, str(tmp_path))
    published = nightly.run(project, raw_tables, lookup, str(tmp_path / "all"), run_time="2001-01-02 03:00")
    assert {path.rsplit("/", 1)[1] for path in published} == {path.rsplit("/", 1)[1] for path in paths}
    numbers = tables.read_published(spark, str(tmp_path / "all"), "regions").orderBy("row_no").collect()
    assert [r.row_no for r in numbers] == list(range(1, len(numbers) + 1)) and numbers[0].run == "2001-01-02 03:00"
    assert [r.people for r in numbers] == sorted((r.people for r in numbers), reverse=True)
    lists = [p.name for p in (tmp_path / "all" / "agents_below_average").glob("city=*/run=*/company=*")]
    assert len(lists) == spark.read.parquet(paths[0].rsplit("/", 1)[0] + "/agents_below_average").select("company").distinct().count()
    assert len(paths) == len(set(paths)) > 30
    total = spark.read.parquet(str(tmp_path / "城/2000/daily_all")).filter("is_total = 1").first()
    orders = nightly.enrich(project, raw_tables, lookup)
    dated = orders.filter(F.to_date("date_created").between("1996-01-01", "2000-12-31")).count()
    assert total.orders == dated > 0
    regions = [r.people for r in spark.read.parquet(str(tmp_path / "城/2000/regions")).collect()]
    assert regions == sorted(regions, reverse=True)
    assert project.days == 1826
    com = spark.read.parquet(str(tmp_path / "城/2000/daily_com")).filter("is_total = 1").first()
    ordered = orders.filter(F.col("group") == "com").filter(F.to_date("date_created_origin").between("1996-01-01", "2000-12-31"))
    assert com.orders == ordered.count() > 0
    assert {"duplicate_orders_self", "duplicate_orders_com"} <= {path.rsplit("/", 1)[1] for path in paths}
    assert not list(pathlib.Path(tables.shared_folder(spark)).glob("城-2000-*"))
