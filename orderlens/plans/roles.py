"""Roles of the test tables: which column stands for which field of an order.

Every expression is plain SQL that Spark and the checking engine both read, so
one text defines the mapping for both. :func:`fact` joins only the tables the
asked roles need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BIRTHDAY = (
    "case when c_custkey % 23 <> 0 then "
    "date '2000-06-23' - cast((c_custkey * 7919) % 39500 as int) end"
)
SEX = "case when c_custkey % 17 = 0 then null when c_custkey % 2 = 1 then '男' else '女' end"
CHANNEL_1 = "case n_name when 'NATION_0' then null when 'NATION_3' then '展E保' else n_name end"
COM_ID = "case when l_linestatus = 'O' then o_custkey % 50 end"

# role -> (expression, tables beside lineitem)
ROLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_item_id": ("l_orderkey * 10 + l_linenumber", ()),
    "date_created": ("cast(o_orderdate as date)", ("orders",)),
    "date_updated": ("cast(l_shipdate as date)", ()),
    "group": ("case when l_linestatus = 'F' then 'self' else 'com' end", ()),
    "policy_order_status": (
        "case when l_returnflag = 'R' and l_linestatus = 'F' then '04' "
        "when l_returnflag = 'R' then '05' when l_returnflag = 'A' then null else '00' end",
        (),
    ),
    "company": ("nullif(c_mktsegment, 'HOUSEHOLD')", ("orders", "customer")),
    "seller": (
        "case when p_brand = 'Brand#7' then '线上平台' else nullif(p_brand, 'Brand#13') end",
        ("part",),
    ),
    "channel_1": (CHANNEL_1, ("orders", "customer", "nation")),
    "channel_2": ("nullif(p_type, 'PROMO')", ("part",)),
    "channel_3": ("case when l_suppkey % 10 <> 0 then 'agent_' || cast(l_suppkey as string) end", ()),
    "sale_channel_id": ("case when l_suppkey % 10 <> 0 then l_suppkey end", ()),
    "open_id": ("nullif(o_custkey % 7, 0) * 100000000 + o_custkey", ("orders",)),
    "applicant_id_no": ("o_custkey", ("orders",)),
    "customer_id": ("case when o_custkey % 19 <> 0 then o_custkey end", ("orders",)),
    "com_id": (COM_ID, ("orders",)),
    "automatic_deduction": ("case when o_orderkey % 3 = 0 then 1 else 0 end", ("orders",)),
    "is_automatic_deduction": ("case when l_orderkey % 4 = 0 then 1 else 0 end", ()),
    "medical_insure_flag": ("case when l_partkey % 2 = 0 then 1 else 0 end", ()),
    "payway": (
        "case l_partkey % 5 when 0 then '微信' when 1 then '支付宝' when 2 then '医保个账' "
        "when 3 then '银联' end",
        (),
    ),
    "sex": (SEX, ("orders", "customer")),
    "birthday": (BIRTHDAY, ("orders", "customer")),
    "name": (
        "case when c_custkey % 29 <> 0 then "
        "substring('赵钱孙李周吴郑王冯陈', cast(c_custkey % 10 as int) + 1, 1) || c_name end",
        ("orders", "customer"),
    ),
    "id_type": (
        "case when c_custkey % 6 < 3 then '身份证' when c_custkey % 6 = 3 then '护照' "
        "when c_custkey % 6 = 4 then '港澳居民来往内地通行证' else '台湾居民来往大陆通行证' end",
        ("orders", "customer"),
    ),
    "id_no": (
        "cast(c_nationkey + 11 as string) || lpad(cast(c_custkey % 3 as string), 4, '0') || "
        f"replace(cast(({BIRTHDAY}) as string), '-', '') || "
        "lpad(cast(c_custkey % 1000 as string), 3, '0') || 'X'",
        ("orders", "customer"),
    ),
    "relation_ship": (
        "case l_linenumber % 4 when 0 then '本人' when 1 then '父母' when 2 then '配偶' end",
        (),
    ),
    "payment_amount": ("(p_size % 4 + 1) * 1900", ("part",)),
    "product": ("'v' || cast(p_size % 3 as string)", ("part",)),
    "sku_code": ("'sku' || cast(l_partkey % 9 as string)", ()),
    "task_id": ("o_orderkey % 5", ("orders",)),
    "step": ("l_linenumber % 4 + 1", ()),
    "message": (
        "case o_orderpriority when '1-URGENT' then '商户号错误' when '2-HIGH' then '有重复下单' "
        "when '3-MEDIUM' then '该卡已被银行冻结' "
        "when '4-NOT SPECIFIED' then '交易金额或次数超出限制，请检查后再试' "
        "else case l_linenumber when 1 then '白名单' when 3 then '当前用户账户已被限制交易' "
        "when 7 then '签约协议不存在，请检查传入的签约协议是否正确' else '未成功签约' end end",
        ("orders",),
    ),
}

JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
    "part": ("l_partkey", "p_partkey"),
}


# Declared schemas, so building a query does not open the files to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def fact(spark: SparkSession, sf_dir: str, *roles: str) -> DataFrame:
    """The order fact with the asked roles, joined from the tables they need.

    What belongs to an order is joined to the orders, before these meet their many lines: lines
    are then shuffled once for it, by the order, and carry no customer.
    """
    needed = {name for role in roles for name in ROLES[role][1]}

    def with_tables(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
        for name in names:
            if name in needed:
                left, right = JOINS[name]
                df = df.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
        return df

    joined = with_tables(table(spark, sf_dir, "lineitem"), ("part",))
    if "orders" in needed:
        left, right = JOINS["orders"]
        orders = with_tables(table(spark, sf_dir, "orders"), ("customer", "nation"))
        joined = joined.join(orders, F.col(left) == F.col(right))
    return joined.select(*[F.expr(ROLES[role][0]).alias(role) for role in roles])


def fact_sql() -> str:
    """The whole fact as a SQL query, for the checking engine."""
    columns = ",\n  ".join(f'{expr} as "{role}"' for role, (expr, _) in ROLES.items())
    joins = "\n".join(f"join {name} on {left} = {right}" for name, (left, right) in JOINS.items())
    return f"select\n  {columns}\nfrom lineitem\n{joins}"


# Agents, company list, deduction tasks and totals, over the small test tables.
SIDE: dict[str, tuple[str, dict[str, str]]] = {
    "agents": (
        "supplier join nation on s_nationkey = n_nationkey",
        {
            "channel_id": "s_suppkey",
            "channel_1": CHANNEL_1,
            "channel_2": "'branch_' || cast(s_suppkey % 7 as string)",
            "channel_3": (
                "case when s_suppkey % 9 = 0 then 'branch_' || cast(s_suppkey % 7 as string) else s_name end"
            ),
            "registered": "date '1995-01-01' + cast(s_suppkey * 7 % 900 as int)",
        },
    ),
    "company_channels": (
        "nation",
        {
            "channel_1": CHANNEL_1,
            "company": (
                "case n_nationkey % 6 when 0 then 'MACHINERY' when 1 then 'BUILDING' "
                "when 2 then 'AUTOMOBILE' when 3 then 'FURNITURE' when 4 then 'OTHER' end"
            ),
        },
    ),
    "region_codes_2": (
        "nation join region on n_regionkey = r_regionkey",
        {
            "region": "case when n_nationkey % 5 <> 4 then r_name end",
            "code": "cast(n_nationkey + 11 as string)",
        },
    ),
    "task_config": (
        "region",
        {
            "id": "r_regionkey",
            "project_name": "r_name || case when r_regionkey = 3 then '测试' else '' end",
            "advance_deduction_notice_time": "'2022-03-0' || cast(r_regionkey + 1 as string) || ' 09:00:00'",
            "start_deduction_time": "'2022-03-1' || cast(r_regionkey as string) || ' 10:00:00'",
        },
    ),
    # Lines of a lookup as somebody wrote them, some with too many fields or too few.
    "company_lines": (
        "customer",
        {
            "line": (
                "case when c_custkey % 3 = 0 then '徐州' else '昆明' end || "
                "case when c_custkey % 2 = 0 then ',2022' else ',2021' end || "
                "case when c_custkey % 89 = 1 then '' else "
                "case when c_custkey % 5 = 0 then ',企业,' else ',个人,' end || "
                "lpad(cast(c_custkey as string), 8, '0') || ',' || "
                "case when c_mktsegment = 'HOUSEHOLD' then '' else c_mktsegment end || "
                "case when c_custkey % 97 = 0 then ',x' else '' end end"
            ),
        },
    ),
    "stamps": (
        "events",
        {
            "event_id": "event_id",
            "stamp": (
                "case when event_id % 7 = 0 then 'n/a' else cast(date_trunc('second', ts) as string) || "
                "case when event_id % 2 = 0 then ' CST' else '' end end"
            ),
        },
    ),
    "task_totals": (
        "orders",
        {
            "auto_deduction_base_config_id": "o_orderkey % 5",
            "deduction_pay_success_total": "o_custkey % 3",
            "send_msg_total": "o_custkey % 17",
        },
    ),
}

# Raw tables of the extraction step, each over one or two test tables.
# name -> (from clause, {column: expression})
RAW_PERSON = {
    "name": (
        "case when c_custkey % 31 = 0 then '测试' || c_name when c_custkey % 29 <> 0 then c_name end"
    ),
    "id_type": "case cast(c_custkey % 5 as int) when 0 then 1 when 1 then 2 when 2 then 7 when 3 then 8 else 9 end",
    "id_no": (
        "case when c_custkey % 13 = 0 then 'ab' || cast(c_custkey as string) else "
        "'4401' || lpad(cast(c_custkey % 100 as string), 2, '0') || "
        "case when c_custkey % 37 = 0 then '19991399' else "
        "replace(cast((date '1999-12-31' - cast((c_custkey * 7919) % 30000 as int)) as string), '-', '') end || "
        "lpad(cast(c_custkey % 1000 as string), 3, '0') || 'x' end"
    ),
    "sex": "case cast(c_custkey % 4 as int) when 0 then 'F' when 1 then 'W' end",
    "birthday": (
        "case cast(c_custkey % 3 as int) when 0 then '' when 1 then "
        "cast((date '1999-12-31' - cast((c_custkey * 7919) % 30000 as int)) as string) end"
    ),
    "tel": "'1' || lpad(cast(c_custkey as string), 10, '0')",
}
WITH_CUSTOMER = "orders join customer on o_custkey = c_custkey"
RAW: dict[str, tuple[str, dict[str, str]]] = {
    "order_item": (
        "orders",
        {
            "id": "o_orderkey",
            "date_created": "o_orderdate",
            "date_updated": "o_orderdate",
            "sku_code": "'sku' || cast(o_orderkey % 7 as string)",
            "sale_channel_id": (
                "case when o_orderkey % 11 <> 0 then 'channel' || lpad(cast(o_custkey % 120 as string), 9, '0') || 'tail' end"
            ),
            "automatic_deduction": "case o_orderkey % 3 when 0 then 1 when 1 then 0 end",
            "automatic_deduction_is_success": "case o_orderkey % 6 when 0 then 1 end",
            "is_automatic_deduction": "case o_orderkey % 4 when 0 then 1 else 0 end",
            "customer_id": "o_custkey",
            "agent_no": "case o_orderkey % 4 when 0 then 'a' || cast(o_orderkey % 13 as string) when 1 then '' end",
            "pk_main_order": "o_orderkey * 2",
            "sub_order_no": "o_orderkey * 3",
            "medical_insure_flag": "case o_orderkey % 5 when 0 then 1 when 1 then 0 end",
            "payment_amount": "case o_orderkey % 4 when 0 then '7900' when 1 then '19900' when 2 then '8000' else '100' end",
            "payway": "o_orderkey % 6",
            "order_status": "case when o_orderpriority = '5-LOW' then '02' else '01' end",
            "payment_status": "case when o_orderstatus = 'P' then '00' else '01' end",
            "refund_status": "case o_orderkey % 9 when 0 then '02' when 1 then '01' end",
        },
    ),
    "order_service_obj": (
        WITH_CUSTOMER,
        {
            "pk_order_item": "o_orderkey",
            **RAW_PERSON,
            "relation_ship": "cast(o_orderkey % 6 as int)",
            "date_created": "o_orderdate",
        },
    ),
    "order_insurance_applicant": (
        WITH_CUSTOMER,
        {
            "pk_main_order": "o_orderkey * 2",
            "open_id": "case when o_custkey % 7 <> 0 then 'open' || cast(o_custkey as string) else '' end",
            **RAW_PERSON,
            "date_created": "o_orderdate",
        },
    ),
    "policy_order": (
        "orders",
        {
            "pk_order_item": "o_orderkey",
            "policy_company": "o_orderpriority",
            "policy_no": "'p' || cast(o_orderkey as string)",
            "effective_date": "o_orderdate",
            "expiry_date": "o_orderdate",
            "date_created": "case when o_orderkey % 8 <> 0 then o_orderdate end",
        },
    ),
    "com_order_item": (
        "orders",
        {
            "id": "o_orderkey",
            "date_created": "o_orderdate",
            "date_updated": "o_orderdate",
            "product_id": "'sku' || cast(o_orderkey % 7 as string)",
            "sale_channel_id": (
                "case when o_orderkey % 11 <> 0 then 'channel' || lpad(cast(o_custkey % 120 as string), 9, '0') || 'tail' end"
            ),
            "policy_status": "case o_orderkey % 9 when 0 then '05' when 1 then null else '01' end",
            "payment_status": "case o_orderstatus when 'P' then '00' when 'O' then '02' else '05' end",
            "amount": "case o_orderkey % 4 when 0 then '7900' when 1 then '19900' when 2 then '8000' else '100' end",
            "com_id": "o_custkey % 50",
            "order_id": "o_custkey",
            "order_status": "case when o_orderpriority = '5-LOW' then '02' else '01' end",
        },
    ),
    "com_order_item_info": (
        WITH_CUSTOMER,
        {
            "order_item_id": "o_orderkey",
            "name": "c_name",
            "id_type": "cast(c_custkey % 8 as int)",
            "id_no": "'x' || cast(c_custkey as string)",
            "gender": "case cast(c_custkey % 3 as int) when 0 then 'M' when 1 then 'W' end",
            "birthday": "cast((date '1999-12-31' - cast((c_custkey * 7919) % 30000 as int)) as string)",
            "tel": "'1' || lpad(cast(c_custkey as string), 10, '0')",
            "date_created": "o_orderdate",
        },
    ),
    "com_order_payment": (
        "customer",
        {
            "order_id": "c_custkey",
            "date_updated": "cast(date '1998-01-01' + cast(c_custkey % 900 as int) as timestamp)",
            "pay_way": "c_nationkey % 4",
            "payment_status": "case when c_custkey % 5 = 0 then '01' else '02' end",
            "date_created": "cast(date '1998-01-01' + cast(c_custkey % 900 as int) as timestamp)",
        },
    ),
    "com_order": (
        "customer",
        {
            "id": "c_custkey",
            "order_no": "'main' || cast(c_custkey as string)",
            "date_created": "cast(date '1998-01-01' + cast(c_custkey % 1100 as int) as timestamp)",
        },
    ),
    "com_order_policy": (
        "customer",
        {
            "order_id": "c_custkey",
            "insurance_company_name": "c_mktsegment",
            "policy_no": "'cp' || cast(c_custkey as string)",
            "effect_start_date": "cast(date '1999-01-01' as timestamp)",
            "effect_end_date": "cast(date '1999-12-31' as timestamp)",
            "date_created": "cast(date '1998-01-01' + cast(c_custkey % 1100 as int) as timestamp)",
        },
    ),
    "com_info": (
        "customer",
        {
            "com_id": "c_custkey",
            "business_name": "c_name",
            "business_type": "cast(c_custkey % 11 as int)",
            "credit_code": "lpad(cast(c_custkey as string), 18, '0')",
            "name": "case when c_custkey % 29 <> 0 then c_name end",
            "phone_num": "'1' || lpad(cast(c_custkey as string), 10, '0')",
            "mail": "cast(c_custkey as string) || '@example.com'",
            "address": "c_mktsegment",
        },
    ),
    "order_trade_record": (
        "lineitem",
        {
            "pk_order_item": "l_orderkey",
            "date_updated": "l_shipdate",
            "remark": (
                "case cast(l_partkey % 11 as int) when 0 then '用户发起退单' when 1 then '身份证号错误' "
                "when 2 then '没有本市医保' when 3 then '看不懂条款' when 4 then '买了其他保险' "
                "when 5 then '人在国外' when 6 then '被保险人已过世' when 7 then '测试单' "
                "when 8 then '不想要了' when 9 then '其他产品更好，信息错误' else null end"
            ),
            "event": "case when l_returnflag = 'R' then '07' else '08' end",
        },
    ),
    # Level 1: regions, level 2: nations, level 3: suppliers. Some suppliers lack
    # the ancestors' names and carry the nation's id before a '#'.
    "sales_channel": (
        "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
        {
            "channel_encode": "'channel' || lpad(cast(s_suppkey as string), 9, '0')",
            "gmt_created": "cast(date '1995-01-01' + cast(s_suppkey * 7 % 900 as int) as timestamp)",
            "level": "3",
            "ancestor_name": "case when s_suppkey % 4 <> 0 then r_name || ',' || n_name end",
            "channel_name": (
                "case when s_suppkey % 5 = 0 then replace(s_name, '#', '-') "
                "when s_suppkey % 35 = 1 then 'gone#' || s_name "
                "else 'n' || cast(n_nationkey as string) || '#' || replace(s_name, '#', '-') end"
            ),
        },
    ),
    "sales_channel_2": (
        "nation join region on n_regionkey = r_regionkey",
        {
            "channel_encode": "'n' || cast(n_nationkey as string)",
            "gmt_created": "cast(date '1994-12-01' as timestamp)",
            "level": "2",
            "ancestor_name": "case when n_nationkey % 6 <> 0 then r_name end",
            "channel_name": "n_name",
        },
    ),
    "sales_channel_1": (
        "region",
        {
            "channel_encode": "'r' || cast(r_regionkey as string)",
            "gmt_created": "cast(date '1994-11-01' as timestamp)",
            "level": "1",
            "ancestor_name": "cast(null as string)",
            "channel_name": "r_name",
        },
    ),
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table of the extraction step, or one of the side tables."""
    source, columns = {**RAW, **SIDE}[name]
    first, *joins = source.split(" join ")
    joined = table(spark, sf_dir, first)
    for join in joins:
        other, on = join.split(" on ")
        joined = joined.join(table(spark, sf_dir, other), F.expr(on))
    return joined.select(*[F.expr(expr).alias(column) for column, expr in columns.items()])


def raw_sql(name: str) -> str:
    source, columns = {**RAW, **SIDE}[name]
    shown = ", ".join(f'{expr} as "{column}"' for column, expr in columns.items())
    return f"select {shown} from {source}"
