"""The same reports as plain SQL, written apart from the operators.

Where an operator makes one pass, the SQL here joins separately counted sides,
counts totals in their own query, or compares every date with every order.
"""

from __future__ import annotations

from orderlens.functions import labels as L
from orderlens.functions import people as P
from orderlens.operators.demography import AGE_BAND_YEARS, AGE_BANDS
from orderlens.operators.prepare import REMARK_EVENT
from orderlens.plans import catalog as C
from orderlens.plans.roles import fact_sql, raw_sql

FACT = fact_sql()
REFUND = "policy_order_status in ('04', '05')"
VALID = "(policy_order_status is null or policy_order_status not in ('04', '05'))"


def rounded(x: str, digits: int) -> str:
    """Nearest decimal to the double ``x``, exact ties to the even digit."""
    scale = f"{float(10**digits):.1f}"
    low = f"floor(abs({x}) * {scale})"
    below, above = f"{low} / {scale}", f"ceil(abs({x}) * {scale}) / {scale}"
    size = (
        f"(case when {above} - abs({x}) < abs({x}) - {below} "
        f"or ({above} - abs({x}) = abs({x}) - {below} and cast({low} as bigint) % 2 = 1) "
        f"then {above} else {below} end)"
    )
    return f"(case when {x} < 0 and {size} <> 0 then -{size} else {size} end)"


def quotient(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def share(a: str, b: str, digits: int) -> str:
    return rounded(quotient(a, b), digits)


def distinct_na(column: str, table_where: str = "") -> str:
    return f"count(distinct {column}) + coalesce(max(case when {column} is null then 1 else 0 end), 0)"


def with_fact(body: str) -> str:
    """``body`` starts with a select, or with ``,`` and further named queries."""
    return f"with fact as (\n{FACT}\n)\n{body}"


def long(expr: str) -> str:
    return f"cast({expr} as bigint)"


def day(expr: str) -> str:
    return f"cast({expr} as varchar)"


# Orders per day -----------------------------------------------------------

KINDS = {
    "all": ("true", "('04', '05')", "coalesce(com_id, open_id)", "coalesce(com_id, applicant_id_no)"),
    "self": ("\"group\" = 'self'", "('04')", "open_id", "applicant_id_no"),
    "com": ("\"group\" = 'com'", "('05')", "com_id", "com_id"),
}


def net(kind: str, keys: tuple[str, ...] = ()) -> str:
    where, refund, user, applicant = KINDS[kind]
    ks = "".join(f", {k}" for k in keys)
    not_null = "".join(f" and {k} is not null" for k in keys)
    group = ", ".join(["d", *keys])
    deduct = kind == "self"
    on = " and ".join(["o.d is not distinct from r.d", *[f"o.{k} = r.{k}" for k in keys]])
    merged = "".join(f", coalesce(o.{k}, r.{k}) as {k}" for k in keys)
    counts = (
        f"{distinct_na('u')} as users, {distinct_na('a')} as applicants, count(*) as orders, "
        "sum(case when refunded then 0 else automatic_deduction end) as ad"
    )
    ad_day = f", {long('coalesce(o.ad, 0)')} as auto_deduct" if deduct else ""
    ad_all = f", {long('ad')} as auto_deduct" if deduct else ""
    by = f"group by {', '.join(keys)}" if keys else ""
    return with_fact(
        f""", base as (
  select date_created as d, date_updated as upd, coalesce(policy_order_status in {refund}, false) as refunded,
    {user} as u, {applicant} as a, automatic_deduction{ks}
  from fact where {where}{not_null}
), o as (select d{ks}, {counts} from base group by {group}),
r as (select upd as d{ks}, count(*) as n from base where refunded group by upd{ks}),
t as (select {', '.join(keys) + ',' if keys else ''} {counts}, sum(case when refunded then 1 else 0 end) as n from base {by})
select {day('coalesce(o.d, r.d)')} as date{merged}, 0 as is_total,
  {long('coalesce(users, 0)')} as users, {long('coalesce(applicants, 0)')} as applicants,
  {long('coalesce(orders, 0)')} as orders, {long('coalesce(n, 0)')} as refunds,
  {long('coalesce(orders, 0) - coalesce(n, 0)')} as net_orders{ad_day}
from o full join r on {on}
union all
select null{ks}, 1, {long('users')}, {long('applicants')}, {long('orders')}, {long('n')},
  {long('orders - n')}{ad_all}
from t"""
    )


def net_channel3() -> str:
    """Sold and refunded sides with their own names, joined on day, names and channel."""
    _, _, user, applicant = KINDS["all"]
    counts = f"{distinct_na('u')} as users, {distinct_na('a')} as applicants, count(*) as orders"
    names = ("company", "channel_1", "channel_2", "channel_3", "channel_id")
    same = " and ".join(f"s.{c} is not distinct from b.{c}" for c in ("d", *names))
    either = ", ".join(f"coalesce(s.{c}, b.{c}) as {c}" for c in names)
    return with_fact(
        f""", base as (
  select date_created as d, date_updated as upd, {REFUND} as refunded, {user} as u, {applicant} as a, company,
    sale_channel_id as channel_id, channel_1, channel_2, channel_3, order_item_id
  from fact where sale_channel_id is not null
), sold_counts as (select d, company, channel_id, {counts} from base group by 1, 2, 3),
back_counts as (select upd as d, company, channel_id, count(*) as n from base where refunded group by 1, 2, 3),
sold as (
  select p.*, users, applicants, orders
  from (select distinct d, {', '.join(names)} from base) p join sold_counts c
    on p.d = c.d and p.company is not distinct from c.company and p.channel_id = c.channel_id
), back as (
  select p.*, n
  from (select distinct upd as d, {', '.join(names)} from base where refunded) p join back_counts c
    on p.d is not distinct from c.d and p.company is not distinct from c.company and p.channel_id = c.channel_id
), ranked as (
  select *, row_number() over (
    partition by channel_id order by d, cast(order_item_id as varchar), company nulls first, channel_1 nulls first,
      channel_2 nulls first, channel_3 nulls first) as k
  from base
), totals as (
  select channel_id, {counts}, count(*) filter (where refunded) as n from base group by channel_id
)
select {day('coalesce(s.d, b.d)')} as date, {either}, 0 as is_total, {long('coalesce(users, 0)')} as users,
  {long('coalesce(applicants, 0)')} as applicants, {long('coalesce(orders, 0)')} as orders,
  {long('coalesce(n, 0)')} as refunds, {long('coalesce(orders, 0) - coalesce(n, 0)')} as net_orders
from sold s full join back b on {same}
union all
select null, company, channel_1, channel_2, channel_3, t.channel_id, 1, {long('users')}, {long('applicants')}, {long('orders')},
  {long('n')}, {long('orders - n')}
from totals t join ranked r on t.channel_id = r.channel_id and r.k = 1"""
    )


def company_stack() -> str:
    return with_fact(
        f"""select {day('d')} as date, {long('sum(n)')} as stack_height from (
  select date_created as d, 1 as n from fact where company is not null
  union all
  select date_updated, 0 from fact where company is not null and {REFUND}
) group by d"""
    )


def kpi() -> str:
    return with_fact(
        f""", days as (
  select d, sum(n) as net from (
    select date_created as d, 1 as n from fact
    union all select date_updated, -1 from fact where {REFUND}
  ) group by d
), t as (
  select count(*) as orders, count(*) filter (where {REFUND}) as refunds,
    {distinct_na('coalesce(com_id, applicant_id_no)')} as applicants
  from fact
), f as (select orders, refunds, orders - refunds as net_orders, applicants from t)
select orders, refunds, net_orders, {long('applicants')} as applicants,
  {share('refunds', 'orders', 2)} as refund_rate,
  {share('net_orders', str(C.RUN_DAYS), 1)} as orders_per_day,
  {share('net_orders', 'applicants', 1)} as orders_per_applicant,
  (select {day('min(d)')} from days) as first_day,
  (select {long('net')} from days order by d limit 1) as first_day_net,
  (select {day('d')} from days order by net desc, d limit 1) as best_day,
  (select {long('max(net)')} from days) as best_day_net
from f"""
    )


# People -------------------------------------------------------------------

SOLD_AGES = f"""select date_created - birthday as age, * from fact where {VALID}"""


def band_case(gap: int) -> str:
    """First year of each band, spelled out band by band."""
    starts = list(range(1, 101, gap))
    cases = ["when age is null then null", "when age < 365 then 0"]
    for i, first in enumerate(starts):
        if i + 1 < len(starts):
            cases.append(f"when age >= {first * 365} and age < {starts[i + 1] * 365} then {first}")
        else:
            cases.append(f"when age >= {first * 365} and age <= 36500 then {first}")
    return "case " + " ".join(cases) + " else 101 end"


def band_text(gap: int) -> str:
    starts = list(range(1, 101, gap))
    cases = ["when band_start = 0 then '0'", "when band_start = 101 then '>100'"]
    for i, first in enumerate(starts):
        last = starts[i + 1] - 1 if i + 1 < len(starts) else 100
        cases.append(f"when band_start = {first} then '{first}-{last}'")
    return "case " + " ".join(cases) + " end"


AGE_COUNTS = (
    "count(*) as people, count(*) filter (where sex = '男') as men, "
    "count(*) filter (where sex = '女') as women"
)


def ages(gap: int, by: str | None = None, kind: str = "all") -> str:
    where, refund, _, _ = KINDS[kind]
    source = f"""select date_created - birthday as age, * from fact
  where {where} and (policy_order_status is null or policy_order_status not in {refund})"""
    key = f"{by}, " if by else ""
    first = f"coalesce({by}, 'NA') as {by}, " if by else ""
    match = f"using ({by})" if by else "on true"
    group = f"group by {by}" if by else ""
    select = (
        f"{share('men', 'people', 2)} as men_share, {share('women', 'people', 2)} as women_share"
    )
    return f""", sold as (select {first}{band_case(gap)} as band_start, sex from ({source})),
bands as (select {key}band_start, {AGE_COUNTS} from sold group by {key}band_start),
totals as (select {key}{AGE_COUNTS} from sold {group}),
ages as (
  select {key}{band_text(gap)} as age_band, cast(band_start as int) as band_start, 0 as is_total, b.people as people,
    b.men as men, b.women as women, t.people as everyone
  from bands b join totals t {match}
  union all
  select {key}null, null, 1, people, men, women, people from totals
), age_sex as (
  select {key}age_band, band_start, is_total, people, men, women, {select},
    {share('people', 'everyone', 2)} as band_share
  from ages
)"""


def age_decades() -> str:
    decade = (
        "case when band_start is null then null when band_start <= 10 then 0 "
        + " ".join(f"when band_start <= {10 * (i + 1)} then {i}" for i in range(1, 10))
        + " else 9 end"
    )
    names = " ".join(
        f"when {i} then '{0 if i == 0 else 10 * i + 1}-{10 * i + 10}{'岁以上' if i == 9 else '岁'}'"
        for i in range(10)
    )
    return with_fact(
        f"""{ages(1)}
select decade, {long('sum(men)')} as men, {long('sum(women)')} as women,
  {long('sum(cast(round(band_share * 100) as bigint))')} / 100.0::double as decade_share,
  case decade {names} end as label
from (select cast({decade} as int) as decade, * from age_sex where is_total = 0) group by decade"""
    )


STAR_RANGES = [
    (name, first, P.STAR_SIGNS[(i + 1) % 12][0]) for i, (first, name) in enumerate(P.STAR_SIGNS)
]


def star_case() -> str:
    cases = [
        f"when strftime(birthday, '%m-%d') >= '{first}' and strftime(birthday, '%m-%d') < '{following}' then '{name}'"
        for name, first, following in STAR_RANGES[:-1]
    ]
    return "case " + " ".join(cases) + f" else '{P.STAR_SIGNS[-1][1]}' end"


def zodiac_case() -> str:
    cases = [f"when {i} then '{name}'" for i, name in enumerate(P.ZODIAC)]
    return f"case year(birthday) % 12 {' '.join(cases)} end"


def signs(case: str, names: list[str], top: int | None = None) -> str:
    values = ", ".join(f"('{name}')" for name in names)
    counted = f""", sold as (select {case} as label from fact where {VALID}),
counted as (
  select n.label as label, (select count(*) from sold s where s.label = n.label) as people
  from (values {values}) as n(label)
)
select label, people, {share('people', '(select count(*) from sold)', 3)} as share from counted"""
    if top:
        counted += f" where (select count(*) from counted c where c.people > counted.people) < {top}"
    return with_fact(counted)


def fact_conditions() -> dict[str, tuple[str, int | None]]:
    online = "regexp_matches(seller, '线上平台|Brand#2')"
    launch = f"{C.START:%m-%d}"
    born = (
        "case when id_type = '身份证' and length(id_no) = 18 then substring(id_no, 11, 2) || '-' || substring(id_no, 13, 2) "
        "when id_type = '身份证' and length(id_no) = 15 then substring(id_no, 9, 2) || '-' || substring(id_no, 11, 2) "
        "else strftime(birthday, '%m-%d') end"
    )
    conditions: dict[str, tuple[str, int | None]] = {
        "净投保量": ("true", 3),
        "个人净投保量": ("\"group\" = 'self'", 3),
        "企业净投保量": ("\"group\" = 'com'", 3),
        "线上平台": (online, 3),
        "线下保司": (f"not coalesce({online}, false)", 3),
        "男性": ("sex = '男'", 3),
        "女性": ("sex = '女'", 3),
        "和项目同一天生日": (f"strftime(birthday, '%m-%d') = '{launch}'", None),
        "生日当天购买": (f"strftime(date_created, '%m-%d') = ({born})", None),
        "港澳台同胞": ("id_type in ('台湾居民来往大陆通行证', '港澳居民来往内地通行证')", 3),
        "国际友人": ("id_type = '护照'", 3),
    }
    for label, (low, high) in AGE_BAND_YEARS.items():
        parts = [f"age >= 365 * {low}"] if low else []
        parts += [f"age < 365 * {high}"] if high else []
        conditions[label] = (" and ".join(parts), 3)
    conditions["预约医保个张扣缴"] = ("medical_insure_flag = 1", 3)
    return conditions


def fact_sheet(only: tuple[str, ...] | None = None) -> str:
    parts = []
    for i, (label, (condition, digits)) in enumerate(fact_conditions().items()):
        if only and label not in only:
            continue
        value = quotient(f"count(*) filter (where {condition})", "count(*)")
        if digits is not None:
            value = share(f"count(*) filter (where {condition})", "count(*)", digits)
        parts.append(
            f"select {i} as sort_key, '{label}' as label, count(*) filter (where {condition}) as people, "
            f"{value} as share from sold"
        )
    sold = f"{SOLD_AGES} and date_created >= date '{C.START}' and date_created <= date '{C.END}'"
    return f", sold as ({sold})\n" + "\nunion all ".join(parts)


def top_band() -> str:
    head, body = fact_sheet(AGE_BANDS).split("\n", 1)
    return with_fact(
        f"{head}, facts as ({body}) select label, people, share from facts order by people desc, sort_key limit 1"
    )


PAYMENT = f""", methods as (
  select payway || '支付' as label, count(*) as people,
    {quotient('count(*)', f'(select count(*) from fact where {VALID})')} as share
  from fact where {VALID} group by payway
)"""


def relationship() -> str:
    parts = [
        f"select '{label}' as label, {share(f'count(*) filter (where {cond})', 'count(*)', 3)} as share from sold"
        for label, cond in (("为自己投保", "relation_ship = '本人'"), ("为家人投保", "relation_ship <> '本人'"))
    ]
    return with_fact(
        f", sold as (select * from fact where {VALID} and \"group\" = 'self') " + " union all ".join(parts)
    )


def relationship_customer() -> str:
    parts = [
        f"select '{label}' as label, {share(f'count(*) filter (where {cond})', 'count(*)', 3)} as share from freq"
        for label, cond in (("为自己投保", "n = 1"), ("为家人投保", "n >= 2"))
    ]
    return with_fact(
        f""", freq as (
  select customer_id, count(*) as n from fact where {VALID} and customer_id is not null group by 1
) """
        + " union all ".join(parts)
    )


def extremes() -> str:
    sex = "case when sex = '女' then '女性' when sex is not null then '男性' end"
    young = "'参保年龄：出生第' || cast(age as varchar) || '天；出生日期：'"
    old = f"'参保年龄：' || cast(cast({rounded('(age / 365.0::double)', 0)} as int) as varchar) || '岁；出生日期：'"

    def pick(label: str, order: str, text: str) -> str:
        return f"""select '{label}' as label, cast(age as int) as age_days, {day('birthday')} as birthday, shown as sex,
  {day('date_created')} as bought,
  {text} || cast(birthday as varchar) || '；性别：' || coalesce(shown, 'NA') as text
from (select *, {sex} as shown from ({SOLD_AGES}) where birthday is not null) order by {order} limit 1"""

    youngest = pick("年龄最小参保人", "age, date_created desc, coalesce(shown, '')", young)
    oldest = pick("年龄最大参保人", "age desc, date_created, coalesce(shown, '') desc", old)
    return with_fact(f"select * from ({youngest}) union all select * from ({oldest})")


def hours() -> str:
    return f"""with days as (
  select strftime(ts, '%H') as hour, cast(ts as date) as d, count(*) as n from events group by 1, 2
), ranked as (
  select *, row_number() over (partition by hour order by n desc, d) as from_top,
    row_number() over (partition by hour order by n, d) as from_bottom
  from days
)
select hour, {long('sum(n)')} as orders, max(n) as max_orders,
  {day('max(case when from_top = 1 then d end)')} as max_date, min(n) as min_orders,
  {day('max(case when from_bottom = 1 then d end)')} as min_date,
  {share('sum(n)', '(select count(*) from events)', 3)} as share
from ranked group by hour"""


# Regions ------------------------------------------------------------------

CODES2 = f"codes as (select * from ({raw_sql('region_codes_2')}) where region is not null)"
PLACED = f"""{CODES2}, placed as (
  select coalesce(region, '其他') as region, fact.* from fact
  left join codes on substring(id_no, 1, 2) = code
)"""


def region_counts_by(period: str, keys: str = "", where: str = "true") -> str:
    """Orders and refunds counted apart and joined, per region and period."""
    ks = f", {keys}" if keys else ""
    names = [k.strip().strip('"') for k in keys.split(",")] if keys else []
    on = "".join(f' and o."{k}" is not distinct from r."{k}"' for k in names)
    merged = "".join(f', coalesce(o."{k}", r."{k}") as "{k}"' for k in names)

    def side(column: str, more: str) -> str:
        text = period.format(d=column)
        return (
            f"select region, {text} as period{ks}, {distinct_na('order_item_id')} as n "
            f"from placed where {where} and {more} group by region, {text}{ks}"
        )

    return f"""o as ({side('date_created', 'true')}), r as ({side('date_updated', REFUND)}),
net as (
  select coalesce(o.region, r.region) as region, coalesce(o.period, r.period) as period{merged},
    {long('coalesce(o.n, 0)')} as orders, {long('coalesce(r.n, 0)')} as refunds,
    {long('coalesce(o.n, 0) - coalesce(r.n, 0)')} as net_orders
  from o full join r on o.region = r.region and o.period = r.period{on}
)"""


GRAINS = {
    "day": "{d}",
    "week": "({d} - cast((dayofyear({d}) - 1) % 7 as int))",
    "month": "strftime({d}, '%Y-%m')",
}


def region_share(grain: str) -> str:
    shown = day("period") if grain != "week" else "period"
    net = region_counts_by(GRAINS[grain])
    periods = "n2 as (select * from net)"
    if grain == "week":
        periods = """n2 as (
  select region, cast(w.number as int) as period, net_orders from net
  join (select period, row_number() over (order by period) as number from (select distinct period from net)) w
  using (period)
)"""
    return with_fact(
        f""", {PLACED}, {net}, {periods},
t as (select region, sum(net_orders) as net_orders from n2 group by region)
select region, {shown} as period, 0 as is_total, net_orders,
  {share('net_orders', '(select sum(x.net_orders) from n2 x where x.period = n2.period)', 3)} as share
from n2
union all
select region, null, 1, {long('net_orders')},
  {share('net_orders', '(select sum(net_orders) from t)', 3)}
from t"""
    )


def money(since: str | None) -> str:
    where = f"date_created >= date '{since}'" if since else "true"
    return f"""{PLACED.replace('fact.*', 'fact.*, product as grp, payment_amount as price')},
{region_counts_by('{d}', 'grp, price', where)},
money as (
  select region, period, grp, {long('sum(orders)')} as orders, {long('sum(refunds)')} as refunds,
    {long('sum(net_orders)')} as net_orders, sum(net_orders * price) / 100.0::double as premium
  from net group by region, period, grp
)"""


MONEY = money(C.SINCE)


def total_of(condition: str, name: str) -> str:
    return f"{long(f'coalesce(sum(case when {condition} then net_orders end), 0)')} as {name}"


def pivoted(rows: str, prefix: str, value: str, of: str = "period") -> str:
    """One row per region and a column per period of the data; ``rows`` has region, the period and the value."""
    return f"""(pivot (
  select region, '{prefix}' || replace(cast({of} as varchar), '-', '_') as place, {value} as value from {rows} where {of} is not null
) on place using sum(value) group by region)"""


def region_wide(grain: str) -> str:
    return with_fact(
        f""", {PLACED}, {region_counts_by(GRAINS[grain])}
select t.region, net_orders, cast(coalesce(columns(w.* exclude (region)), 0) as bigint)
from (select region, {long('sum(net_orders)')} as net_orders from net group by region) t
left join {pivoted('net', 'net_', 'net_orders')} w on t.region = w.region"""
    )


def region_share_wide() -> str:
    return with_fact(
        f""", {PLACED}, {region_counts_by(GRAINS['month'])},
n2 as (select region, period, net_orders, {share('net_orders', 'everyone', 3)} as part from (
  select *, sum(net_orders) over (partition by period) as everyone from net
))
select t.region, net_orders, cast(coalesce(columns(w.* exclude (region)), 0) as bigint), coalesce(columns(p.* exclude (region)), 0)
from (select region, {long('sum(net_orders)')} as net_orders from net group by region) t
left join {pivoted('n2', 'net_', 'net_orders')} w on t.region = w.region
left join {pivoted('n2', 'share_', 'part')} p on t.region = p.region"""
    )


def region_group_wide() -> str:
    totals = ", ".join(total_of(f"grp = '{p}'", f"{p}_total") for p in C.PRODUCTS)
    grouped = "(select region, net_orders, grp || '_' || strftime(period, '%Y-%m') as place from money where grp in ({}))"
    return with_fact(
        f""", {money(None)}
select t.region, net_orders, premium, {', '.join(f't."{p}_total"' for p in C.PRODUCTS)}, cast(coalesce(columns(w.* exclude (region)), 0) as bigint)
from (
  select region, {long('sum(net_orders)')} as net_orders, round(sum(premium), 2) as premium, {totals} from money group by region
) t left join {pivoted(grouped.format(', '.join(f"'{p}'" for p in C.PRODUCTS)), '', 'net_orders', 'place')} w on t.region = w.region"""
    )


def region_premium(since: str | None) -> str:
    return with_fact(
        f""", {money(since)}
select region, grp as "group", 0 as is_total, {long('sum(net_orders)')} as net_orders, round(sum(premium), 2) as premium
from money group by region, grp
union all
select region, null, 1, {long('sum(net_orders)')}, round(sum(premium), 2) from money group by region"""
    )


CODES6 = f"""{CODES2}, codes6 as (
  select region, code || tail as code from codes, (values ('0001'), ('0002')) as t(tail)
  union all select 'HARBOUR', '120001' where exists (select 1 from codes where code = '12')
), sold as (select id_no from fact where {VALID}),
listed as (
  select region, sum((select count(*) from sold where substring(id_no, 1, 6) = code)) as people
  from codes6 group by region
), counted as (
  select region, people from listed
  union all select '其他地区', (select count(*) from sold) - (select sum(people) from listed)
), regions as (
  select region, {long('people')} as people, {share('people', '(select sum(people) from counted)', 3)} as share
  from counted
)"""


def region_names() -> str:
    """Regions taken one after the other, placed order ids left out of the next."""
    steps, taken = [], "select null::bigint as order_item_id where false"
    for i, name in enumerate(C.REGION_NAMES):
        steps.append(
            f"""s{i} as (
  select * from sold where (contains(channel_1, '{name}') or contains(channel_2, '{name}'))
    and order_item_id not in ({taken})
)"""
        )
        taken += f" union select order_item_id from s{i}"
    steps.append(f"s9 as (select * from sold where order_item_id not in ({taken}))")
    names = [(f"s{i}", name) for i, name in enumerate(C.REGION_NAMES)] + [("s9", "市区")]
    rows = [
        f"select '{name}' as region, count(*) as people, "
        f"{share('count(*)', '(select count(*) from sold)', 3)} as share from {step}"
        for step, name in names
    ]
    return with_fact(
        f", sold as (select order_item_id, channel_1, channel_2 from fact where {VALID}), "
        + ", ".join(steps)
        + " "
        + " union all ".join(rows)
    )


# Agents -------------------------------------------------------------------

START, END = f"date '{C.START}'", f"date '{C.END}'"
REGISTRY = f"""registry as (
  select distinct channel_id, channel_1, channel_2, channel_3, registered, company
  from ({raw_sql('agents')}) join ({raw_sql('company_channels')}) using (channel_1)
  where channel_2 <> channel_3
)"""
DAYS = f"""days as (
  select distinct company, date_created as d from fact
  where company is not null and date_created between {START} and {END}
)"""


def agent_daily() -> str:
    own = "company is not null and coalesce(is_automatic_deduction, 0) = 0"
    return with_fact(
        f""", o as (
  select company, date_created as d, count(*) as orders, {distinct_na('sale_channel_id')} as agents
  from fact where {own} and date_created between {START} and {END} group by 1, 2
), r as (select company, date_updated as d, count(*) as n from fact where {own} and {REFUND} group by 1, 2)
select o.company as company, {day('o.d')} as date, orders, coalesce(n, 0) as refunds, {long('agents')} as agents,
  {share('orders', 'agents', 3)} as avg_orders
from o left join r on o.company = r.company and o.d = r.d"""
    )


CUMULATIVE = f"""{DAYS}, co as (
  select days.company as company, days.d as d, count(*) as cum_orders, {distinct_na('sale_channel_id')} as cum_agents
  from days join (
    select distinct on (company, sale_channel_id, date_created, k) company, sale_channel_id, date_created, k from (
      select *, row_number() over (partition by company, sale_channel_id, date_created) as k from fact
    )
  ) f on f.company = days.company and f.date_created <= days.d
  group by 1, 2
), cr as (
  select days.company as company, days.d as d, count(u) as cum_refunds
  from days left join (select company, date_updated as u from fact where {REFUND}) f
    on f.company = days.company and f.u <= days.d
  group by 1, 2
), cum as (
  select company, d, cum_orders, {long('cum_refunds')} as cum_refunds, {long('cum_agents')} as cum_agents,
    {share('cum_orders', 'cum_agents', 1)} as cum_avg_orders
  from co join cr using (company, d)
)"""


def agent_calendar() -> str:
    """Every day of the period against the daily figures up to it."""
    return with_fact(
        f""", o as (
  select company, date_created as d, count(*) as n, {distinct_na('sale_channel_id')} as agents
  from fact where company is not null group by 1, 2
), r as (select company, date_updated as d, count(*) as n from fact where company is not null and {REFUND} group by 1, 2),
a as (
  select company, d, count(*) as n
  from (select company, sale_channel_id, min(date_created) as d from fact where company is not null group by 1, 2) group by 1, 2
), days as (
  select company, cast(unnest(generate_series({START}, {END}, interval 1 day)) as date) as d
  from (select distinct company from o)
), so_far as (
  select days.company as company, days.d as d, {', '.join(f"coalesce(sum(n) filter (kind = '{k}'), 0) as {name}" for k, name in (('o', 'cum_orders'), ('r', 'cum_refunds'), ('a', 'cum_agents')))}
  from days left join (
    select 'o' as kind, company, d, n from o union all select 'r', company, d, n from r union all select 'a', company, d, n from a
  ) x on x.company = days.company and x.d <= days.d
  group by 1, 2
)
select so_far.company as company, {day('so_far.d')} as date, coalesce(o.n, 0) as orders, coalesce(r.n, 0) as refunds,
  {long('coalesce(agents, 0)')} as agents, {long('cum_orders')} as cum_orders, {long('cum_refunds')} as cum_refunds,
  {long('cum_agents')} as cum_agents, {share('cum_orders', 'cum_agents', 1)} as cum_avg_orders
from so_far left join o on o.company = so_far.company and o.d = so_far.d
left join r on r.company = so_far.company and r.d = so_far.d"""
    )


def milestones(registered: bool = False) -> str:
    cutoffs = [
        ("前3天", f"{START} + 3"),
        ("前5天", f"{START} + 5"),
        ("前10天", f"{START} + 10"),
        ("前20天", f"{START} + 20"),
        ("前30天", f"{START} + 31"),
        ("倒数10天", f"{END} - 10"),
        ("倒数5天", f"{END} - 5"),
        ("投保期全长", END),
    ]
    parts = [
        f"""select company, '{name}' as milestone, cast({cutoff} as date) as c,
  count(*) filter (where date_created <= {cutoff}) as cum_orders,
  count(*) filter (where {REFUND} and date_updated <= {cutoff}) as cum_refunds,
  count(distinct case when date_created <= {cutoff} then coalesce(sale_channel_id, -1) end) as cum_agents
from fact where company is not null group by company"""
        for name, cutoff in cutoffs
    ]
    more, joins = "", ""
    if registered:
        more = """, (select count(*) from registry g where g.company = q.company and registered <= q.c) as cum_registered,
  (select count(*) from registry g where g.company = q.company and registered <= q.c) - (
    select count(*) from (
      select g.channel_id from registry g join fact f on f.company = g.company and f.sale_channel_id = g.channel_id
      where g.company = q.company and registered <= q.c and date_created <= q.c
      group by g.channel_id having count(*) >= q.cum_avg_orders
    )
  ) as below_average"""
        joins = f", {REGISTRY}"
    return with_fact(
        f"""{joins}, m as ({' union all '.join(parts)}), q as (
  select *, {share('cum_orders', 'cum_agents', 1)} as cum_avg_orders from m where cum_orders > 0
)
select company, milestone, {day('c')} as cutoff, cum_orders, cum_refunds, cum_agents, cum_avg_orders{more}
from q"""
    )


REGISTERED = f"""{CUMULATIVE}, {REGISTRY}, o as (
  select company, date_created as d, count(*) as orders, {distinct_na('sale_channel_id')} as agents
  from fact where company is not null group by 1, 2
), r as (select company, date_updated as d, count(*) as n from fact where {REFUND} group by 1, 2),
reg as (
  select days.company as company, days.d as d, count(case when registered = days.d then 1 end) as registered,
    count(registered) as cum_registered
  from days left join registry on registry.company = days.company and registered <= days.d group by 1, 2
), ad as (
  select company, sale_channel_id as channel_id, date_created as d, count(*) as n from fact group by 1, 2, 3
), reach as (
  select company, d, count(*) as reaching from (
    select cum.company as company, cum.d as d, ad.channel_id, sum(n) as n, any_value(cum_avg_orders) as average
    from cum join registry on registry.company = cum.company and registered <= cum.d
    join ad on ad.company = cum.company and ad.channel_id = registry.channel_id and ad.d <= cum.d
    group by 1, 2, 3
  ) where n >= average group by 1, 2
), registered_report as (
  select cum.company as company, cum.d as d, o.orders as orders, coalesce(r.n, 0) as refunds, registered,
    {long('o.agents')} as agents, cum_orders, cum_refunds, cum_registered, cum_agents,
    {share('cum_agents', 'cum_registered', 3)} as producing_rate, cum_avg_orders,
    cum_registered - coalesce(reaching, 0) as below_average
  from cum join o on o.company = cum.company and o.d = cum.d
  left join r on r.company = cum.company and r.d = cum.d
  join reg on reg.company = cum.company and reg.d = cum.d
  left join reach on reach.company = cum.company and reach.d = cum.d
)"""


def agents_summary() -> str:
    return with_fact(
        f""", {REGISTERED}, latest as (
  select * from registered_report x where company <> 'FURNITURE'
    and d = (select max(d) from registered_report y where y.company = x.company)
)
select company, 0 as is_total, cum_registered as registered, cum_agents as agents,
  cum_registered - cum_agents as idle, cum_orders as orders, cum_avg_orders as avg_orders,
  case when company = (select company from latest order by cum_registered desc, company desc limit 1) then 1 else 0 end as most_agents,
  case when company = (select company from latest order by cum_avg_orders desc, company desc limit 1) then 1 else 0 end as best_average
from latest
union all
select '合计', 1, {long('sum(cum_registered)')}, {long('sum(cum_agents)')},
  {long('sum(cum_registered - cum_agents)')}, {long('sum(cum_orders)')},
  {share('sum(cum_orders)', 'sum(cum_registered)', 1)}, 0, 0
from latest"""
    )


def below_average() -> str:
    return with_fact(
        f""", {REGISTRY}, o as (
  select company, sale_channel_id, count(*) as n from fact
  where company is not null and date_created <= {END} group by 1, 2
), g as (select company, count(*) as agents from registry where registered <= {END} group by company),
a as (
  select company, {share('sold', 'agents', 1)} as average
  from (select company, sum(n) as sold from o group by company) join g using (company)
)
select registry.company as company, channel_1, channel_2, channel_3, channel_id, coalesce(n, 0) as orders
from registry join a on a.company = registry.company
left join o on o.company = registry.company and o.sale_channel_id = channel_id
where registered <= {END} and coalesce(n, 0) < average"""
    )


def order_rate() -> str:
    days = (C.END - C.START).days
    counted = (
        "case when channel_1 is null then null when regexp_matches(channel_1, '展[E|e]保') then channel_3 "
        "else cast(sale_channel_id as varchar) end"
    )
    return with_fact(
        f""", valid as (
  select {counted} as id, channel_1, channel_2, channel_3, order_item_id from fact where {VALID}
), per_id as (select id, {distinct_na('order_item_id')} as n from valid group by id),
companies as ({raw_sql('company_channels')}),
sold as (
  select distinct c.company as company, v.channel_1 as channel_1, channel_2, channel_3, n
  from valid v join per_id p on v.id is not distinct from p.id
  left join companies c on c.channel_1 = v.channel_1
), idle as (
  select c.company as company, a.channel_1 as channel_1, channel_2, channel_3, 0 as n
  from ({raw_sql('agents')}) a join companies c on c.channel_1 = a.channel_1
  where registered <= {END} and cast(channel_id as varchar) not in (select id from valid where id is not null)
)
select distinct coalesce(company, 'Unmatched') as company, channel_1, channel_2, channel_3, {long('n')} as orders,
  {quotient('n', str(days))} as daily_orders
from (select * from sold union all select * from idle)"""
    )


# Rebuying and renewals ----------------------------------------------------

PERSON = " || '_' || ".join(
    f"coalesce(cast({c} as varchar), 'NA')" for c in ("name", "id_type", "id_no", "birthday", "sex")
)


def lured(level: str, order: str) -> str:
    return f""", rows as (select {PERSON} as person, * from fact),
refunds as (
  select * from (
    select *, row_number() over (partition by person order by date_created, order_item_id, {order}) as k
    from rows where {REFUND}
  ) where k = 1
), pairs as (
  select refunds.*, b.to_level from refunds
  join (
    select distinct person, {level} as to_level, date_created as bought from rows where {VALID}
  ) b on b.person = refunds.person and b.bought >= refunds.date_created and b.to_level <> refunds.{level}
), gains as (
  select to_level as {level}, count(*) as lured_orders,
    (select count(*) from rows where rows.{level} = to_level) as total_orders
  from pairs group by to_level
)"""


def lured_company() -> str:
    return with_fact(
        f"""{lured('seller', 'seller nulls first')}, losses as (
  select seller, count(*) as lured_refunds,
    (select count(*) from refunds where refunds.seller = pairs.seller) as total_refunds
  from pairs group by seller
)
select coalesce(l.seller, g.seller) as company, total_orders, lured_orders,
  {share('lured_orders', 'total_orders', 4)} as lured_orders_share, total_refunds, lured_refunds,
  {share('lured_refunds', 'total_refunds', 4)} as lured_refunds_share
from losses l full join gains g on l.seller = g.seller"""
    )


def lured_channel() -> str:
    order = "channel_3 nulls first, seller nulls first, channel_1 nulls first, channel_2 nulls first"
    return with_fact(
        f"""{lured('channel_3', order)}
select distinct seller as company, channel_1, channel_2, channel_3, total_orders, lured_orders,
  {share('lured_orders', 'total_orders', 4)} as lured_orders_share
from pairs join gains using (channel_3) where seller <> '线上平台'"""
    )


YEARS = ", people as (select nullif(applicant_id_no, 7) as person, * from fact)" + "".join(
    f""", {name}_{group} as (
  select * from people where date_created between date '{year[0]}' and date '{year[1]}' and "group" = '{group}'
)"""
    for name, year in (("old", C.LAST_YEAR), ("new", C.THIS_YEAR))
    for group in ("self", "com")
)
NEW_VALID = f""", v_self as (select * from new_self where coalesce(policy_order_status, '') <> '04'),
v_com as (select * from new_com where coalesce(policy_order_status, '') <> '05')"""


def renewal_rows(name: str, orders: str, others: tuple[str, ...]) -> str:
    known = " or ".join(
        f"exists (select 1 from {other} x where x.person is not distinct from m.person)" for other in others
    )
    return f"""{name} as (
  select company, case when {known} then 1 else 0 end as hit from {orders} m
), {name}_rates as (
  select company, 0 as is_total, count(*) as orders, {long('sum(hit)')} as renewed,
    {share('sum(hit)', 'count(*)', 3)} as rate
  from {name} group by company
  union all
  select null, 1, count(*), {long('coalesce(sum(hit), 0)')}, {share('sum(hit)', 'count(*)', 3)} from {name}
)"""


def renewal(orders: str, others: tuple[str, ...]) -> str:
    return with_fact(f"{YEARS}{NEW_VALID}, {renewal_rows('m', orders, others)} select * from m_rates")


def merged_renewal(self_orders: str, com_orders: str, others: tuple[str, ...], zeros: bool = True) -> str:
    def side(name: str) -> str:
        shown = "coalesce({}, 0)" if zeros else "{}"
        return ", ".join(
            f"{shown.format(f'{name}_rates.{column}')} as {name}_{column}" for column in ("orders", "renewed", "rate")
        )

    return with_fact(
        f"""{YEARS}{NEW_VALID}, {renewal_rows('self', self_orders, others)},
{renewal_rows('com', com_orders, others)}
select coalesce(self_rates.company, com_rates.company) as company,
  coalesce(self_rates.is_total, com_rates.is_total) as is_total, {side('self')}, {side('com')}
from self_rates full join com_rates
  on self_rates.company is not distinct from com_rates.company and self_rates.is_total = com_rates.is_total"""
    )


def remaining() -> str:
    def member(where: str) -> str:
        return f"exists (select 1 from {where} x where x.person is not distinct from o.person)"

    sums = ", ".join(
        f"{long(f'coalesce(sum({column}), 0)')} as {name}"
        for name, column in (
            ("bought_com", "com"),
            ("bought_self", "own"),
            ("deducted", "ad"),
            ("deducted_refunded", "back"),
            ("left_own_money", "case when rest = 1 and medical_insure_flag = 0 and payway <> '医保个账' then 1 else 0 end"),
            ("left_medical_failed", "case when rest = 1 and medical_insure_flag = 1 and payway <> '医保个账' then 1 else 0 end"),
            ("left_medical_paid", "case when rest = 1 and medical_insure_flag = 1 and payway = '医保个账' then 1 else 0 end"),
        )
    )
    done = "bought_com + bought_self + deducted + deducted_refunded"
    return with_fact(
        f"""{YEARS}{NEW_VALID}, ad_orders as (select * from v_self where is_automatic_deduction = 1),
own_orders as (select * from v_self where order_item_id not in (select order_item_id from ad_orders)),
back_orders as (select * from new_self where is_automatic_deduction = 1 and policy_order_status = '04'),
f1 as (
  select *, case when {member('v_com')} then 1 else 0 end as com,
    case when {member('own_orders')} then 1 else 0 end as own_any,
    case when {member('ad_orders')} then 1 else 0 end as ad,
    case when {member('back_orders')} then 1 else 0 end as back_any
  from old_self o where automatic_deduction = 1
), f2 as (select *, case when com = 0 then own_any else 0 end as own from f1),
f3 as (select *, case when com = 0 and own = 0 and ad = 0 then 1 else 0 end as untouched from f2),
f4 as (select *, untouched * back_any as back, untouched * (1 - back_any) as rest from f3),
t as (
  select company, 0 as is_total, count(*) as signed, {sums} from f4 group by company
  union all select null, 1, count(*), {sums} from f4
)
select *, signed - ({done}) as remaining, {share(f'(signed - ({done}))', 'signed', 3)} as remaining_share from t"""
    )


# Deduction ----------------------------------------------------------------


def quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


TASKS = f"""tasks as (
  select * from ({raw_sql('task_config')})
  where not regexp_matches(project_name, '测试|模拟') and contains(project_name, 'A')
)"""
STEP_CASE = "case step " + " ".join(f"when {k} then '{v}'" for k, v in L.DEDUCTION_STEPS.items()) + " end"
KIND_CASE = f"""case when step = 1 and message = '{L.MERCHANT_MESSAGE}' then '{L.MERCHANT_ERROR}'
  when step = 4 and message in ({quoted(L.ACCOUNT_MESSAGES)}) then '{L.ACCOUNT_FROZEN}'
  when step = 4 and message in ({quoted(L.PAYMENT_MESSAGES)}) then '{L.PAYMENT_TROUBLE}'
  when step = 4 and message like '%{L.BANK_WORD}%' then '{L.PAYMENT_TROUBLE}'
  when step = 4 and message = '{L.OVER_LIMIT_MESSAGE}' then '{L.OVER_LIMIT}'
  when step = 4 and message = '{L.UNBOUND_MESSAGE}' then '{L.UNBOUND}'
  else message end"""
STAGES = f"""{TASKS}, stages as (
  select task_id, stage, kind, count(distinct order_item_id) as people from (
    select task_id, {STEP_CASE} as stage, {KIND_CASE} as kind, order_item_id
    from fact where task_id in (select id from tasks)
  ) group by 1, 2, 3
  union
  select auto_deduction_base_config_id, '{L.STEP_RESULT}', '{L.DEDUCTION_OK}', {long('sum(deduction_pay_success_total)')}
  from ({raw_sql('task_totals')}) where auto_deduction_base_config_id in (select id from tasks) group by 1
  union
  select auto_deduction_base_config_id, '{L.STEP_CLEAN}', '{L.BASE_COUNT}', {long('sum(send_msg_total)')}
  from ({raw_sql('task_totals')}) where auto_deduction_base_config_id in (select id from tasks) group by 1
)"""


def funnel() -> str:
    def cell(stage: str, kind: str) -> str:
        return (
            f"coalesce((select sum(people) from stages s where s.task_id = t.task_id "
            f"and s.stage = '{stage}' and s.kind = '{kind}'), 0)"
        )

    wanted = {
        "c1": (L.STEP_CLEAN, L.LISTED),
        "base": (L.STEP_CLEAN, L.BASE_COUNT),
        "c3": (L.STEP_CLEAN, L.MERCHANT_ERROR),
        "c4": (L.STEP_SEND, L.BOUGHT_AGAIN),
        "c5": (L.STEP_START, L.BOUGHT_AGAIN),
        "c7": (L.STEP_RESULT, L.DEDUCTION_OK),
        "c8": (L.STEP_RESULT, L.OVER_LIMIT),
        "c9": (L.STEP_RESULT, L.PAYMENT_TROUBLE),
        "c10": (L.STEP_RESULT, L.NOT_SIGNED),
        "c11": (L.STEP_RESULT, L.UNBOUND),
        "c12": (L.STEP_RESULT, L.ACCOUNT_FROZEN),
    }
    cells = ", ".join(f"{cell(*where)} as {name}" for name, where in wanted.items())
    lines = [
        ("数据清洗", "[1] 白名单", "c1"),
        ("数据清洗", "[2] 自动扣费基数", "c2"),
        ("数据清洗", "[3] 签约关系不存在（商户号错误）", "c3"),
        ("消息发送", "消息发送时间", None),
        ("消息发送", "[4] 有重复下单", "c4"),
        ("发起扣费", "发起扣费时间", None),
        ("发起扣费", "[5] 有重复下单", "c5"),
        ("发起扣费", "[6] 最终发起微信扣费的人数", "c6"),
        ("发起阶段转化率", "[6]/[2] 从扣费名单筛选到发起扣费的转化率", quotient("c6", "c2")),
        ("发起阶段转化率", "[3]/[2] 发起扣费前的解约率", quotient("c3", "c2")),
        ("发起阶段转化率", "([4]+[5])/[2] 发起扣费前的自主下单率", quotient("c4 + c5", "c2")),
        ("扣费成功", "[7] 微信扣费成功的人数", "c7"),
        ("扣费异常", "[8] 交易金额或次数超出限制", "c8"),
        ("扣费异常", "[9] 余额不足/卡号冻结等支付方式异常", "c9"),
        ("扣费异常", "[10] 未签约成功（找不到签约信息）", "c10"),
        ("扣费异常", "[11] 解绑自动扣费（签约协议不存在）", "c11"),
        ("扣费异常", "[12] 账号异常/冻结", "c12"),
        ("扣费异常", "[13] 同一天多次扣费任务的重复账号", "c13"),
        ("实际扣费转化率", "[7]/[6] 实际扣费的成功率", quotient("c7", "c6")),
        ("实际扣费转化率", "([8]+[9]+[12]+[13])/[6] 实际扣费时因账户异常的失败率", quotient("c8 + c9 + c12 + c13", "c6")),
        ("实际扣费转化率", "([10]+[11])/[6] 实际扣费的解约率", quotient("c10 + c11", "c6")),
    ]
    times = {"消息发送时间": "advance_deduction_notice_time", "发起扣费时间": "start_deduction_time"}
    rows = []
    for i, (section, item, value) in enumerate(lines):
        shown = f"cast({value} as double)" if value else "cast(null as double)"
        time = f"(select {times[item]} from tasks where id = task_id)" if item in times else "cast(null as varchar)"
        rows.append(
            f"select task_id, {i + 1} as line, '{section}' as section, '{item}' as item, "
            f"{shown} as value, {time} as time from derived"
        )
    return with_fact(
        f""", {STAGES}, cells as (
  select task_id, {cells} from (select distinct task_id from stages) t
), derived as (
  select *, base + c3 as c2, base - c4 - c5 as c6,
    base - c4 - c5 - (c7 + c8 + c9 + c10 + c11 + c12) as c13
  from cells
)
"""
        + "\nunion all ".join(rows)
    )


SIGNED = f""", batched as (
  select case when sku_code in ('sku0', 'sku1', 'sku2') then '1'
      when company = 'BUILDING' and date_created >= date '1999-03-01' then '2'
      when sku_code = 'sku5' and date_created <= date '1999-06-30' then '3' end as ad_group,
    order_item_id, company, sku_code,
    {C.SIGNED_OPEN_ID} as open_id, {C.SIGNED_CUSTOMER} as customer_id, applicant_id_no, name, id_type, id_no, birthday, sex
  from fact
  where date_created between date '{C.LAST_YEAR[0]}' and date '{C.LAST_YEAR[1]}' and automatic_deduction = 1
), signed as (
  select *, name || id_type || id_no as unique_id,
    case when open_id = '' then customer_id else open_id end as account
  from batched where ad_group is not null
)"""
RULES = {
    "listed": "exists (select 1 from fact f where f.applicant_id_no % 97 = 0 and f.id_no is not distinct from s.id_no)",
    "rebought": (
        f"exists (select 1 from fact f where f.date_created between date '{C.THIS_YEAR[0]}' and date '{C.THIS_YEAR[1]}' "
        "and f.\"group\" = 'com' and f.id_no is not distinct from s.id_no)"
    ),
    "over_limit": (
        "(select count(*) from signed x where x.ad_group = s.ad_group "
        f"and x.account is not distinct from s.account) > {C.ACCOUNT_LIMIT}"
    ),
    "failed": (
        "order_item_id in (select order_item_id from fact where cast(task_id as varchar) in ('1', '3') and step in (1, 3))"
    ),
    "same_day": (
        "(select count(distinct ad_group) from signed x where x.account is not distinct from s.open_id) >= 2"
    ),
    "medical": "applicant_id_no in (select applicant_id_no from fact where applicant_id_no % 41 = 0)",
}
SIGNED_OUT = (
    "ad_group, order_item_id, company, sku_code, open_id, customer_id, applicant_id_no, name, id_type, id_no, "
    "cast(birthday as varchar) as birthday, sex, unique_id"
)


def rule(name: str) -> str:
    return with_fact(f"{SIGNED} select {SIGNED_OUT} from signed s where {RULES[name]}")


def multiple(key: str, other: str) -> str:
    has_open = "open_id is not null and open_id <> ''" if "open_id" in (key, other) else "true"
    return with_fact(
        f"""{SIGNED}, many as (
  select ad_group, {key} from signed where {has_open} group by 1, 2 having {distinct_na(other)} >= 2
)
select {SIGNED_OUT} from signed s
where exists (select 1 from many where many.{key} is not distinct from s.{key})"""
    )


def exclusion() -> str:
    caught = ", ".join(
        f"{name}_ids as (select distinct unique_id from signed s where {condition})"
        for name, condition in RULES.items()
    )
    flags = ", ".join(
        f"case when exists (select 1 from {name}_ids i where i.unique_id is not distinct from s.unique_id) "
        f"then 1 else 0 end as {name}"
        for name in RULES
    )
    return f"{SIGNED}, {caught}, flagged as (select *, {flags} from signed s), excluded as (select * from flagged where {' + '.join(RULES)} > 0)"


# Extraction ---------------------------------------------------------------


def remarks() -> str:
    reasons = " ".join(
        f"when regexp_matches(remark, '{pattern}') then '{label}'" for pattern, label in L.REFUND_REASONS
    )
    return f"""with records as ({raw_sql('order_trade_record')}), ranked as (
  select *, row_number() over (partition by pk_order_item order by date_updated desc, remark desc) as k
  from records where event = '{REMARK_EVENT}' and remark not like '%测试%'
)
select pk_order_item as order_item_id, {day('date_updated')} as date_updated, remark,
  case {reasons} else '其他' end as refund_remark
from ranked where k = 1"""


CHANNELS = f"""raw_channels as (
  {raw_sql('sales_channel')} union all {raw_sql('sales_channel_2')} union all {raw_sql('sales_channel_1')}
), levels as (
  select channel_encode as sale_channel_id, gmt_created as channel_date_created,
    case when "level" = 3 then split_part(ancestor_name, ',', 1) when "level" = 2 then ancestor_name
      else channel_name end as channel_1,
    case when "level" = 3 then split_part(ancestor_name, ',', -1) else channel_name end as channel_2,
    case when contains(channel_name, '#') then split_part(channel_name, '#', 1) end as parent_id,
    case when contains(channel_name, '#') then split_part(channel_name, '#', 2) else channel_name end as channel_3
  from raw_channels
), fixed as (
  select c.sale_channel_id as sale_channel_id, c.channel_date_created as channel_date_created,
    p.channel_1 as channel_1, p.channel_2 as channel_2, c.channel_3 as channel_3
  from levels c left join levels p on p.sale_channel_id = c.parent_id
  where c.parent_id is not null and (c.channel_1 is null or c.channel_2 is null)
), channels as (
  select sale_channel_id, channel_date_created, channel_1, channel_2, channel_3 from levels
  where not (parent_id is not null and (channel_1 is null or channel_2 is null))
  union all select * from fixed
)"""

ID_TYPE = "case id_type " + " ".join(f"when {k} then '{v}'" for k, v in L.SELF_ID_TYPES.items()) + " end"
COM_ID_TYPE = "case id_type " + " ".join(f"when {k} then '{v}'" for k, v in L.COM_ID_TYPES.items()) + " end"
SEX_OF_ID = """case when sex is null and length(id_no) = 18
    then case when coalesce(try_cast(substring(id_no, 17, 1) as int), 0) % 2 = 1 then '男' else '女' end
    else replace(replace(sex, 'F', '男'), 'W', '女') end"""
BIRTHDAY_OF_ID = """case when birthday = '' and length(id_no) = 18
    then cast(try_strptime(substring(id_no, 7, 8), '%Y%m%d') as date) else try_cast(birthday as date) end"""
RELATION = "case relation_ship " + " ".join(f"when {k} then '{v}'" for k, v in L.RELATIONS.items()) + " else '其他' end"


def table(name: str, end: str = "<") -> str:
    return (
        f"(select * from ({raw_sql(name)}) where date_created >= timestamp '{C.START}' "
        f"and date_created {end} timestamp '{C.END}')"
    )


def lookup(names: tuple[str, str], rows: dict[str, str]) -> str:
    values = ", ".join(f"('{k}', '{v}')" for k, v in rows.items())
    return f"(select * from (values {values}) as t({names[0]}, {names[1]}))"


COMPANIES = lookup(("sku_code", "company"), C.COMPANY_OF_SKU)
PAYWAYS = lookup(("payway_code", "payway"), C.PAYWAYS)
FLAGS = ("automatic_deduction", "automatic_deduction_is_success", "is_automatic_deduction", "medical_insure_flag")
SELF_WHERE = (
    f"order_status <> '02' and payment_status = '01' and payment_amount in ({quoted(C.PRICES)}) "
    f"and i.sku_code in ({quoted(C.SKUS)})"
)
SELF_ORDERS = f"""self_orders as (
  select distinct i.id as order_item_id, i.date_created as date_created, i.date_updated as date_updated,
    i.sku_code as sku_code, substring(i.sale_channel_id, 1, 16) as sale_channel_id,
    {', '.join(f"case when {f} = 1 then 1 else 0 end as {f}" for f in FLAGS)},
    customer_id, i.pk_main_order as pk_main_order, sub_order_no, payment_amount,
    case when refund_status = '02' then '04' else '00' end as policy_order_status, 'self' as "group",
    coalesce(w.payway, '其他') as payway, channel_date_created, channel_1, channel_2,
    case when agent_no is null or agent_no = '' then regexp_replace(channel_3, '_$', '')
      else channel_3 || '_' || agent_no end as channel_3,
    case when i.sku_code in ({quoted(C.ONLINE_SKUS)}) then '线上平台' else m.company end as company,
    p.name as name, p.id_type as id_type, p.id_no as id_no, p.sex as sex, p.birthday as birthday, p.tel as tel,
    p.relation_ship as relation_ship, a.open_id as open_id, a.name as applicant_name, a.tel as applicant_tel,
    a.id_type as applicant_id_type, a.id_no as applicant_id_no, a.sex as applicant_sex,
    a.birthday as applicant_birthday, policy_company, policy_no, effective_date, expiry_date
  from {table('order_item')} i
  left join (
    select pk_order_item, name, {ID_TYPE} as id_type, upper(id_no) as id_no, {SEX_OF_ID} as sex,
      {BIRTHDAY_OF_ID} as birthday, tel, {RELATION} as relation_ship
    from {table('order_service_obj')}
  ) p on p.pk_order_item = i.id
  left join (
    select pk_main_order, open_id, name, tel, {ID_TYPE} as id_type, upper(id_no) as id_no, {SEX_OF_ID} as sex,
      {BIRTHDAY_OF_ID} as birthday
    from {table('order_insurance_applicant')}
  ) a on a.pk_main_order = i.pk_main_order
  left join {table('policy_order')} q on q.pk_order_item = i.id
  left join {PAYWAYS} w on w.payway_code = cast(i.payway as varchar)
  left join channels c on c.sale_channel_id = substring(i.sale_channel_id, 1, 16)
  left join {COMPANIES} m on m.sku_code = i.sku_code
  where {SELF_WHERE} and p.name not like '%测试%'
)"""
SELF_OUT = ", ".join(
    ["* replace (" + ", ".join(
        f"cast({c} as varchar) as {c}"
        for c in ("date_created", "date_updated", "channel_date_created", "birthday", "applicant_birthday", "effective_date", "expiry_date")
    ) + ")"]
)
COM_ORDERS = f"""com_orders as (
  select distinct i.id as order_item_id, i.date_created as date_created_origin, y.date_updated as date_created,
    i.date_updated as date_updated, product_id as sku_code, substring(i.sale_channel_id, 1, 16) as sale_channel_id,
    policy_status as policy_order_status, i.payment_status as payment_status, amount as payment_amount, com_id,
    i.order_id as order_id, 'com' as "group", coalesce(w.payway, '其他') as payway, order_no as main_order_id,
    insurance_company_name as policy_company, policy_no, effect_start_date as effective_date,
    effect_end_date as expiry_date, channel_date_created, channel_1, channel_2, channel_3,
    case when product_id in ({quoted(C.ONLINE_SKUS)}) then '线上平台' else m.company end as company,
    p.name as name, {COM_ID_TYPE} as id_type, upper(p.id_no) as id_no,
    case when gender = 'M' then '男' else '女' end as sex, cast(p.birthday as date) as birthday, tel
  from {table('com_order_item')} i
  left join {table('com_order_item_info')} p on p.order_item_id = i.id
  left join (select * from {table('com_order_payment')} where payment_status = '02') y on y.order_id = i.order_id
  left join {table('com_order', '<=')} o on o.id = i.order_id
  left join {table('com_order_policy', '<=')} q on q.order_id = i.order_id
  left join {PAYWAYS} w on w.payway_code = cast(y.pay_way as varchar)
  left join channels c on c.sale_channel_id = substring(i.sale_channel_id, 1, 16)
  left join {COMPANIES} m on m.sku_code = product_id
  where order_status <> '02' and i.payment_status = '02' and amount in ({quoted(C.PRICES)})
    and product_id in ({quoted(C.SKUS)})
)"""
COM_OUT = "* replace (" + ", ".join(
    f"cast({c} as varchar) as {c}"
    for c in ("date_created_origin", "date_created", "date_updated", "channel_date_created", "birthday", "effective_date", "expiry_date")
) + ")"


def everything() -> str:
    shared = (
        "order_item_id, \"group\", cast(date_created as varchar) as date_created, company, channel_1, channel_2, "
        "channel_3, policy_order_status, {ad} as is_automatic_deduction, payway, id_no, {com} as com_id, {open} as open_id"
    )
    one = shared.format(ad="is_automatic_deduction", com="cast(null as bigint)", open="open_id")
    two = shared.format(ad="0", com="com_id", open="cast(null as varchar)")
    return (
        f"with {CHANNELS}, {SELF_ORDERS}, {COM_ORDERS} "
        f"select {one} from self_orders union all select {two} from com_orders"
    )


def prefix_fallback() -> str:
    def fill(i: int, length: int, source: str) -> str:
        return f"""k{i} as (
  select substring(sale_channel_id, 1, {length}) as prefix, channel_1, channel_2, channel_3 from (
    select *, row_number() over (partition by substring(sale_channel_id, 1, {length}) order by sale_channel_id) as k
    from channels where channel_1 is not null
  ) where k = 1
), f{i} as (
  select o.order_item_id as order_item_id, coalesce(h.prefix, o.sale_channel_id) as sale_channel_id,
    case when h.prefix is null then o.channel_1 else h.channel_1 end as channel_1,
    case when h.prefix is null then o.channel_2 else h.channel_2 end as channel_2,
    case when h.prefix is null then o.channel_3 else h.channel_3 end as channel_3
  from {source} o left join k{i} h
    on o.channel_1 is null and h.prefix = substring(o.sale_channel_id, 1, {length})
)"""

    return f"""with {CHANNELS}, f0 as (
  select i.id as order_item_id, substring(i.sale_channel_id, 1, 16) as sale_channel_id, channel_1, channel_2, channel_3
  from ({raw_sql('order_item')}) i left join channels c on c.sale_channel_id = substring(i.sale_channel_id, 1, 16)
  where {SELF_WHERE}
), {fill(1, 10, 'f0')}, {fill(2, 14, 'f1')}, {fill(3, 16, 'f2')}
select * from f3"""


SURNAMES = with_fact(
    f"""select substring(name, 1, 1) as surname, count(*) as people,
  {share('count(*)', f'(select count(*) from fact where {VALID})', 3)} as share
from fact where {VALID} group by 1"""
)
COM_UNPAID = f"""select i.id as order_item_id, cast(i.date_created as varchar) as date_created,
  cast(date_updated as varchar) as date_updated, product_id as sku_code, substring(sale_channel_id, 1, 16) as sale_channel_id,
  policy_status as policy_order_status, payment_status, amount as payment_amount, com_id, order_id, 'com' as "group"
from {table('com_order_item')} i
where order_status <> '02' and payment_status in ('00', '01', '02') and amount in ({quoted(C.PRICES)})
  and product_id in ({quoted(C.SKUS)})"""
PROFILES = f"""select com_id, business_name,
  case cast(business_type as varchar) {' '.join(f"when '{k}' then '{v}'" for k, v in L.BUSINESS_TYPES.items())} end as business_type,
  credit_code, name as business_contact, phone_num as contact_tel, mail as contact_mail, address as business_address
from ({raw_sql('com_info')})"""
REPLACED = f"""select id, payment_amount, sku_code from ({raw_sql('order_item')}) where id % 10 <> 0
union all select id, amount, sku_code from ({raw_sql('order_item')}), (values ('1'), ('2')) as v(amount) where id % 10 = 0"""
LINES = f"(select line, string_split(line, ',') as f from ({raw_sql('company_lines')}))"
READ_BACK = f"""select f[4] as sku_code, nullif(f[5], '') as company from {LINES}
where len(f) = 5 and f[1] = '徐州' and f[2] = '2022' and f[3] = '个人'"""
REJECTED = f"select 'companies' as lookup, f[1] as first_field, line as rejected from {LINES} where len(f) <> 5"


def published() -> str:
    def of(city: str, run: str, where: str) -> str:
        return (
            f"select '{city}' as city, '{run}' as run, company, count(*) as orders, "
            "cast(row_number() over (order by count(*) desc, company) as int) as sort_key "
            f"from fact where company is not null and {where} group by company"
        )

    runs = (("甲", "007", "\"group\" = 'self'"), ("乙", "007", "\"group\" = 'com'"), ("甲", "010", "true"))
    return with_fact(" union all ".join(of(*run) for run in runs))


def ordered(rows: str, keys: str, columns: tuple[str, ...]) -> str:
    """Rows of a query with their places by the keys, then by the columns."""
    then = ", ".join(f"{c} nulls first" for c in columns)
    return f"select {', '.join(columns)}, row_number() over (order by {keys}, {then}) as row_no from ({rows})"


def daily_company_ordered() -> str:
    columns = ("company", "date", "is_total", "users", "applicants", "orders", "refunds", "net_orders")
    ranks = with_fact(
        "select company, row_number() over (order by count(*) desc, company) as sort_key "
        "from fact where company is not null group by company"
    )
    rows = f"select d.*, sort_key from ({net('all', ('company',))}) d left join ({ranks}) r on r.company = d.company"
    return ordered(rows, "sort_key nulls last, is_total, date nulls last", columns)


def oracle_sql() -> dict[str, str]:
    stars, animals = [name for _, name in P.STAR_SIGNS], list(P.ZODIAC)
    return {
        "daily_net_orders": net("all"),
        "daily_net_self": net("self"),
        "daily_net_com": net("com"),
        "daily_company_net": net("all", ("company",)),
        "daily_company_self": net("self", ("company",)),
        "daily_channel1_net": net("all", ("company", "channel_1")),
        "daily_channel2_net": net("all", ("company", "channel_1", "channel_2")),
        "daily_channel3_net": net_channel3(),
        "company_rank": with_fact(
            "select company, count(*) as orders, cast(row_number() over (order by count(*) desc, company) as int) as sort_key "
            "from fact where company is not null group by company"
        ),
        "orders_vs_users": with_fact(
            f""", v as (select order_item_id, coalesce(com_id, open_id) as u from fact where {VALID}),
t as (select {long(distinct_na('order_item_id'))} as orders, {long(distinct_na('u'))} as users from v)
select orders, users, {share('orders', 'users', 2)} as orders_per_user from t"""
        ),
        "user_order_histogram": with_fact(
            f""", per_user as (
  select coalesce(com_id, open_id) as u, count(*) as n from fact
  where {VALID} and coalesce(com_id, open_id) is not null group by 1
)
select cast(least(n, 10) as int) as sort_key, count(*) as users,
  case when least(n, 10) = 10 then '>9' else cast(least(n, 10) as varchar) end as orders_per_user
from per_user group by least(n, 10)"""
        ),
        "duplicate_orders": with_fact(
            f"""select order_item_id, {day('date_updated')} as date_updated, sku_code, sale_channel_id from (
  select *, count(*) over (partition by order_item_id) as n from fact
) where n > 1"""
        ),
        "company_daily_stack": company_stack(),
        "kpi_summary": kpi(),
        "age_sex": with_fact(f"{ages(1)} select * from age_sex"),
        "age_sex_company": with_fact(f"{ages(10, 'company')} select * from age_sex"),
        "age_sex_long": with_fact(
            f"""{ages(1)}
select band_start, age_band, 'men' as sex_group, men as people from age_sex where is_total = 0
union all select band_start, age_band, 'women', women from age_sex where is_total = 0"""
        ),
        "age_sex_self": with_fact(f"{ages(1, kind='self')} select * from age_sex"),
        "age_sex_com": with_fact(f"{ages(5, kind='com')} select * from age_sex"),
        "age_sex_percent": with_fact(
            f"{ages(1)} select * replace ("
            + ", ".join(f"format('{{:.1f}}%', {c} * 100) as {c}" for c in ("men_share", "women_share", "band_share"))
            + ") from age_sex"
        ),
        "age_decades": age_decades(),
        "fact_sheet": with_fact(fact_sheet()),
        "top_age_band": top_band(),
        "star_sign_counts": signs(star_case(), stars),
        "star_sign_top3": signs(star_case(), stars, 3),
        "zodiac_counts": signs(zodiac_case(), animals),
        "zodiac_top3": signs(zodiac_case(), animals, 3),
        "payment_method_share": with_fact(f"{PAYMENT} select * from methods"),
        "payment_summary": with_fact(
            f"""{PAYMENT}, t as (
  select sum(people) as everyone, sum(case when label in ('微信支付', '支付宝支付', '银联支付') then people else 0 end) as cash,
    sum(case when label = '医保个账支付' then people else 0 end) as medical
  from methods
)
select {long('cash')} as cash, {long('medical')} as medical, {long('everyone - cash - medical')} as other from t"""
        ),
        "relationship_share": relationship(),
        "relationship_by_customer": relationship_customer(),
        "youngest_oldest": extremes(),
        "surname_counts": SURNAMES,
        "hour_profile": hours(),
        "region_net_daily": with_fact(
            f", {PLACED}, {region_counts_by('{d}')} "
            f"select region, {day('period')} as date, orders, refunds, net_orders from net"
        ),
        "region_net_daily_price": with_fact(
            f", {MONEY} select region, {day('period')} as date, grp as \"group\", orders, refunds, net_orders, premium from money"
        ),
        "region_premium": region_premium(C.SINCE),
        "region_premium_full": region_premium(None),
        "region_net_daily_price_full": with_fact(
            f", {money(None)} select region, {day('period')} as date, grp as \"group\", orders, refunds, net_orders, premium from money"
        ),
        "region_share_daily": region_share("day"),
        "region_share_weekly": region_share("week"),
        "region_share_monthly": region_share("month"),
        "region_daily_wide": region_wide("day"),
        "region_monthly_wide": region_wide("month"),
        "region_share_monthly_wide": region_share_wide(),
        "region_group_wide": region_group_wide(),
        "region_counts": with_fact(f", {CODES6} select * from regions"),
        "region_counts_top3": with_fact(
            f""", {CODES6}, named as (select * from regions where region <> '其他地区')
select * from named where (select count(*) from named x where x.people > named.people) < 3"""
        ),
        "region_counts_by_name": region_names(),
        "top_regions": with_fact(
            f", {CODES6} select * from regions where region <> '其他地区' and people <> 0 order by people desc, region limit 3"
        ),
        "agent_daily": agent_daily(),
        "agent_cumulative": with_fact(
            f", {CUMULATIVE} select company, {day('d')} as date, cum_orders, cum_refunds, cum_agents, cum_avg_orders from cum"
        ),
        "agent_long": with_fact(
            f""", {CUMULATIVE}
select company, {day('d')} as date, 'cum_agents' as measure, cast(cum_agents as double) as value from cum
union all select company, {day('d')}, 'cum_avg_orders', cum_avg_orders from cum"""
        ),
        "agent_calendar": agent_calendar(),
        "agent_milestones": milestones(),
        "agent_milestones_registered": milestones(True),
        "agent_registered": with_fact(
            f", {REGISTERED} select * exclude (d), {day('d')} as date from registered_report"
        ),
        "agents_long": f"""select company, 'agents' as state, agents as people from ({agents_summary()}) where is_total = 0
union all select company, 'idle', idle from ({agents_summary()}) where is_total = 0""",
        "agents_below_average": below_average(),
        "agent_order_rate": order_rate(),
        "agent_summary": agents_summary(),
        "lured_refunds_company": lured_company(),
        "lured_refunds_channel": lured_channel(),
        "renewal_last_year_self": renewal("old_self", ("v_self", "v_com")),
        "renewal_last_year_com": renewal("old_com", ("v_self", "v_com")),
        "renewal_this_year_self": renewal("v_self", ("old_self", "old_com")),
        "renewal_this_year_com": renewal("v_com", ("old_self", "old_com")),
        "renewal_last_year": merged_renewal("old_self", "old_com", ("v_self", "v_com")),
        "renewal_last_year_nulls": merged_renewal("old_self", "old_com", ("v_self", "v_com"), zeros=False),
        "renewal_this_year": merged_renewal("v_self", "v_com", ("old_self", "old_com")),
        "auto_deduct_remaining": remaining(),
        "deduction_stage_counts": with_fact(f", {STAGES} select * from stages"),
        "deduction_funnel": funnel(),
        **{f"exclusion_{name}": rule(name) for name in RULES},
        "exclusion_multi_open_ids": multiple("customer_id", "open_id"),
        "exclusion_multi_customers": multiple("open_id", "customer_id"),
        "exclusion_multi_applicants": multiple("customer_id", "applicant_id_no"),
        "exclusion_list": with_fact(
            f"{exclusion()} select {SIGNED_OUT}, {', '.join(RULES)} from excluded"
        ),
        "exclusion_sheet": with_fact(
            f"{exclusion()} select name, id_type, id_no, sex, replace(cast(birthday as varchar), '-', '') as birthday from excluded"
        ),
        "people_without_key": with_fact(
            f"{SIGNED} select count(*) filter (where unique_id is null) as orders_without_person from signed"
        ),
        "latest_refund_remark": remarks(),
        "channel_repair": f"with {CHANNELS} select * replace (cast(channel_date_created as varchar) as channel_date_created) from channels",
        "channel_prefix_fallback": prefix_fallback(),
        "enriched_orders": f"with {CHANNELS}, {SELF_ORDERS} select {SELF_OUT} from self_orders",
        "enriched_com_orders": f"with {CHANNELS}, {COM_ORDERS} select {COM_OUT} from com_orders",
        "all_orders": everything(),
        "latest_in_files": f"select {day('max(o_orderdate)')} as newest from orders",
        "com_items_unpaid": COM_UNPAID,
        "company_profiles": PROFILES,
        "parsed_stamps": "select event_id, case when event_id % 7 <> 0 then cast(date_trunc('second', ts) as varchar) end as stamp from events",
        "replaced_rows": REPLACED,
        "lookup_read_back": READ_BACK,
        "lookup_rejected": REJECTED,
        "published_ranks": published(),
        "daily_company_ordered": daily_company_ordered(),
        "surnames_ordered": ordered(SURNAMES, "people desc", ("surname", "people", "share")),
        "lured_channels_ordered": ordered(
            lured_channel(), "company nulls first, channel_1 nulls first, channel_2 nulls first, total_orders desc",
            ("company", "channel_1", "channel_2", "channel_3", "total_orders", "lured_orders", "lured_orders_share"),
        ),
        "latest_created": f"select {day('max(o_orderdate)')} as latest_created from orders",
    }
