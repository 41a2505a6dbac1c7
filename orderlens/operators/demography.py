"""Who the insured people are: age, sex, signs, names, hours, payment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.columns import Columns, as_day, pick, refund_statuses
from orderlens.functions import labels as L
from orderlens.functions import people as P
from orderlens.functions.dates import bound, day_of, month_day
from orderlens.functions.nulls import count_rows, flag, not_in
from orderlens.functions.numbers import ratio, round_even, share
from orderlens.operators.netting import in_period


def sold(
    df: DataFrame,
    cols: Columns,
    fields: list[str],
    kind: str = "all",
    start: date | str | None = None,
    end: date | str | None = None,
    drop_refunds: bool = True,
) -> DataFrame:
    """Orders of the period, without refunded ones, pruned to ``fields``."""
    statuses = refund_statuses(kind)
    needed = dict.fromkeys([*fields, "date_created", *(["status"] if drop_refunds else [])])
    rows = pick(df, cols, *needed).filter(in_period(as_day("date_created"), start, end))
    if drop_refunds:
        rows = rows.filter(not_in(F.col("status"), statuses))
    return rows


def sold_between(
    df: DataFrame, cols: Columns, fields: list[str], start=None, end=None, drop_refunds: bool = True
) -> DataFrame:
    """As :func:`sold`, but the bounds are exact times."""
    rows = sold(df, cols, fields, "all", drop_refunds=drop_refunds)
    kind = rows.schema["date_created"].dataType
    if start is not None:
        rows = rows.filter(F.col("date_created") >= bound(start, kind))
    if end is not None:
        rows = rows.filter(F.col("date_created") <= bound(end, kind))
    return rows


def _birthday() -> Column:
    return as_day("birthday")


def age_sex(
    df: DataFrame,
    cols: Columns = Columns(),
    kind: str = "all",
    start: date | str | None = None,
    end: date | str | None = None,
    gap: int = 1,
    by: str | None = None,
    drop_refunds: bool = True,
) -> DataFrame:
    """People, men and women per age band, with shares and a total row.

    With ``by`` the counts, totals and shares are per value of that column,
    its NULL written as ``NA``. An unknown birthday gives a NULL band.
    """
    group = [by] if by else []
    rows = sold(df, cols, ["birthday", "sex", *group], kind, start, end, drop_refunds)
    days = P.age_days(as_day("date_created"), _birthday())
    rows = rows.select(
        *[F.coalesce(F.col(key).cast("string"), F.lit("NA")).alias(key) for key in group],
        P.age_band_start(days, gap).alias("band_start"),
        "sex",
    )
    counts = rows.groupingSets(
        [[F.col(key) for key in [*group, "band_start"]], [F.col(key) for key in group]],
        *[F.col(key) for key in [*group, "band_start"]],
    ).agg(
        F.grouping("band_start").cast("int").alias("is_total"),
        count_rows().alias("people"),
        F.count_if(F.col("sex") == P.MALE).alias("men"),
        F.count_if(F.col("sex") == P.FEMALE).alias("women"),
    )
    # The window sees one row per band, not the orders.
    per_group = Window.partitionBy(*group)
    everyone = F.sum(F.when(F.col("is_total") == 1, F.col("people"))).over(per_group)
    people = F.col("people")
    return counts.select(
        *group,
        P.age_band_label(F.col("band_start"), gap).alias("age_band"),
        "band_start",
        "is_total",
        "people",
        "men",
        "women",
        share(F.col("men"), people, 2).alias("men_share"),
        share(F.col("women"), people, 2).alias("women_share"),
        share(people, everyone, 2).alias("band_share"),
    )


def age_decades(bands: DataFrame) -> DataFrame:
    """One-year bands of :func:`age_sex` merged into decades, shares added up."""
    start = F.col("band_start")
    decade = F.when(start <= 10, 0).otherwise(F.least(F.floor((start - 1) / 10), F.lit(9)))
    low = F.when(F.col("decade") == 0, 0).otherwise(F.col("decade") * 10 + 1)
    text = F.concat_ws("-", low.cast("int"), (F.col("decade") * 10 + 10).cast("int"))
    label = F.when(F.col("decade") == 9, F.concat(text, F.lit("岁以上"))).when(
        F.col("decade").isNotNull(), F.concat(text, F.lit("岁"))
    )
    # Shares are rounded to cents, so whole hundredths add up exactly.
    percent = F.sum(F.round(F.col("band_share") * 100).cast("long"))
    return (
        bands.filter("is_total = 0")
        .withColumn("decade", F.when(start.isNotNull(), decade).cast("int"))
        .groupBy("decade")
        .agg(
            F.sum("men").cast("long").alias("men"),
            F.sum("women").cast("long").alias("women"),
            (percent / F.lit(100.0)).alias("decade_share"),
        )
        .withColumn("label", label)
    )


def top_age_band(facts: DataFrame, labels: tuple[str, ...] | None = None) -> DataFrame:
    """The age band of :func:`fact_sheet` with most people."""
    bands = labels or AGE_BANDS
    return (
        facts.filter(F.col("label").isin(*bands))
        .orderBy(F.desc("people"), F.asc("sort_key"))
        .limit(1)
    )


# The age bands of the fact sheet, in days lived as 365-day years.
AGE_BAND_YEARS = {
    "0岁": (None, 1),
    "1-20岁": (1, 21),
    "21-40岁": (21, 41),
    "41-60岁": (41, 61),
    "61-80岁": (61, 81),
    "81-100岁": (81, 101),
    ">100岁": (101, None),
    "80岁及以上": (80, None),
    "100岁及以上": (100, None),
}
AGE_BANDS = tuple(AGE_BAND_YEARS)[:7]


def _in_years(age: Column, low: int | None, high: int | None) -> Column:
    if low is None:
        return age < high * 365
    from_low = age >= low * 365
    return from_low if high is None else from_low & (age < high * 365)


def _one_per_label(rows: DataFrame, conditions: dict[str, Column], exact: tuple[str, ...]):
    """Count every condition in one pass, then turn the single row into one per label.

    Shares have three decimals, those of ``exact`` labels are not rounded.
    """
    names = {label: f"c{i}" for i, label in enumerate(conditions)}
    counts = rows.agg(
        count_rows().alias("everyone"),
        *[F.count_if(cond).alias(names[label]) for label, cond in conditions.items()],
    )
    entries = [
        F.struct(
            F.lit(i).alias("sort_key"), F.lit(label).alias("label"), F.col(name).alias("people")
        )
        for i, (label, name) in enumerate(names.items())
    ]
    lines = counts.select("everyone", F.inline(F.array(*entries)))
    part = ratio(F.col("people"), F.col("everyone"))
    return lines.select(
        "sort_key",
        "label",
        "people",
        F.when(F.col("label").isin(*exact), part).otherwise(round_even(part, 3)).alias("share"),
    )


def fact_sheet(
    df: DataFrame,
    cols: Columns = Columns(),
    start: date | str | None = None,
    end: date | str | None = None,
    launch: date | str | None = None,
    online: str = L.ONLINE_COMPANY,
    with_medical: bool = False,
    drop_refunds: bool = True,
) -> DataFrame:
    """People per fact (kind of order, sex, document, birthday, age) in one pass.

    ``online`` is the pattern of the companies counted as online platform.
    ``launch`` is the day whose birthdays are counted, by default ``start`` or,
    without one, the first day of the orders, refunded ones included.
    """
    fields = ["group", "company", "sex", "id_type", "id_no", "birthday"]
    if with_medical:
        fields.append("medical_flag")
    rows = sold_between(df, cols, fields, start, end, drop_refunds)
    birthday = _birthday()
    created = as_day("date_created")
    rows = rows.withColumns(
        {
            "age": P.age_days(created, birthday),
            "bought_on": month_day(created),
            "birth_on": month_day(birthday),
            "id_birth_on": P.birth_month_day(F.col("id_type"), F.col("id_no"), birthday),
            "is_online": F.coalesce(F.col("company").rlike(online), F.lit(False)),
        }
    )
    if launch is None and start is None:
        # Refunded orders count here: the first of them may have opened the sale.
        everyone = sold_between(df, cols, [], start, end, drop_refunds=False)
        launch = everyone.agg(F.min(created)).first()[0]
    launch = start if launch is None else launch
    launch_on = month_day(F.lit(None).cast("date") if launch is None else day_of(launch))
    age = F.col("age")
    conditions = {
        "净投保量": F.lit(True),
        "个人净投保量": F.col("group") == "self",
        "企业净投保量": F.col("group") == "com",
        "线上平台": F.col("is_online"),
        "线下保司": ~F.col("is_online"),
        "男性": F.col("sex") == P.MALE,
        "女性": F.col("sex") == P.FEMALE,
        "和项目同一天生日": F.col("birth_on") == launch_on,
        "生日当天购买": F.col("bought_on") == F.col("id_birth_on"),
        "港澳台同胞": F.col("id_type").isin(*L.HMT_ID_TYPES),
        "国际友人": F.col("id_type").isin(*L.FOREIGN_ID_TYPES),
        **{label: _in_years(age, *years) for label, years in AGE_BAND_YEARS.items()},
    }
    if with_medical:
        conditions["预约医保个张扣缴"] = F.col("medical_flag") == 1
    return _one_per_label(rows, conditions, exact=("和项目同一天生日", "生日当天购买"))


def _all_labels(rows: DataFrame, value: Column, labels: tuple[str, ...], top: int | None):
    """Count per label, labels without people included; ties share a rank."""
    counts = rows.groupBy(value.alias("label")).agg(count_rows().alias("n"))
    # One row per label from here on; the total covers rows without a label too.
    everyone = F.sum("n").over(Window.partitionBy())
    counted = counts.select("label", "n", everyone.alias("everyone"))
    template = rows.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for label in labels])).alias("label")
    )
    joined = template.join(counted, "label", "left")
    total = F.max("everyone").over(Window.partitionBy())
    result = joined.select(
        "label",
        F.coalesce(F.col("n"), F.lit(0)).alias("people"),
        share(F.coalesce(F.col("n"), F.lit(0)), total, 3).alias("share"),
    )
    return result if top is None else top_with_ties(result, "people", top)


def top_with_ties(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` largest rows and all that tie with the last of them."""
    rank = F.rank().over(Window.orderBy(F.desc(column)))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n).drop("rank")


# Below, ``scope`` is start, end (exact times) and drop_refunds of sold_between.


def star_sign_counts(df, cols=Columns(), top: int | None = None, **scope) -> DataFrame:
    """People per star sign, with shares; ``top`` keeps the largest, with ties."""
    signs = tuple(name for _, name in P.STAR_SIGNS)
    rows = sold_between(df, cols, ["birthday"], **scope)
    return _all_labels(rows, P.star_sign(_birthday()), signs, top)


def zodiac_counts(df, cols=Columns(), top: int | None = None, **scope) -> DataFrame:
    """People per zodiac animal, with shares; ``top`` keeps the largest, with ties."""
    rows = sold_between(df, cols, ["birthday"], **scope)
    return _all_labels(rows, P.zodiac(_birthday()), P.ZODIAC, top)


def payment_method_share(df: DataFrame, cols: Columns = Columns(), **scope) -> DataFrame:
    """Orders per payment method and their share."""
    rows = sold_between(df, cols, ["payway"], **scope)
    counts = rows.groupBy("payway").agg(count_rows().alias("people"))
    everyone = F.sum("people").over(Window.partitionBy())
    return counts.select(
        F.concat(F.col("payway"), F.lit("支付")).alias("label"),
        "people",
        ratio(F.col("people"), everyone).alias("share"),
    )


def relationship_share(
    df: DataFrame, cols: Columns = Columns(), by_relation: bool = True, **scope
) -> DataFrame:
    """Share bought for oneself and for family.

    With a relation column it is read over individual orders; without one, a
    customer with one order counts as buying for themself and a customer with
    more as buying for family.
    """
    if by_relation:
        rows = sold_between(df, cols, ["group", "relation"], **scope)
        rows = rows.filter(F.col("group") == "self")
        own = F.count_if(F.col("relation") == L.SELF_RELATION)
        family = F.count_if(F.col("relation") != L.SELF_RELATION)
    else:
        rows = (
            sold_between(df, cols, ["customer_id"], **scope)
            .filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(count_rows().alias("n"))
        )
        own, family = F.count_if(F.col("n") == 1), F.count_if(F.col("n") >= 2)
    counts = rows.agg(own.alias("own"), family.alias("family"), count_rows().alias("everyone"))
    entries = [
        F.struct(F.lit(text).alias("label"), share(F.col(name), F.col("everyone"), 3).alias("share"))
        for name, text in (("own", "为自己投保"), ("family", "为家人投保"))
    ]
    return counts.select(F.inline(F.array(*entries)))


def youngest_oldest(df: DataFrame, cols: Columns = Columns(), **scope) -> DataFrame:
    """The youngest and the oldest insured person.

    Equal ages: the youngest is the latest order, the oldest the earliest.
    """
    rows = sold_between(df, cols, ["birthday", "sex"], **scope)
    created = as_day("date_created")
    rows = rows.select(
        P.age_days(created, _birthday()).alias("age"),
        created.alias("created"),
        _birthday().alias("birthday"),
        F.when(F.col("sex") == P.FEMALE, "女性").when(F.col("sex").isNotNull(), "男性").alias("sex"),
    ).filter("age is not null")
    picked = F.struct("age", "birthday", "sex", "created")
    # Sort keys run youngest first, then latest order; the sex settles the rest.
    newest_first = F.struct(
        F.col("age"), -F.unix_date("created"), F.coalesce(F.col("sex"), F.lit(""))
    )
    extremes = rows.agg(
        F.min_by(picked, newest_first).alias("youngest"),
        F.max_by(picked, newest_first).alias("oldest"),
    )
    people = F.array(
        F.struct(F.lit("年龄最小参保人").alias("label"), F.col("youngest").alias("p")),
        F.struct(F.lit("年龄最大参保人").alias("label"), F.col("oldest").alias("p")),
    )
    age = F.col("p.age")
    years = round_even(age / F.lit(365.0), 0).cast("int")
    age_text = F.when(
        F.col("label") == "年龄最小参保人",
        F.concat(F.lit("参保年龄：出生第"), age.cast("string"), F.lit("天；出生日期：")),
    ).otherwise(F.concat(F.lit("参保年龄："), years.cast("string"), F.lit("岁；出生日期：")))
    return extremes.select(F.inline(people)).select(
        "label",
        age.alias("age_days"),
        F.col("p.birthday").alias("birthday"),
        F.col("p.sex").alias("sex"),
        F.col("p.created").alias("bought"),
        F.concat(
            age_text,
            F.col("p.birthday").cast("string"),
            F.lit("；性别："),
            F.coalesce(F.col("p.sex"), F.lit("NA")),
        ).alias("text"),
    )


def surname_counts(df: DataFrame, cols: Columns = Columns(), **scope) -> DataFrame:
    """People per first character of the name, and their share."""
    counts = (
        sold_between(df, cols, ["name"], **scope)
        .groupBy(P.surname(F.col("name")).alias("surname"))
        .agg(count_rows().alias("people"))
    )
    everyone = F.sum("people").over(Window.partitionBy())
    return counts.withColumn("share", share(F.col("people"), everyone, 3))


def hour_profile(df: DataFrame, bought: str = "date_created") -> DataFrame:
    """Orders per hour of the day, their share, and the best and worst date.

    ``df`` holds the orders to count, see :func:`sold_between`. Best and worst run over the dates with orders in that hour; the earliest
    date wins a tie.
    """
    time = F.col(bought)
    per_day = df.groupBy(F.to_date(time).alias("date"), F.date_format(time, "HH").alias("hour")).agg(
        count_rows().alias("n")
    )
    earlier = F.unix_date("date")
    per_hour = per_day.groupBy("hour").agg(
        F.sum("n").cast("long").alias("orders"),
        F.max("n").alias("max_orders"),
        F.max_by("date", F.struct(F.col("n"), -earlier)).alias("max_date"),
        F.min("n").alias("min_orders"),
        F.min_by("date", F.struct(F.col("n"), earlier)).alias("min_date"),
    )
    everyone = F.sum("orders").over(Window.partitionBy())
    return per_hour.withColumn("share", share(F.col("orders"), everyone, 3))
