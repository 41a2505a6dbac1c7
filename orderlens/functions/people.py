"""What an identity number and a birthday tell about a person."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.dates import month_day

MALE, FEMALE = "男", "女"
ID_CARD = "身份证"

# First day (MM-dd) of each star sign and its name.
STAR_SIGNS = (
    ("01-21", "水瓶座"),
    ("02-20", "双鱼座"),
    ("03-21", "白羊座"),
    ("04-21", "金牛座"),
    ("05-22", "双子座"),
    ("06-22", "巨蟹座"),
    ("07-24", "狮子座"),
    ("08-24", "处女座"),
    ("09-24", "天秤座"),
    ("10-24", "天蝎座"),
    ("11-23", "射手座"),
    ("12-23", "摩羯座"),
)

# Zodiac animals in the order of year modulo 12, from 0.
ZODIAC = (
    "属猴", "属鸡", "属狗", "属猪", "属鼠", "属牛",
    "属虎", "属兔", "属龙", "属蛇", "属马", "属羊",
)


def sex_from_id(sex: Column, id_no: Column) -> Column:
    """Recorded sex (``F``/``W`` codes translated), else the id's parity digit."""
    digit = F.coalesce(F.substring(id_no, 17, 1).try_cast("int"), F.lit(0))
    from_id = F.when(digit % 2 == 1, MALE).otherwise(FEMALE)
    recorded = F.replace(F.replace(sex, F.lit("F"), F.lit(MALE)), F.lit("W"), F.lit(FEMALE))
    return F.when(sex.isNull() & (F.length(id_no) == 18), from_id).otherwise(recorded)


def birthday_from_id(birthday: Column, id_no: Column) -> Column:
    """Recorded birthday; an empty one is read from an 18-character id."""
    from_id = F.try_to_date(F.substring(id_no, 7, 8), "yyyyMMdd")
    recorded = F.try_to_date(F.substring(birthday, 1, 10), "yyyy-MM-dd")
    return F.when((birthday == "") & (F.length(id_no) == 18), from_id).otherwise(recorded)


def age_days(bought: Column, birthday: Column) -> Column:
    return F.datediff(bought, birthday)


def age_band_start(days: Column, gap: int) -> Column:
    """First year of the band: 0, 1, 1+gap, ...; 101 for over 100; NULL if unknown."""
    year = F.floor(days / 365).cast("int")
    start = (F.floor((year - 1) / gap) * gap + 1).cast("int")
    return (
        F.when(days < 365, 0)
        .when(days > 100 * 365, 101)
        .when(days.isNotNull(), start)
    )


def age_band_label(start: Column, gap: int) -> Column:
    """Text of a band from :func:`age_band_start`; the last one closes at 100."""
    end = F.when(start + gap > 100, 100).otherwise(start + gap - 1)
    return (
        F.when(start == 0, "0")
        .when(start == 101, ">100")
        .when(start.isNotNull(), F.concat_ws("-", start, end))
    )


def star_sign(birthday: Column) -> Column:
    """Sign of a birthday; an unknown birthday falls into the last sign."""
    day = month_day(birthday)
    sign = F
    for first_day, name in reversed(STAR_SIGNS):
        sign = sign.when(day >= first_day, name)
    return sign.otherwise(STAR_SIGNS[-1][1])


def zodiac(birthday: Column) -> Column:
    # get, unlike element_at, stays NULL for a NULL position in ANSI mode.
    return F.get(F.array(*[F.lit(animal) for animal in ZODIAC]), F.year(birthday) % 12)


def birth_month_day(id_type: Column, id_no: Column, birthday: Column) -> Column:
    """``MM-dd`` of birth from an 18- or 15-character id card, else the birthday."""
    size = F.when(id_type == ID_CARD, F.length(id_no))

    def from_id(first: int) -> Column:
        return F.concat_ws("-", F.substring(id_no, first, 2), F.substring(id_no, first + 2, 2))

    return F.when(size == 18, from_id(11)).when(size == 15, from_id(9)).otherwise(month_day(birthday))


def surname(name: Column) -> Column:
    return F.substring(name, 1, 1)
