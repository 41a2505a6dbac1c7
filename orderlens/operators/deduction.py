"""Automatic deduction: stage counts and the funnel per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels as L
from orderlens.functions.nulls import holds
from orderlens.functions.numbers import ratio

# Words in the project name of a task that is not a real one.
TEST_TASK_PATTERN = "测试|模拟"


def deduction_tasks(
    config: DataFrame, city: str | None = None, ids: Sequence[str] | None = None
) -> DataFrame:
    """Real tasks of a city, or the ones listed by id."""
    if city is None and ids is None:
        raise ValueError("give a city or task ids")
    real = config.filter(~F.col("project_name").rlike(TEST_TASK_PATTERN))
    if ids is not None:
        return real.filter(F.col("id").cast("string").isin(*[str(task) for task in ids]))
    return real.filter(F.col("project_name").contains(city))


def normalised_exceptions(exceptions: DataFrame) -> DataFrame:
    """Exceptions with the step's name and the class of the message."""
    step, message = F.col("step"), F.col("exception_describe")
    return exceptions.select(
        F.col("auto_deduction_base_id").alias("task_id"),
        L.deduction_step(step).alias("stage"),
        L.deduction_kind(step, message).alias("kind"),
        "order_item_id",
    )


def deduction_stage_counts(
    totals: DataFrame, exceptions: DataFrame, tasks: DataFrame | None = None
) -> DataFrame:
    """People per task, stage and kind: successes, base, and every exception."""
    if tasks is not None:
        ids = tasks.select(F.col("id").alias("task")).distinct()
        totals = totals.join(
            ids, totals["auto_deduction_base_config_id"] == ids["task"], "left_semi"
        )
        exceptions = exceptions.join(
            ids, exceptions["auto_deduction_base_id"] == ids["task"], "left_semi"
        )
    sums = totals.groupBy(F.col("auto_deduction_base_config_id").alias("task_id")).agg(
        F.sum("deduction_pay_success_total").cast("long").alias("paid"),
        F.sum("send_msg_total").cast("long").alias("sent"),
    )
    rows = F.array(
        F.struct(
            F.lit(L.STEP_RESULT).alias("stage"),
            F.lit(L.DEDUCTION_OK).alias("kind"),
            F.col("paid").alias("people"),
        ),
        F.struct(
            F.lit(L.STEP_CLEAN).alias("stage"),
            F.lit(L.BASE_COUNT).alias("kind"),
            F.col("sent").alias("people"),
        ),
    )
    counted = (
        normalised_exceptions(exceptions)
        .groupBy("task_id", "stage", "kind")
        .agg(F.count_distinct("order_item_id").alias("people"))
    )
    return sums.select("task_id", F.inline(rows)).unionByName(counted).distinct()


def deduction_funnel(stage_counts: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """The funnel of each task as rows: numbered counts, rates and task times.

    One row per task carries all counts, from which the derived ones and the
    rates follow; it is then turned into one row per line of the report.
    """

    def people(stage: str, kind: str) -> Column:
        picked = holds((F.col("stage") == stage) & (F.col("kind") == kind))
        return F.coalesce(F.sum(F.when(picked, F.col("people"))), F.lit(0))

    counts = {
        "base": people(L.STEP_CLEAN, L.BASE_COUNT),
        "listed": people(L.STEP_CLEAN, L.LISTED),
        "merchant": people(L.STEP_CLEAN, L.MERCHANT_ERROR),
        "again_send": people(L.STEP_SEND, L.BOUGHT_AGAIN),
        "again_start": people(L.STEP_START, L.BOUGHT_AGAIN),
        "over_limit": people(L.STEP_RESULT, L.OVER_LIMIT),
        "payment": people(L.STEP_RESULT, L.PAYMENT_TROUBLE),
        "paid": people(L.STEP_RESULT, L.DEDUCTION_OK),
        "unsigned": people(L.STEP_RESULT, L.NOT_SIGNED),
        "unbound": people(L.STEP_RESULT, L.UNBOUND),
        "frozen": people(L.STEP_RESULT, L.ACCOUNT_FROZEN),
    }
    per_task = stage_counts.groupBy("task_id").agg(
        *[count.cast("long").alias(name) for name, count in counts.items()]
    )
    if tasks is None:
        per_task = per_task.withColumns(
            {"notice_at": F.lit(None).cast("string"), "start_at": F.lit(None).cast("string")}
        )
    else:
        times = tasks.select(
            F.col("id").alias("task_id"),
            F.col("advance_deduction_notice_time").cast("string").alias("notice_at"),
            F.col("start_deduction_time").cast("string").alias("start_at"),
        )
        per_task = per_task.join(times, "task_id", "left")

    c = F.col
    per_task = (
        per_task.withColumn("eligible", c("base") + c("merchant"))
        .withColumn("started", c("base") - c("again_send") - c("again_start"))
        .withColumn(
            "repeated",
            c("started")
            - (c("paid") + c("over_limit") + c("payment"))
            - (c("unsigned") + c("unbound") + c("frozen")),
        )
    )
    trouble = c("over_limit") + c("payment") + c("frozen") + c("repeated")
    ended = c("unsigned") + c("unbound")
    again = c("again_send") + c("again_start")
    # Sections and lines of the report.
    lines = [
        ("数据清洗", "[1] 白名单", c("listed")),
        ("数据清洗", "[2] 自动扣费基数", c("eligible")),
        ("数据清洗", "[3] 签约关系不存在（商户号错误）", c("merchant")),
        ("消息发送", "消息发送时间", c("notice_at")),
        ("消息发送", "[4] 有重复下单", c("again_send")),
        ("发起扣费", "发起扣费时间", c("start_at")),
        ("发起扣费", "[5] 有重复下单", c("again_start")),
        ("发起扣费", "[6] 最终发起微信扣费的人数", c("started")),
        ("发起阶段转化率", "[6]/[2] 从扣费名单筛选到发起扣费的转化率", ratio(c("started"), c("eligible"))),
        ("发起阶段转化率", "[3]/[2] 发起扣费前的解约率", ratio(c("merchant"), c("eligible"))),
        ("发起阶段转化率", "([4]+[5])/[2] 发起扣费前的自主下单率", ratio(again, c("eligible"))),
        ("扣费成功", "[7] 微信扣费成功的人数", c("paid")),
        ("扣费异常", "[8] 交易金额或次数超出限制", c("over_limit")),
        ("扣费异常", "[9] 余额不足/卡号冻结等支付方式异常", c("payment")),
        ("扣费异常", "[10] 未签约成功（找不到签约信息）", c("unsigned")),
        ("扣费异常", "[11] 解绑自动扣费（签约协议不存在）", c("unbound")),
        ("扣费异常", "[12] 账号异常/冻结", c("frozen")),
        ("扣费异常", "[13] 同一天多次扣费任务的重复账号", c("repeated")),
        ("实际扣费转化率", "[7]/[6] 实际扣费的成功率", ratio(c("paid"), c("started"))),
        ("实际扣费转化率", "([8]+[9]+[12]+[13])/[6] 实际扣费时因账户异常的失败率", ratio(trouble, c("started"))),
        ("实际扣费转化率", "([10]+[11])/[6] 实际扣费的解约率", ratio(ended, c("started"))),
    ]
    times = ("消息发送时间", "发起扣费时间")
    rows = [
        F.struct(
            F.lit(i + 1).alias("line"),
            F.lit(section).alias("section"),
            F.lit(item).alias("item"),
            (F.lit(None) if item in times else value).cast("double").alias("value"),
            (value if item in times else F.lit(None)).cast("string").alias("time"),
        )
        for i, (section, item, value) in enumerate(lines)
    ]
    return per_task.select("task_id", F.inline(F.array(*rows)))


def funnel_wide(funnel: DataFrame, task_ids: Sequence) -> DataFrame:
    """The funnel with one column per task, as the report shows it."""
    shown = F.coalesce(F.col("time"), F.col("value").cast("string"))
    return (
        funnel.groupBy("line", "section", "item")
        .pivot("task_id", list(task_ids))
        .agg(F.first(shown))
    )
