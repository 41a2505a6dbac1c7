"""Code-to-label maps and text classifiers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER = "其他"
ONLINE_COMPANY = "线上平台"

# Identity document codes of individual orders.
SELF_ID_TYPES = {
    1: "身份证",
    2: "护照",
    7: "港澳居民来往内地通行证",
    8: "台湾居民来往大陆通行证",
}

# Identity document codes of corporate orders.
COM_ID_TYPES = {
    1: "身份证",
    2: "护照",
    3: "港澳居民来往内地通行证",
    4: "军官证",
    5: "台湾居民来往大陆通行证",
    6: "出生证",
    7: "外国人永久居留证",
}

# Relation of the insured person to the applicant.
RELATIONS = {1: "本人", 2: "父母", 3: "配偶", 4: "子女"}
SELF_RELATION = "本人"

# Business type codes of corporate customers.
BUSINESS_TYPES = {
    "1": "企业",
    "2": "事业单位",
    "3": "基金会",
    "0": "社会组织",
    "8": "办事处",
    "9": "个体户",
    "10": "行业协会",
    "99": "其他",
}

# Documents counted as Hong Kong, Macau or Taiwan, and as foreign.
HMT_ID_TYPES = ("台湾居民来往大陆通行证", "港澳居民来往内地通行证")
FOREIGN_ID_TYPES = ("护照",)

# Refund remark patterns, first match wins.
REFUND_REASONS = (
    ("用户发起", "用户发起"),
    ("错误", "信息输入错误"),
    ("不符合参保条件|没有.*[医保|参保|户口|社保]", "没有本地医保，无法购买"),
    ("不懂|[不]?理解|[不]?知道|[不]?喜欢", "看不懂产品内容，不喜欢"),
    (
        "[岁|穗][岁|穗][康|保]|其[它|他][产品|保险]|别[家|的]|[类似|同类]",
        "别家的产品更适合我",
    ),
    ("国外|不在[中国|国内]", "其他"),
    (
        "死|去世|逝|过世|病故|身故|生故|不在.*人世|人不在|[已经]?走了",
        "被保险人去世",
    ),
)

# Names of the four deduction steps.
DEDUCTION_STEPS = {
    1: "Step 1：数据清洗",
    2: "Step 2：消息发送",
    3: "Step 3：发起扣费",
    4: "Step 4：扣费结果",
}
STEP_CLEAN, STEP_SEND, STEP_START, STEP_RESULT = DEDUCTION_STEPS.values()

# Kinds of deduction outcome.
BASE_COUNT = "扣费基数"
DEDUCTION_OK = "扣费成功"
LISTED = "白名单"
MERCHANT_ERROR = "签约关系不存在-商户号错误"
BOUGHT_AGAIN = "有重复下单"
OVER_LIMIT = "交易金额或次数超出限制"
PAYMENT_TROUBLE = "余额不足/卡号冻结等支付方式异常"
NOT_SIGNED = "未成功签约"
UNBOUND = "解绑自动扣费-签约协议不存在"
ACCOUNT_FROZEN = "账号异常/冻结"

# Messages of a frozen or restricted account.
ACCOUNT_MESSAGES = (
    "当前用户账户已被限制交易",
    "当前银行卡有安全设置无法完成支付，如有疑问，请联系银行确认",
    "你的支付账户处于冻结状态，已开启保护模式。可以点击“查看解决方法”，申请解除冻结",
    "当前用户账户暂时无法完成交易，请用户检查账户后再试",
)

# Messages of a payment method that failed.
PAYMENT_MESSAGES = (
    "银行拒绝该交易，请联系银行客服",
    "您的银行卡号有误，请核对后再试",
    "用户银行卡暂不可用",
    "103 您的银行卡已被冻结，请尝试其他卡",
    "银行卡剩余额度不足，请选择其他支付方式继续支付",
    "该卡已被银行系统锁定，无法继续使用，请携带相关证件前往银行柜台解锁。如有疑问，可联系银行客服确认",
    "你的银行卡绑定状态不存在或者已过期，请解绑后重新绑定或者使用其他卡支付",
    "该银行卡已注销，请尝试其他卡，如有疑问请联系银行客服",
    "可用额度不足，请使用零钱或其他银行卡支付",
    "您的银行卡状态异常，可能未激活、挂失、没收、过期、销户，请咨询银行",
    "当前用户支付方式暂不可用，请用户检查后再试",
    "暂无可用的支付方式,请绑定其它银行卡完成支付",
    "102 银行卡可用余额不足（如信用卡则为可透支额度不足），请核实后再试",
)
MERCHANT_MESSAGE = "商户号错误"
BANK_WORD = "银行"
OVER_LIMIT_MESSAGE = "交易金额或次数超出限制，请检查后再试"
UNBOUND_MESSAGE = "签约协议不存在，请检查传入的签约协议是否正确"


def map_codes(code: Column, labels: Mapping, default: str | None = None) -> Column:
    """Label of a code; codes outside the map give ``default`` (or NULL)."""
    column = F
    for value, label in labels.items():
        column = column.when(code == value, label)
    return column.otherwise(default) if default is not None else column


def refund_reason(remark: Column) -> Column:
    """Reason class of a refund remark; an absent remark stays absent."""
    reason = F.when(remark.isNull(), F.lit(None).cast("string"))
    for pattern, label in REFUND_REASONS:
        reason = reason.when(remark.rlike(pattern), label)
    return reason.otherwise(OTHER)


def deduction_step(step: Column) -> Column:
    return map_codes(step, DEDUCTION_STEPS)


def deduction_kind(step: Column, message: Column) -> Column:
    """Class of a deduction exception; unknown messages stand for themselves."""
    result_step = step == 4
    return (
        F.when((step == 1) & (message == MERCHANT_MESSAGE), MERCHANT_ERROR)
        .when(result_step & message.isin(*ACCOUNT_MESSAGES), ACCOUNT_FROZEN)
        .when(result_step & message.isin(*PAYMENT_MESSAGES), PAYMENT_TROUBLE)
        .when(result_step & message.contains(BANK_WORD), PAYMENT_TROUBLE)
        .when(result_step & (message == OVER_LIMIT_MESSAGE), OVER_LIMIT)
        .when(result_step & (message == UNBOUND_MESSAGE), UNBOUND)
        .otherwise(message)
    )
