"""Every threshold, code and label of the workload, as data.

A rule list is read top to bottom and the first rule that holds wins, so
inclusive ranges may share an edge. ``*_SCALED`` lists are a second set whose
cuts suit the value ranges of the bundled test tables; they exist so that every
band is reached when results are checked.
"""

from __future__ import annotations

from typing import Any, NamedTuple


class Rule(NamedTuple):
    op: str
    bounds: tuple
    label: Any


def lt(bound, label):
    return Rule("lt", (bound,), label)


def le(bound, label):
    return Rule("le", (bound,), label)


def gt(bound, label):
    return Rule("gt", (bound,), label)


def ge(bound, label):
    return Rule("ge", (bound,), label)


def eq(bound, label):
    return Rule("eq", (bound,), label)


def between(low, high, label):
    return Rule("between", (low, high), label)


# ---------------------------------------------------------------------------
# Codes, labels, patterns and cuts that results must agree with.
# ---------------------------------------------------------------------------

COMPLETED = "202"
EXCHANGED = "1"
RETURNED = "0"

GENDER = {"1": "男", "2": "女"}
GENDER_ELSE = "未知"
JOB = {"1": "学生", "2": "公务员", "3": "军人", "4": "警察", "5": "教师", "6": "白领"}
JOB_ELSE = "其他"
POLITICAL = {"1": "群众", "2": "党员", "3": "无党派人士"}
POLITICAL_ELSE = "无"
NATIONALITY = {"1": "中国大陆", "2": "中国香港", "3": "中国澳门", "4": "中国台湾", "5": "其他"}
NATIONALITY_ELSE = "其他"
MARRIAGE = {"1": "未婚", "2": "已婚", "3": "离异"}
MARRIAGE_ELSE = "未知"
BLACKLIST = {"0": "非黑名单", "1": "黑名单"}
BLACKLIST_ELSE = "其他"

GENERATION = [
    between(1950, 1959, "50后"),
    between(1960, 1969, "60后"),
    between(1970, 1979, "70后"),
    between(1980, 1989, "80后"),
    between(1990, 1999, "90后"),
    between(2000, 2009, "00后"),
    between(2010, 2019, "10后"),
    between(2020, 2029, "20后"),
]
GENERATION_ELSE = "其他"
GENERATION_SERIES = ["70后", "80后", "90后", "00后"]

# (last day of the sign that opens the month, that sign), January to December
ZODIAC = [
    (20, "摩羯座"),
    (19, "水瓶座"),
    (20, "双鱼座"),
    (20, "白羊座"),
    (21, "金牛座"),
    (21, "双子座"),
    (22, "巨蟹座"),
    (22, "狮子座"),
    (23, "处女座"),
    (23, "天秤座"),
    (22, "天蝎座"),
    (21, "射手座"),
]
ZODIAC_ELSE = "其他"
ZODIAC_SERIES = [
    "白羊座", "金牛座", "双子座", "巨蟹座", "狮子座", "处女座",
    "天秤座", "天蝎座", "射手座", "摩羯座", "水瓶座", "双鱼座",
]

PAGE_TYPES = [
    ("%login%", "登录页"),
    ("%order%", "我的订单页"),
    ("%product%", "商品页"),
    ("%item%", "分类页"),
    ("%index%", "首页"),
]
PAGE_ELSE = "其他页面"
LOGIN_PAGE = "登录页"

DEVICES = [
    ("%Android%", "Android"),
    ("%iPhone%", "IOS"),
    ("%WOW%", "Window"),
    ("%Linux%", "Linux"),
]
DEVICE_ELSE = "Mac"

SLOTS = [
    between(0, 7, "0点-7点"),
    between(8, 12, "8点-12点"),
    between(13, 17, "13点-17点"),
    between(18, 21, "18点-21点"),
    between(22, 24, "22点-24点"),
]

DWELL_LAST = "0"
DWELL = [lt(60, "1分钟内"), between(60, 300, "1-5分钟"), gt(300, "5分钟以上")]

PAGE_FREQUENCY = [gt(1.5, "经常"), between(1, 1.5, "很少"), between(0, 1.5, "偶尔")]
PAGE_FREQUENCY_ELSE = "偶尔"

LOGIN_RECENCY = [
    le(1, "1天以内"),
    between(1, 7, "7天以内"),
    between(7, 14, "14天以内"),
    between(14, 30, "30天以内"),
]
LOGIN_RECENCY_ELSE = "30天未登录"

LOGIN_INTENSITY = [eq(0, "无"), between(0, 5, "较少"), between(5, 10, "一般"), gt(10, "经常")]

CYCLE = [
    lt(7, "7日"),
    between(7, 14, "2周"),
    between(14, 30, "1月"),
    between(30, 60, "2月"),
    between(60, 90, "3月"),
    between(90, 120, "4月"),
    between(120, 150, "5月"),
    between(150, 180, "6月"),
]
CYCLE_ELSE = "六月以上"

ORDER_VALUE = [
    between(1, 999, "1-999"),
    between(1000, 2999, "1000-2999"),
    between(3000, 4999, "3000-4999"),
    between(5000, 9999, "5000-9999"),
]
MAX_ORDER_ELSE = ">9999"

FREQUENCY = [gt(1.8, "高"), between(1.6, 1.8, "中"), lt(1.6, "低")]
RETURN_RATE = [gt(0.01, "高"), between(0.005, 0.01, "中"), lt(0.005, "低")]

COUPON_SCORE = [gt(5, 5), eq(5, 4), eq(4, 3), eq(3, 2), lt(3, 1)]
CARD_SCORE = [gt(4, 5), eq(4, 4), eq(3, 3), eq(2, 2), lt(2, 1)]
ACTIVITY_SCORE = [gt(5, 5), eq(5, 4), eq(4, 3), between(2, 4, 2), lt(2, 1)]

BUY_SCORE = [gt(80, 5), between(60, 80, 4), between(40, 60, 3), between(20, 40, 2), lt(20, 1)]
DISCOUNT_COUNT_SCORE = [gt(15, 5), between(10, 15, 4), between(6, 10, 3), between(3, 6, 2), lt(3, 1)]
DISCOUNT_RATIO_SCORE = [
    lt(0.95, 5),
    between(0.95, 0.96, 4),
    between(0.96, 0.97, 3),
    between(0.97, 0.98, 2),
    gt(0.98, 1),
]

RECENCY_SHIFT_DAYS = 660
RECENCY_STRICT = [between(1, 3, 5), between(4, 6, 4), between(7, 9, 3), between(10, 15, 2), ge(16, 1)]
FREQUENCY_STRICT = [
    ge(200, 5),
    between(150, 199, 4),
    between(100, 149, 3),
    between(50, 99, 2),
    between(1, 49, 1),
]
MONEY_STRICT = [
    ge(200000, 5),
    between(100000, 199999, 4),
    between(50000, 99999, 3),
    between(10000, 49999, 2),
    le(9999, 1),
]
# The same cuts without the gaps between neighbouring bands.
RECENCY_SCORE = [le(3, 5), le(6, 4), le(9, 3), le(15, 2)]
FREQUENCY_SCORE = [ge(200, 5), ge(150, 4), ge(100, 3), ge(50, 2)]
MONEY_SCORE = [ge(200000, 5), ge(100000, 4), ge(50000, 3), ge(10000, 2)]
LOWEST_SCORE = 1

RFM_CLUSTERS = 7
TITLE_CLUSTERS = 3
KMEANS_SEED = 100
KMEANS_ITERATIONS = 2

# Segment value, best first.
VALUE_LABELS = {7: "超高", 6: "高", 5: "中上", 4: "中", 3: "中下", 2: "低", 1: "很低"}

COUPON_TITLE = "有券必买"
THRIFT_TITLE = "省钱能手"
NO_TITLE = "无"

BRANDS = [
    ("%卡萨帝%", "卡萨帝"),
    ("%MOOKA%", "摩卡"),
    ("%KFR%", "小超人"),
    ("%统帅%", "统帅"),
    ("%海尔%", "海尔"),
]
HOUSE_BRAND = "海尔"
BRAND_NONE = "无偏好"
BRAND_ELSE = "其他"
NO_BRAND_WEIGHT, HOUSE_BRAND_WEIGHT, SUB_BRAND_WEIGHT = 0, 1, 10
HISTORY_NO_BRAND_WEIGHT = 1

BRAND_CODES = [("%统帅%", 1), ("%卡萨帝%", 2), ("%摩卡%", 3), ("%小超人%", 4), ("%海尔%", 5)]

PRODUCT_MARK = "/product/"
PAGE_SUFFIX = ".html"

ALS_RANK = 10
ALS_ITERATIONS = 10
ALS_REGULARISATION = 1.0
ALS_ALPHA = 10.0
TOP_PRODUCTS = 10
TOP_BRANDS = 3

PREVIEW_ITEMS = 3
PREVIEW_MORE = "等"
REGION_UNKNOWN = "查询失败"

# ---------------------------------------------------------------------------
# Second set of cuts, for the value ranges of the bundled test tables.
# ---------------------------------------------------------------------------

LOGIN_INTENSITY_SCALED = [
    eq(0, "无"),
    between(0, 0.004, "较少"),
    between(0.004, 0.006, "一般"),
    gt(0.006, "经常"),
]
CYCLE_SCALED = [
    lt(7, "7日"),
    between(7, 90, "2周"),
    between(90, 180, "1月"),
    between(180, 270, "2月"),
    between(270, 360, "3月"),
    between(360, 480, "4月"),
    between(480, 700, "5月"),
]
AVG_ORDER_SCALED = [
    between(1, 149999, "1-149999"),
    between(150000, 249999, "150000-249999"),
    between(250000, 349999, "250000-349999"),
    between(350000, 450000, "350000-450000"),
]
MAX_ORDER_SCALED = [
    between(1, 199999, "1-199999"),
    between(200000, 349999, "200000-349999"),
    between(350000, 449999, "350000-449999"),
    between(450000, 479999, "450000-479999"),
]
MAX_ORDER_SCALED_ELSE = ">479999"
FREQUENCY_SCALED = [gt(0.004, "高"), between(0.0025, 0.004, "中"), lt(0.0025, "低")]
RETURN_RATE_SCALED = [gt(0.4, "高"), between(0.25, 0.4, "中"), lt(0.25, "低")]
USE_SCORE_SCALED = [gt(19, 5), between(14, 19, 4), between(10, 14, 3), between(6, 10, 2), lt(6, 1)]
BUY_SCORE_SCALED = [gt(25, 5), between(15, 25, 4), between(10, 15, 3), between(5, 10, 2), lt(5, 1)]
RECENCY_SCALED = [le(54, 5), le(123, 4), le(220, 3), le(390, 2)]
FREQUENCY_SCORE_SCALED = [ge(13, 5), ge(11, 4), ge(9, 3), ge(7, 2)]
MONEY_SCALED = [ge(3250000, 5), ge(2670000, 4), ge(2230000, 3), ge(1710000, 2)]

BRANDS_SCALED = [
    ("%ring%", "ring"),
    ("%gear%", "gear"),
    ("%plate%", "plate"),
    ("%rod%", "rod"),
    ("%widget%", "widget"),
]
HOUSE_BRAND_SCALED = "widget"
BRAND_CODES_SCALED = [("%rod%", 1), ("%ring%", 2), ("%gear%", 3), ("%plate%", 4), ("%widget%", 5)]
