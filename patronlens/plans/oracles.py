"""The catalogue's queries as plain SQL over the same tables, written apart from the operators.

``u o g l r`` are the users, orders, order lines, page views and regions; ``p`` are the lines without their product.
"""

from __future__ import annotations

_INPUTS = {
    "u": """u AS (
  SELECT c_custkey AS id, c_name AS username,
    CAST(c_custkey % 3 AS VARCHAR) AS gender, CAST(c_custkey % 5 AS VARCHAR) AS political,
    CAST(c_custkey % 4 AS VARCHAR) AS marriage, CAST(c_nationkey % 8 AS VARCHAR) AS job,
    CAST(c_nationkey % 6 AS VARCHAR) AS nationality,
    lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
    '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile,
    CAST(CAST('1950-01-01' AS DATE) + CAST(c_custkey * 37 % 27000 AS INT) AS DATE) AS birthday,
    CAST(CAST('2015-01-01' AS DATE) + CAST(c_custkey % 1000 AS INT) AS DATE) AS registered,
    DATE '2024-01-31' AS logged_in,
    CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS blacklisted, c_nationkey AS region_key
  FROM customer)""",
    "o": """o AS (
  SELECT o_orderkey AS id, o_custkey AS member, CAST(o_orderkey AS VARCHAR) AS sn,
    CASE o_orderstatus WHEN 'F' THEN '202' WHEN 'O' THEN '1' ELSE '0' END AS status,
    o_orderpriority AS payment, o_orderdate AS moment, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)""",
    "g": """g AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sn, p_type AS type, p_name AS product,
    CAST(l_discount AS DECIMAL(4,2)) AS coupon, CAST(l_tax AS DECIMAL(4,2)) AS card,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS activity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS listed
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "p": """p AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sn, CAST(l_discount AS DECIMAL(4,2)) AS coupon, CAST(l_tax AS DECIMAL(4,2)) AS card,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS activity, CAST(l_extendedprice AS DECIMAL(18,2)) AS listed
  FROM lineitem)""",
    "l": """l AS (
  SELECT event_id AS id, user_id, ts AS moment,
    CASE event_type WHEN 'view' THEN '/product/' || CAST(event_id % 40 AS VARCHAR) || '.html'
      WHEN 'click' THEN '/item/list' WHEN 'signup' THEN '/login' WHEN 'purchase' THEN '/order/mine'
      ELSE '/index' END AS url,
    CASE event_id % 5 WHEN 0 THEN 'Linux; Android 9' WHEN 1 THEN 'iPhone OS' WHEN 2 THEN 'Windows WOW64'
      WHEN 3 THEN 'X11; Linux' ELSE 'Macintosh' END AS agent
  FROM events)""",
    "r": """r AS (
  SELECT n_nationkey AS region_key, r_name AS province, n_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
}

# --- labels as SQL expressions ---------------------------------------------

_GENDER = "CASE gender WHEN '1' THEN '男' WHEN '2' THEN '女' ELSE '未知' END"
_JOB = (
    "CASE job WHEN '1' THEN '学生' WHEN '2' THEN '公务员' WHEN '3' THEN '军人' WHEN '4' THEN '警察'"
    " WHEN '5' THEN '教师' WHEN '6' THEN '白领' ELSE '其他' END"
)
_POLITICAL = "CASE political WHEN '1' THEN '群众' WHEN '2' THEN '党员' WHEN '3' THEN '无党派人士' ELSE '无' END"
_NATIONALITY = (
    "CASE nationality WHEN '1' THEN '中国大陆' WHEN '2' THEN '中国香港' WHEN '3' THEN '中国澳门'"
    " WHEN '4' THEN '中国台湾' ELSE '其他' END"
)
_MARRIAGE = "CASE marriage WHEN '1' THEN '未婚' WHEN '2' THEN '已婚' WHEN '3' THEN '离异' ELSE '未知' END"
_BLACKLIST = "CASE blacklisted WHEN '0' THEN '非黑名单' WHEN '1' THEN '黑名单' ELSE '其他' END"
_AGE = (
    "CASE WHEN year(birthday) BETWEEN 1950 AND 1959 THEN '50后' WHEN year(birthday) BETWEEN 1960 AND 1969 THEN '60后'"
    " WHEN year(birthday) BETWEEN 1970 AND 1979 THEN '70后' WHEN year(birthday) BETWEEN 1980 AND 1989 THEN '80后'"
    " WHEN year(birthday) BETWEEN 1990 AND 1999 THEN '90后' WHEN year(birthday) BETWEEN 2000 AND 2009 THEN '00后'"
    " WHEN year(birthday) BETWEEN 2010 AND 2019 THEN '10后' WHEN year(birthday) BETWEEN 2020 AND 2029 THEN '20后'"
    " ELSE '其他' END"
)
# Month and day as one number, against the last day of each sign.
_ZODIAC = (
    "CASE WHEN month(birthday) * 100 + day(birthday) <= 120 THEN '摩羯座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 219 THEN '水瓶座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 320 THEN '双鱼座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 420 THEN '白羊座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 521 THEN '金牛座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 621 THEN '双子座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 722 THEN '巨蟹座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 822 THEN '狮子座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 923 THEN '处女座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 1023 THEN '天秤座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 1122 THEN '天蝎座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 1221 THEN '射手座'"
    " WHEN month(birthday) * 100 + day(birthday) <= 1231 THEN '摩羯座' ELSE '其他' END"
)
_PAGE = (
    "CASE WHEN url LIKE '%login%' THEN '登录页' WHEN url LIKE '%order%' THEN '我的订单页'"
    " WHEN url LIKE '%product%' THEN '商品页' WHEN url LIKE '%item%' THEN '分类页'"
    " WHEN url LIKE '%index%' THEN '首页' ELSE '其他页面' END"
)
_SLOT = (
    "CASE WHEN hour(moment) BETWEEN 0 AND 7 THEN '0点-7点' WHEN hour(moment) BETWEEN 8 AND 12 THEN '8点-12点'"
    " WHEN hour(moment) BETWEEN 13 AND 17 THEN '13点-17点' WHEN hour(moment) BETWEEN 18 AND 21 THEN '18点-21点'"
    " WHEN hour(moment) BETWEEN 22 AND 24 THEN '22点-24点' END"
)
_DEVICE = (
    "CASE WHEN agent LIKE '%Android%' THEN 'Android' WHEN agent LIKE '%iPhone%' THEN 'IOS'"
    " WHEN agent LIKE '%WOW%' THEN 'Window' WHEN agent LIKE '%Linux%' THEN 'Linux' ELSE 'Mac' END"
)
_RECENT = (
    "CASE WHEN days <= 1 THEN '1天以内' WHEN days <= 7 THEN '7天以内' WHEN days <= 14 THEN '14天以内'"
    " WHEN days <= 30 THEN '30天以内' ELSE '30天未登录' END"
)
_INTENSITY = "CASE WHEN rate = 0 THEN '无' WHEN rate BETWEEN 0 AND 5 THEN '较少' WHEN rate BETWEEN 5 AND 10 THEN '一般' WHEN rate > 10 THEN '经常' END"
_INTENSITY_SCALED = "CASE WHEN rate = 0 THEN '无' WHEN rate BETWEEN 0 AND 0.004 THEN '较少' WHEN rate BETWEEN 0.004 AND 0.006 THEN '一般' WHEN rate > 0.006 THEN '经常' END"
_CYCLE = (
    "CASE WHEN cycle < 7 THEN '7日' WHEN cycle <= 14 THEN '2周' WHEN cycle <= 30 THEN '1月' WHEN cycle <= 60 THEN '2月'"
    " WHEN cycle <= 90 THEN '3月' WHEN cycle <= 120 THEN '4月' WHEN cycle <= 150 THEN '5月'"
    " WHEN cycle <= 180 THEN '6月' ELSE '六月以上' END"
)
_CYCLE_SCALED = (
    "CASE WHEN cycle < 7 THEN '7日' WHEN cycle <= 90 THEN '2周' WHEN cycle <= 180 THEN '1月' WHEN cycle <= 270 THEN '2月'"
    " WHEN cycle <= 360 THEN '3月' WHEN cycle <= 480 THEN '4月' WHEN cycle <= 700 THEN '5月' ELSE '六月以上' END"
)
_AVERAGE = (
    "CASE WHEN aov BETWEEN 1 AND 999 THEN '1-999' WHEN aov BETWEEN 1000 AND 2999 THEN '1000-2999'"
    " WHEN aov BETWEEN 3000 AND 4999 THEN '3000-4999' WHEN aov BETWEEN 5000 AND 9999 THEN '5000-9999' END"
)
_AVERAGE_SCALED = (
    "CASE WHEN aov BETWEEN 1 AND 149999 THEN '1-149999' WHEN aov BETWEEN 150000 AND 249999 THEN '150000-249999'"
    " WHEN aov BETWEEN 250000 AND 349999 THEN '250000-349999'"
    " WHEN aov BETWEEN 350000 AND 450000 THEN '350000-450000' END"
)
_LARGEST = (
    "CASE WHEN max_amount BETWEEN 1 AND 999 THEN '1-999' WHEN max_amount BETWEEN 1000 AND 2999 THEN '1000-2999'"
    " WHEN max_amount BETWEEN 3000 AND 4999 THEN '3000-4999' WHEN max_amount BETWEEN 5000 AND 9999 THEN '5000-9999'"
    " ELSE '>9999' END"
)
_LARGEST_SCALED = (
    "CASE WHEN max_amount BETWEEN 1 AND 199999 THEN '1-199999' WHEN max_amount BETWEEN 200000 AND 349999 THEN '200000-349999'"
    " WHEN max_amount BETWEEN 350000 AND 449999 THEN '350000-449999'"
    " WHEN max_amount BETWEEN 450000 AND 479999 THEN '450000-479999' ELSE '>479999' END"
)


def _three(column: str, low: float, high: float) -> str:
    return f"CASE WHEN {column} > {high} THEN '高' WHEN {column} >= {low} THEN '中' WHEN {column} < {low} THEN '低' END"


def _five(column: str, cuts: tuple, top: str = ">") -> str:
    """Scores 5 to 1 over descending cuts; the top cut uses ``top``, the others are inclusive."""
    a, b, c, d = cuts
    return (
        f"CASE WHEN {column} {top} {a} THEN 5 WHEN {column} >= {b} THEN 4 WHEN {column} >= {c} THEN 3"
        f" WHEN {column} >= {d} THEN 2 ELSE 1 END"
    )


def _sql(inputs: str, body: str) -> str:
    """``body`` behind the named inputs; a body that starts with CTEs opens with a comma."""
    return "WITH " + ",\n".join(_INPUTS[i] for i in inputs.split()) + body


ORACLES: dict[str, str] = {}

# --- users and logins ------------------------------------------------------

_LOGINS = f""",
logins AS (
  SELECT user_id, max(moment) AS last_log, CAST(sum(CASE WHEN {_PAGE} = '登录页' THEN 1 ELSE 0 END) AS BIGINT) AS login_count
  FROM l GROUP BY user_id)"""

ORACLES["login_summary"] = _sql("l", _LOGINS + """
SELECT user_id, strftime(last_log, '%Y-%m-%d %H:%M:%S') AS last_log, login_count FROM logins""")

_DEMOGRAPHICS = f"""{_GENDER} AS gender, {_JOB} AS job, {_POLITICAL} AS "politicalFace",
  {_NATIONALITY} AS nationality, {_MARRIAGE} AS marriage, {_BLACKLIST} AS "is_blackList\""""
ORACLES["demographics"] = _sql("u", f"\nSELECT id, {_DEMOGRAPHICS} FROM u")
ORACLES["generation_band"] = _sql("u", f"\nSELECT id, {_AGE} AS age FROM u")
ORACLES["zodiac"] = _sql("u", f"\nSELECT id, {_ZODIAC} AS constellation FROM u")

for _name, _as_of in {"login_recency": "2024-01-31", "login_recency_later": "2024-02-20"}.items():
    ORACLES[_name] = _sql("l", _LOGINS + f""",
aged AS (SELECT user_id, CAST(date_diff('day', CAST(last_log AS DATE), DATE '{_as_of}') AS INT) AS days FROM logins)
SELECT user_id, days, {_RECENT} AS band FROM aged""")

_RATED = """,
rated AS (
  SELECT u.*, last_log, login_count,
    CAST(login_count AS DOUBLE) / nullif(date_diff('day', registered, logged_in) + 1, 0) AS rate,
    CAST(date_diff('day', CAST(last_log AS DATE), DATE '2024-01-31') AS INT) AS days
  FROM u {how} JOIN logins ON u.id = logins.user_id)"""

for _name, _cuts in {"login_intensity": _INTENSITY, "login_intensity_scaled": _INTENSITY_SCALED}.items():
    ORACLES[_name] = _sql("u l", _LOGINS + _RATED.format(how="") + f"""
SELECT id, rate, {_cuts} AS band FROM rated""")

_PROFILE = f"""SELECT id, username, {_DEMOGRAPHICS}, email, mobile, province, city,
  strftime(birthday, '%Y-%m-%d') AS birthday, {_RECENT} AS log_recent, {{intensity}} AS log_f,
  {_AGE} AS age, {_ZODIAC} AS constellation
FROM rated LEFT JOIN r USING (region_key)"""
_PROFILES_INNER = _LOGINS + _RATED.format(how="") + ",\nprofiles AS (" + _PROFILE.format(intensity=_INTENSITY_SCALED) + ")"
_PROFILES_LEFT = _LOGINS + _RATED.format(how="LEFT") + ",\nprofiles AS (" + _PROFILE.format(intensity=_INTENSITY_SCALED) + ")"
ORACLES["user_profile"] = _sql("u l r", _LOGINS + _RATED.format(how="") + "\n" + _PROFILE.format(intensity=_INTENSITY))
ORACLES["user_profile_all"] = _sql("u l r", _PROFILES_LEFT + "\nSELECT * FROM profiles")
ORACLES["region_display"] = _sql("u r", """
SELECT id, coalesce(province, '查询失败') AS province, coalesce(city, province, '查询失败') AS city
FROM u LEFT JOIN r ON blacklisted = '0' AND u.region_key = r.region_key""")

ORACLES["region_by_prefix"] = """
WITH areas AS (
  SELECT '13' || lpad(CAST(r_regionkey AS VARCHAR), 6, '0') AS prefix, r_name AS province, r_name AS city FROM region
  UNION ALL
  SELECT '13' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0'), r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT '13' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), n_name, s_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0
), numbers AS (
  SELECT c_custkey AS id, '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile FROM customer
)
SELECT id, mobile, province, city FROM numbers LEFT JOIN areas ON starts_with(mobile, prefix)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(prefix) DESC NULLS LAST) = 1"""
_TEXTS = """
WITH raw AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS member,
    CASE WHEN o_orderkey % 7 > 1 THEN datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 END AS finished,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS amount
  FROM orders)"""
ORACLES["ingest_orders"] = _TEXTS + """
SELECT id, member AS "memberId", CAST(finished AS BIGINT) AS finished, amount, nullif(concat_ws(',', CASE WHEN member IS NULL THEN 'memberId' END,
  CASE WHEN id % 11 = 0 THEN 'modified' END, CASE WHEN id % 7 = 0 THEN 'finishTime' END,
  CASE WHEN amount IS NULL THEN 'orderAmount' END), '') AS lost FROM raw"""
ORACLES["ingest_losses"] = _TEXTS + """
SELECT unnest(['rows', 'memberId', 'modified', 'finishTime', 'orderAmount', 'id', 'orderSn', 'orderStatus', 'paymentStatus', 'paymentName',
    'productAmount', 'couponCodeValue', 'giftCardAmount']) AS item,
  unnest([count(*), count(*) FILTER (id % 5 = 0), count(*) FILTER (id % 11 = 0), count(*) FILTER (id % 7 = 0), count(*) FILTER (id % 3 = 0),
    0, 0, 0, 0, 0, 0, 0, 0]) AS n FROM raw"""

# --- orders ----------------------------------------------------------------

_DONE = """,
done AS (SELECT * FROM o WHERE status = '202')"""

ORACLES["member_key_spend"] = _sql("o", _DONE + """
SELECT CAST(CAST(right(CAST(member AS VARCHAR), 3) AS BIGINT) AS VARCHAR) AS "memberId",
  count(*) AS done, CAST(sum(amount) AS DOUBLE) AS amount
FROM done GROUP BY 1""")

_SPANS = _DONE + """,
spans AS (
  SELECT member, min(id) AS id, date_diff('day', CAST(min(moment) AS DATE), CAST(max(moment) AS DATE)) + 1 AS span,
    count(DISTINCT dayofyear(moment)) AS days, count(DISTINCT CAST(moment AS DATE)) AS dates, count(*) AS n,
    CAST(sum(amount) AS DOUBLE) / count(amount) AS aov, CAST(trunc(max(amount)) AS BIGINT) AS max_amount
  FROM done GROUP BY member)"""

for _name, _cuts, _days in [
    ("purchase_cycle", _CYCLE, "days"),
    ("purchase_cycle_scaled", _CYCLE_SCALED, "days"),
    ("purchase_cycle_by_date", _CYCLE_SCALED, "dates"),
]:
    ORACLES[_name] = _sql("o", _SPANS + f""",
c AS (SELECT member, id, CAST(span AS DOUBLE) / {_days} AS cycle FROM spans)
SELECT member AS "memberId", id, cycle, {_cuts} AS band FROM c""")

_PAYMENTS = """,
payments AS (
  SELECT member, payment FROM (
    SELECT member, payment, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, payment) AS rn
    FROM done GROUP BY member, payment) WHERE rn = 1)"""
ORACLES["preferred_payment"] = _sql("o", _DONE + _PAYMENTS + """
SELECT member AS "memberId", payment AS "paymentName" FROM payments""")

for _name, _cuts in {"avg_order_band": _AVERAGE, "avg_order_band_scaled": _AVERAGE_SCALED}.items():
    ORACLES[_name] = _sql("o", _SPANS + f"""
SELECT member AS "memberId", aov, {_cuts} AS band FROM spans""")
for _name, _cuts in {"max_order_band": _LARGEST, "max_order_band_scaled": _LARGEST_SCALED}.items():
    ORACLES[_name] = _sql("o", _SPANS + f"""
SELECT member AS "memberId", max_amount, {_cuts} AS band FROM spans""")
for _name, _low, _high in [("purchase_frequency", 1.6, 1.8), ("purchase_frequency_scaled", 0.0025, 0.004)]:
    ORACLES[_name] = _sql("o", _SPANS + f""",
f AS (SELECT member, CAST(n AS DOUBLE) / span AS freq FROM spans)
SELECT member AS "memberId", freq, {_three("freq", _low, _high)} AS level FROM f""")

_RETURNS = """,
sent_back AS (
  SELECT member, CAST(sum(CASE WHEN status = '1' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS exchanged,
    CAST(sum(CASE WHEN status = '0' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS returned
  FROM o GROUP BY member)"""
for _name, _low, _high in [("return_propensity", 0.005, 0.01), ("return_propensity_scaled", 0.25, 0.4)]:
    ORACLES[_name] = _sql("o", _RETURNS + f"""
SELECT member AS "memberId", exchanged AS exchange_rate, returned AS return_rate,
  {_three("exchanged", _low, _high)} AS exchange_level, {_three("returned", _low, _high)} AS return_level
FROM sent_back""")


def _consumer(cycle: str, average: str, largest: str, frequency: tuple, returns: tuple) -> str:
    return _SPANS + _PAYMENTS + _RETURNS + f""",
rates AS (SELECT *, CAST(span AS DOUBLE) / days AS cycle, CAST(n AS DOUBLE) / span AS freq FROM spans),
consumers AS (
  SELECT id, member AS "memberId", {cycle} AS cycle, payment AS "paymentName", {average} AS avg_order_band,
    {largest} AS max_order_band, {_three("freq", *frequency)} AS frequency,
    {_three("exchanged", *returns)} AS exchange, {_three("returned", *returns)} AS "return"
  FROM rates JOIN payments USING (member) JOIN sent_back USING (member))"""


_CONSUMERS = _consumer(_CYCLE, _AVERAGE, _LARGEST, (1.6, 1.8), (0.005, 0.01))
_CONSUMERS_SCALED = _consumer(_CYCLE_SCALED, _AVERAGE_SCALED, _LARGEST_SCALED, (0.0025, 0.004), (0.25, 0.4))
ORACLES["consumer_profile"] = _sql("o", _CONSUMERS + "\nSELECT * FROM consumers")
ORACLES["consumer_profile_scaled"] = _sql("o", _CONSUMERS_SCALED + "\nSELECT * FROM consumers")


def _metrics(as_of: str) -> str:
    return f""",
metrics AS (
  SELECT member, CAST(date_diff('day', CAST(max(moment) AS DATE), DATE '{as_of}') AS INT) AS recency,
    count(sn) AS frequency, CAST(sum(amount) AS DOUBLE) AS money
  FROM o GROUP BY member)"""


# 2001-08-02 less 660 days is 1999-10-12
for _name, _as_of in {"rfm_metrics": "2001-08-02", "rfm_metrics_shifted": "1999-10-12"}.items():
    ORACLES[_name] = _sql("o", _metrics(_as_of) + """
SELECT member AS "memberId", recency, frequency, money FROM metrics""")

_RECENCY = "CASE WHEN recency <= {} THEN 5 WHEN recency <= {} THEN 4 WHEN recency <= {} THEN 3 WHEN recency <= {} THEN 2 ELSE 1 END"
ORACLES["rfm_scores"] = _sql("o", _metrics("2001-08-02") + f"""
SELECT member AS "memberId", {_RECENCY.format(3, 6, 9, 15)} AS recency,
  {_five("frequency", (200, 150, 100, 50), ">=")} AS frequency,
  {_five("money", (200000, 100000, 50000, 10000), ">=")} AS money FROM metrics""")
ORACLES["rfm_scores_strict"] = _sql("o", _metrics("2001-08-02") + """
SELECT member AS "memberId",
  CASE WHEN recency BETWEEN 1 AND 3 THEN 5 WHEN recency BETWEEN 4 AND 6 THEN 4 WHEN recency BETWEEN 7 AND 9 THEN 3
    WHEN recency BETWEEN 10 AND 15 THEN 2 WHEN recency >= 16 THEN 1 END AS recency,
  CASE WHEN frequency >= 200 THEN 5 WHEN frequency BETWEEN 150 AND 199 THEN 4 WHEN frequency BETWEEN 100 AND 149 THEN 3
    WHEN frequency BETWEEN 50 AND 99 THEN 2 WHEN frequency BETWEEN 1 AND 49 THEN 1 END AS frequency,
  CASE WHEN money >= 200000 THEN 5 WHEN money BETWEEN 100000 AND 199999 THEN 4 WHEN money BETWEEN 50000 AND 99999 THEN 3
    WHEN money BETWEEN 10000 AND 49999 THEN 2 WHEN money <= 9999 THEN 1 END AS money
FROM metrics""")
_SCORES = _metrics("2001-08-02") + f""",
scores AS (
  SELECT member AS "memberId", {_RECENCY.format(54, 123, 220, 390)} AS recency,
    {_five("frequency", (13, 11, 9, 7), ">=")} AS frequency,
    {_five("money", (3250000, 2670000, 2230000, 1710000), ">=")} AS money
  FROM metrics),
totals AS (SELECT "memberId", recency + frequency + money AS value FROM scores)"""
ORACLES["rfm_scores_scaled"] = _sql("o", _SCORES + "\nSELECT * FROM scores")
ORACLES["rfm_value_total"] = _sql("o", _SCORES + "\nSELECT * FROM totals")

# --- order lines -----------------------------------------------------------

_LINES = _DONE + """,
lines AS (SELECT done.member, done.moment, g.* FROM done JOIN g ON done.sn = g.sn)"""

_PREFERENCE = _LINES + """,
types AS (
  SELECT member, type, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, type) AS rn
  FROM lines GROUP BY member, type),
products AS (
  SELECT member, product, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, product) AS rn
  FROM lines GROUP BY member, product),
preferences AS (
  SELECT t.member AS "memberId", t.type AS "productType", a.product AS "productName1",
    b.product AS "productName2", c.product AS "productName3"
  FROM types t JOIN products a ON a.member = t.member AND a.rn = 1
    JOIN products b ON b.member = t.member AND b.rn = 2 JOIN products c ON c.member = t.member AND c.rn = 3
  WHERE t.rn = 1)"""
ORACLES["product_preference"] = _sql("o g", _PREFERENCE + "\nSELECT * FROM preferences")



def _baskets(size: int, year: bool = False) -> str:
    week = "isoyear(moment), weekofyear(moment)" if year else "weekofyear(moment)"
    year_out, year_by = ("CAST(isoyear(moment) AS INT) AS year, ", "year, ") if year else ("", "")
    return _LINES + f""",
placed AS (
  SELECT member, {year_out}CAST(weekofyear(moment) AS INT) AS cycle, product,
    row_number() OVER (PARTITION BY member, {week} ORDER BY product) - 1 AS place,
    count(*) OVER (PARTITION BY member, {week}) AS count
  FROM lines),
baskets AS (
  SELECT member, {year_by}cycle, CAST(place // {size} AS BIGINT) AS part,
    string_agg(product, ', ' ORDER BY product) AS products, count
  FROM placed GROUP BY member, {year_by}cycle, place // {size}, count)"""


_SOLD = ", cycle, part, products, count, email, mobile FROM baskets JOIN u ON u.id = baskets.member"
ORACLES["weekly_basket"] = _sql("u o g", _baskets(10000) + "\nSELECT u.id" + _SOLD)
ORACLES["weekly_basket_suffix"] = _sql("u o g", _baskets(10000).replace(
    _DONE, _DONE.replace("FROM o", "FROM (SELECT * REPLACE (CAST(right(CAST(member AS VARCHAR), 3) AS BIGINT) AS member) FROM o) o")
) + "\nSELECT u.id" + _SOLD)
ORACLES["weekly_basket_by_year"] = _sql("u o g", _baskets(3, year=True) + "\nSELECT u.id, year" + _SOLD)

_PREVIEWS = """,
numbered AS (
  SELECT member, CAST(weekofyear(moment) AS INT) AS cycle, product,
    row_number() OVER (PARTITION BY member, weekofyear(moment) ORDER BY product) AS rn
  FROM lines),
previews AS (
  SELECT member, cycle, count(*) AS count,
    string_agg(CASE WHEN rn <= 3 THEN product END, ',' ORDER BY product) || CASE WHEN count(*) > 3 THEN '等' ELSE '' END AS preview
  FROM numbered GROUP BY member, cycle)"""
ORACLES["basket_preview"] = _sql("u o g", _LINES + _PREVIEWS + """
SELECT u.id, cycle, count, preview FROM previews JOIN u ON u.id = previews.member""")

_USES = """,
uses AS (
  SELECT member, coalesce(sum(CASE WHEN status = '202' AND coupon <> 0 THEN 1 ELSE 0 END), 0) AS coupons,
    coalesce(sum(CASE WHEN status = '202' AND card <> 0 THEN 1 ELSE 0 END), 0) AS cards,
    coalesce(sum(CASE WHEN status = '202' AND activity <> 0 THEN 1 ELSE 0 END), 0) AS activities
  FROM o LEFT JOIN g ON o.sn = g.sn GROUP BY member)"""
_CARDED_USES = _USES.replace("AND card <> 0", "AND id % 4 = 0")
_COUPON_BANDS = """
SELECT member AS "memberId",
  CASE WHEN coupons > 5 THEN 5 WHEN coupons = 5 THEN 4 WHEN coupons = 4 THEN 3 WHEN coupons = 3 THEN 2 ELSE 1 END AS buy_coupon,
  CASE WHEN cards > 4 THEN 5 WHEN cards = 4 THEN 4 WHEN cards = 3 THEN 3 WHEN cards = 2 THEN 2 ELSE 1 END AS buy_card,
  CASE WHEN activities > 5 THEN 5 WHEN activities = 5 THEN 4 WHEN activities = 4 THEN 3
    WHEN activities >= 2 THEN 2 ELSE 1 END AS buy_activity
FROM uses"""
_COUPON_BANDS_SCALED = f"""
SELECT member AS "memberId", {_five("coupons", (19, 14, 10, 6))} AS buy_coupon,
  {_five("cards", (19, 14, 10, 6))} AS buy_card, {_five("activities", (19, 14, 10, 6))} AS buy_activity
FROM uses"""
for _suffix, _uses in {"": _CARDED_USES, "_by_line": _USES}.items():
    ORACLES[f"coupon_scores{_suffix}"] = _sql("o p", _uses.replace("LEFT JOIN g ON o.sn = g.sn", "LEFT JOIN p ON o.sn = p.sn") + _COUPON_BANDS)
    ORACLES[f"coupon_scores_scaled{_suffix}"] = _sql("o p", _uses.replace("LEFT JOIN g ON o.sn = g.sn", "LEFT JOIN p ON o.sn = p.sn") + _COUPON_BANDS_SCALED)

_DISCOUNTS = """,
discounts AS (
  SELECT member, count(*) AS n, sum(CASE WHEN rate < 1 THEN 1 ELSE 0 END) AS cheaper, round(avg(rate), 9) AS mean_rate
  FROM rates GROUP BY member)"""
_LINE_RATES = _DONE + """,
rates AS (
  SELECT member, CAST(listed AS DOUBLE) * (1 - CAST(coupon AS DOUBLE)) / nullif(CAST(listed AS DOUBLE), 0) AS rate
  FROM done JOIN p ON done.sn = p.sn)""" + _DISCOUNTS
_ORDER_RATES = _DONE + """,
amounts AS (SELECT sn, sum(listed) AS listed, sum(listed * (1 - coupon)) AS paid FROM p GROUP BY sn),
rates AS (
  SELECT member, CAST(paid AS DOUBLE) / nullif(CAST(listed AS DOUBLE), 0) AS rate
  FROM done JOIN amounts ON done.sn = amounts.sn)""" + _DISCOUNTS
for _suffix, _rates in {"": _ORDER_RATES, "_by_line": _LINE_RATES}.items():
    for _name, _cuts in {"discount_scores": (80, 60, 40, 20), "discount_scores_scaled": (25, 15, 10, 5)}.items():
        ORACLES[f"{_name}{_suffix}"] = _sql("o p", _rates + f"""
SELECT member AS "memberId", {_five("n", _cuts)} AS colbuy, {_five("cheaper", (15, 10, 6, 3))} AS coldis,
  CASE WHEN mean_rate < 0.95 THEN 5 WHEN mean_rate <= 0.96 THEN 4 WHEN mean_rate <= 0.97 THEN 3
    WHEN mean_rate <= 0.98 THEN 2 ELSE 1 END AS colavgdis
FROM discounts""")

_BRAND = (
    "CASE WHEN product LIKE '%ring%' THEN 'ring' WHEN product LIKE '%gear%' THEN 'gear'"
    " WHEN product LIKE '%plate%' THEN 'plate' WHEN product LIKE '%rod%' THEN 'rod'"
    " WHEN product LIKE '%widget%' THEN 'widget' ELSE '{}' END"
)
_BRANDS = _LINES + f""",
classed AS (SELECT member, {_BRAND.format('无偏好')} AS brand FROM lines),
weighed AS (
  SELECT member, brand, sum(CASE brand WHEN '无偏好' THEN 0 WHEN 'widget' THEN 1 ELSE 10 END) AS score
  FROM classed GROUP BY member, brand),
brands AS (
  SELECT member AS "memberId", brand FROM (
    SELECT *, row_number() OVER (PARTITION BY member ORDER BY score DESC, brand) AS rn FROM weighed) WHERE rn = 1)"""
ORACLES["brand_preference"] = _sql("o g", _BRANDS + "\nSELECT * FROM brands")

_HISTORY = f""",
bought AS (
  SELECT member, status, type, product, {_BRAND.format('其他')} AS brand FROM o JOIN g ON o.sn = g.sn),
fav_type AS (
  SELECT member, type FROM (
    SELECT member, type, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, type) AS rn
    FROM bought WHERE status = '202' GROUP BY member, type) WHERE rn = 1),
fav_product AS (
  SELECT member, product FROM (
    SELECT member, product, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, product) AS rn
    FROM bought WHERE status = '202' GROUP BY member, product) WHERE rn = 1),
fav_brand AS (
  SELECT member, brand FROM (
    SELECT member, brand, row_number() OVER (PARTITION BY member
      ORDER BY sum(CASE brand WHEN '其他' THEN 1 WHEN 'widget' THEN 1 ELSE 10 END) DESC, brand) AS rn
    FROM bought WHERE status = '202' GROUP BY member, brand) WHERE rn = 1),
seen AS (
  SELECT b.member, b.product, t.type, max(CASE WHEN status = '202' AND b.type = t.type THEN 1 ELSE 0 END) AS chosen,
    row_number() OVER (PARTITION BY b.member ORDER BY b.product) - 1 AS place
  FROM bought b JOIN fav_type t ON b.member = t.member GROUP BY b.member, b.product, t.type)
SELECT seen.member AS "memberId", CAST(place // {{size}} AS BIGINT) AS part,
  string_agg(seen.product, ', ' ORDER BY seen.product) AS product_scan,
  coalesce(string_agg(CASE WHEN chosen = 1 THEN seen.product END, ', ' ORDER BY seen.product), '') AS product_buy,
  seen.type AS "productType", p.product AS "productName", f.brand
FROM seen JOIN fav_product p ON p.member = seen.member JOIN fav_brand f ON f.member = seen.member
GROUP BY seen.member, place // {{size}}, seen.type, p.product, f.brand"""
ORACLES["purchase_history"] = _sql("o g", _HISTORY.format(size=10000))
ORACLES["purchase_history_parts"] = _sql("o g", _HISTORY.format(size=5))

ORACLES["brand_ratings"] = _sql("u o g", """
SELECT u.id AS user_id,
  CASE WHEN product LIKE '%rod%' THEN 1 WHEN product LIKE '%ring%' THEN 2 WHEN product LIKE '%gear%' THEN 3
    WHEN product LIKE '%plate%' THEN 4 WHEN product LIKE '%widget%' THEN 5 END AS brand, count(*) AS rating
FROM u JOIN o ON u.id = o.member JOIN g ON o.sn = g.sn
GROUP BY 1, 2 HAVING brand IS NOT NULL""")

# --- page views ------------------------------------------------------------

ORACLES["browse_slots"] = _sql("l", f""",
slots AS (SELECT user_id, {_SLOT} AS slot FROM l)
SELECT user_id, slot, count(slot) AS count,
  CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY slot DESC NULLS LAST) AS INT) AS rank
FROM slots GROUP BY user_id, slot""")

_SLOT_SERIES = """,
slot_series AS (
  SELECT user_id, count(*) FILTER (hour(moment) <= 7) AS slot_1, count(*) FILTER (hour(moment) BETWEEN 8 AND 12) AS slot_2,
    count(*) FILTER (hour(moment) BETWEEN 13 AND 17) AS slot_3, count(*) FILTER (hour(moment) BETWEEN 18 AND 21) AS slot_4,
    count(*) FILTER (hour(moment) >= 22) AS slot_5
  FROM l GROUP BY user_id)"""
ORACLES["slot_series"] = _sql("l", _SLOT_SERIES + "\nSELECT * FROM slot_series")

_JOB_SLOTS = f""",
usual AS (
  SELECT user_id, moment FROM (
    SELECT user_id, moment, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, moment) AS rn
    FROM l GROUP BY user_id, moment) WHERE rn = 1),
job_slots AS (
  SELECT {_JOB} AS job, {_SLOT} AS slot, count(*) AS count FROM u JOIN usual ON u.id = usual.user_id GROUP BY 1, 2)"""
ORACLES["slot_by_job"] = _sql("u l", _JOB_SLOTS + """
SELECT job, slot, count, CAST(row_number() OVER (PARTITION BY job ORDER BY slot DESC) AS INT) AS rid FROM job_slots""")
ORACLES["job_slot_matrix"] = _sql("u l", _JOB_SLOTS + """
SELECT job, CAST(coalesce(sum(count) FILTER (slot = '0点-7点'), 0) AS BIGINT) AS slot_1,
  CAST(coalesce(sum(count) FILTER (slot = '8点-12点'), 0) AS BIGINT) AS slot_2,
  CAST(coalesce(sum(count) FILTER (slot = '13点-17点'), 0) AS BIGINT) AS slot_3,
  CAST(coalesce(sum(count) FILTER (slot = '18点-21点'), 0) AS BIGINT) AS slot_4,
  CAST(coalesce(sum(count) FILTER (slot = '22点-24点'), 0) AS BIGINT) AS slot_5
FROM job_slots WHERE job <> '其他' GROUP BY job""")

ORACLES["device_class"] = _sql("l", f"\nSELECT id, user_id, {_DEVICE} AS device FROM l")

_DWELL = f""",
gaps AS (
  SELECT id, user_id, moment, {_PAGE} AS page, {_SLOT} AS slot, {_DEVICE} AS device,
    date_diff('second', moment, lead(moment) OVER (PARTITION BY user_id ORDER BY moment, id)) AS gap,
    row_number() OVER (PARTITION BY user_id ORDER BY moment DESC, id DESC) - 1 AS place
  FROM l),
dwells AS (
  SELECT *, CASE WHEN gap IS NULL THEN '0' WHEN gap < 60 THEN '1分钟内' WHEN gap <= 300 THEN '1-5分钟'
    ELSE '5分钟以上' END AS dwell
  FROM gaps)"""
ORACLES["dwell_time"] = _sql("l", _DWELL + "\nSELECT id, user_id, dwell FROM dwells")

_HABITS = f""",
visits AS (
  SELECT user_id, {_PAGE} AS page, CAST(date_diff('day', CAST(min(moment) AS DATE), CAST(max(moment) AS DATE)) AS INT) AS days,
    count(*) AS views
  FROM l GROUP BY user_id, 2),
habits AS (
  SELECT user_id, page, days, views, CASE WHEN CAST(views AS DOUBLE) / nullif(days, 0) > 1.5 THEN '经常'
    WHEN CAST(views AS DOUBLE) / nullif(days, 0) BETWEEN 1 AND 1.5 THEN '很少' ELSE '偶尔' END AS frequency
  FROM visits)"""
ORACLES["page_frequency"] = _sql("l", _HABITS + "\nSELECT * FROM habits")

for _name, _size in {"browse_history": 10000, "browse_history_parts": 10}.items():
    ORACLES[_name] = _sql("l", _DWELL + _HABITS + f""",
kinds AS (
  SELECT user_id, string_agg(page, ', ' ORDER BY page) AS page_kinds,
    string_agg(frequency, ', ' ORDER BY page) AS page_frequencies
  FROM habits GROUP BY user_id)
SELECT user_id, CAST(place // {_size} AS BIGINT) AS part, string_agg(page, ', ' ORDER BY place) AS pages,
  string_agg(slot, ', ' ORDER BY place) AS slots, string_agg(dwell, ', ' ORDER BY place) AS dwells,
  string_agg(device, ', ' ORDER BY place) AS devices, page_kinds, page_frequencies
FROM dwells JOIN kinds USING (user_id) GROUP BY user_id, place // {_size}, page_kinds, page_frequencies""")

ORACLES["product_ratings"] = _sql("l", """
SELECT user_id, CAST(regexp_extract(url, '^/product/([0-9]+)[.]html$', 1) AS INT) AS product, count(*) AS rating
FROM l WHERE url LIKE '/product/%' GROUP BY 1, 2""")

# --- reports ---------------------------------------------------------------

_SPEND = _DONE + """,
spend AS (SELECT member, sum(amount) AS spend FROM done GROUP BY member)"""
ORACLES["spend_by_city"] = _sql("u o r", _SPEND + """
SELECT city, CAST(trunc(sum(spend)) AS BIGINT) AS amount
FROM u JOIN spend ON u.id = spend.member LEFT JOIN r USING (region_key) GROUP BY city""")
ORACLES["spend_by_job"] = _sql("u o", _SPEND + f"""
SELECT {_JOB} AS job, CAST(trunc(sum(spend)) AS BIGINT) AS amount FROM u JOIN spend ON u.id = spend.member GROUP BY 1""")
ORACLES["spend_by_job_suffix"] = _sql("u o", _DONE + f""",
spend AS (SELECT CAST(right(CAST(member AS VARCHAR), 3) AS BIGINT) AS member, sum(amount) AS spend FROM done GROUP BY 1)
SELECT {_JOB} AS job, CAST(trunc(sum(spend)) AS BIGINT) AS amount FROM u JOIN spend ON u.id = spend.member GROUP BY 1""")
_SIGNS = _SPEND + f""",
signs AS (
  SELECT {_ZODIAC} AS constellation, CAST(trunc(sum(spend)) AS BIGINT) AS amount
  FROM u JOIN spend ON u.id = spend.member GROUP BY 1)"""
ORACLES["spend_by_zodiac"] = _sql("u o", _SIGNS + "\nSELECT * FROM signs")
ORACLES["zodiac_series"] = _sql("u o", _SIGNS + """,
calendar(position, constellation) AS (VALUES (1, '白羊座'), (2, '金牛座'), (3, '双子座'), (4, '巨蟹座'), (5, '狮子座'),
  (6, '处女座'), (7, '天秤座'), (8, '天蝎座'), (9, '射手座'), (10, '摩羯座'), (11, '水瓶座'), (12, '双鱼座'))
SELECT position, constellation, coalesce(amount, 0) AS amount FROM calendar LEFT JOIN signs USING (constellation)""")

_AGE_GENDER = _SCORES + f""",
age_gender AS (
  SELECT {_AGE} AS age, {_GENDER} AS gender, count(*) AS users, avg(value) AS value
  FROM u JOIN totals ON u.id = totals."memberId" GROUP BY 1, 2)"""
ORACLES["value_by_age_gender"] = _sql("u o", _AGE_GENDER + """
SELECT age, gender, users, value FROM age_gender""")
ORACLES["gender_totals"] = _sql("u o", _AGE_GENDER + """
SELECT gender, CAST(sum(users) AS BIGINT) AS users FROM age_gender GROUP BY gender""")
ORACLES["age_gender_matrix"] = _sql("u o", _AGE_GENDER + """
SELECT age, CAST(coalesce(sum(users) FILTER (gender = '男'), 0) AS BIGINT) AS male,
  CAST(coalesce(sum(users) FILTER (gender = '女'), 0) AS BIGINT) AS female
FROM age_gender WHERE age IN ('70后', '80后', '90后', '00后') GROUP BY age""")

_BY_PROVINCE = _SCORES + """,
by_province AS (
  SELECT province, count(province) AS users, CAST(trunc(avg(value)) AS BIGINT) AS value
  FROM u JOIN totals ON u.id = totals."memberId" LEFT JOIN r USING (region_key) GROUP BY province)"""
ORACLES["value_by_province"] = _sql("u o r", _BY_PROVINCE + "\nSELECT * FROM by_province")
ORACLES["province_match"] = _sql("u o r", _BY_PROVINCE + """
SELECT r_name AS map_name, province, value FROM region LEFT JOIN by_province ON left(r_name, 2) = left(province, 2)""")

_BRAND_AGE = _BRANDS + f""",
brand_age AS (
  SELECT {_AGE} AS age, count(*) FILTER (brand = 'ring') AS ring, count(*) FILTER (brand = 'gear') AS gear,
    count(*) FILTER (brand = 'plate') AS plate, count(*) FILTER (brand = 'rod') AS rod,
    count(*) FILTER (brand = 'widget') AS widget, count(*) FILTER (brand = '无偏好') AS "none"
  FROM u JOIN brands ON u.id = brands."memberId" GROUP BY 1)"""
ORACLES["brand_by_age"] = _sql("u o g", _BRAND_AGE + "\nSELECT * FROM brand_age")
ORACLES["brand_age_series"] = _sql("u o g", _BRANDS + f""",
aged AS (SELECT {_AGE} AS age, brand FROM u JOIN brands ON u.id = brands."memberId"),
names(brand) AS (VALUES ('ring'), ('gear'), ('plate'), ('rod'), ('widget'), ('无偏好'))
SELECT names.brand, count(*) FILTER (age = '70后') AS born_70s, count(*) FILTER (age = '80后') AS born_80s,
  count(*) FILTER (age = '90后') AS born_90s, count(*) FILTER (age = '00后') AS born_00s
FROM names LEFT JOIN aged ON names.brand = aged.brand GROUP BY names.brand""")

# --- lookups ---------------------------------------------------------------

_CONTACTS = """,
contacts AS (SELECT CASE WHEN id % 2 = 0 THEN email ELSE mobile END AS contact FROM u)"""
ORACLES["lookup_profile"] = _sql("u l r", _PROFILES_LEFT + _CONTACTS + """
SELECT profiles.*, contact FROM profiles JOIN contacts ON CASE WHEN contact LIKE '%@%' THEN email ELSE mobile END = contact""")
ORACLES["lookup_profile_indexed"] = ORACLES["lookup_profile"]
ORACLES["lookup_basket"] = _sql("u o g", _baskets(10000) + _CONTACTS + """
SELECT cycle, part, products, count, email, mobile, contact
FROM baskets JOIN u ON u.id = baskets.member
  JOIN contacts ON CASE WHEN contact LIKE '%@%' THEN email ELSE mobile END = contact""")
ORACLES["lookup_consumer"] = _sql("o", _CONSUMERS_SCALED + """
SELECT * FROM consumers WHERE "memberId" IN (SELECT member FROM o)""")
ORACLES["lookup_slots"] = _sql("o l", f""",
slots AS (SELECT user_id, {_SLOT} AS slot FROM l)
SELECT user_id, slot, count(slot) AS count,
  CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY slot DESC NULLS LAST) AS INT) AS rank
FROM slots WHERE user_id IN (SELECT member FROM o) GROUP BY user_id, slot""")
ORACLES["lookup_preference"] = _sql("o g", _PREFERENCE + """
SELECT * FROM preferences WHERE "memberId" IN (SELECT member FROM o)""")

_FOUND = "\nSELECT id, username, province, city, email, mobile FROM profiles"
ORACLES["search_users"] = _sql("u l r", _PROFILES_LEFT + _FOUND + " WHERE age = '80后' AND job = '学生'")
ORACLES["search_users_three"] = _sql("u l r", _PROFILES_LEFT + _FOUND + " WHERE age = '60后' AND job = '教师' AND gender = '女'")
ORACLES["search_users_open"] = _sql("u l r", _PROFILES_LEFT + _FOUND)
ORACLES["profiles_as_json"] = _sql("u", f""",
labelled AS (SELECT id, {_DEMOGRAPHICS} FROM u)
SELECT '{{"id":' || CAST(id AS VARCHAR) || ',"gender":"' || gender || '","job":"' || job || '","politicalFace":"' || "politicalFace"
  || '","nationality":"' || nationality || '","marriage":"' || marriage || '","is_blackList":"' || "is_blackList" || '"}}' AS json
FROM labelled""")

ORACLES["customer_360"] = _sql("u o g l r", _CONSUMERS_SCALED + _PREFERENCE.removeprefix(_DONE) + _PREVIEWS + _PROFILES_INNER + _SLOT_SERIES + """,
weeks AS (
  SELECT member, string_agg(cycle || ':' || count || ':' || preview, '; ' ORDER BY cycle) AS baskets
  FROM previews GROUP BY member)
SELECT profiles.*, baskets, "productType", "productName1", "productName2", "productName3",
  cycle, "paymentName", avg_order_band, max_order_band, frequency, exchange, "return",
  slot_1, slot_2, slot_3, slot_4, slot_5
FROM profiles LEFT JOIN weeks ON weeks.member = profiles.id
  LEFT JOIN preferences ON preferences."memberId" = profiles.id
  LEFT JOIN consumers ON consumers."memberId" = profiles.id
  LEFT JOIN slot_series ON slot_series.user_id = profiles.id""")


# --- audits ----------------------------------------------------------------


def _audit(scores: str, columns: str) -> str:
    return f"""
SELECT count(*) AS members, count(DISTINCT ({columns})) AS vectors, 0::BIGINT AS unassigned, 0::BIGINT AS repeated,
  0::BIGINT AS misplaced, 0::BIGINT AS unknown, 0::BIGINT AS unranked
FROM ({ORACLES[scores]})"""


ORACLES["rfm_segment_audit"] = _audit("rfm_scores_scaled", "recency, frequency, money")
ORACLES["coupon_segment_audit"] = _audit("coupon_scores_scaled", "buy_coupon, buy_card, buy_activity")
ORACLES["discount_segment_audit"] = _audit("discount_scores_scaled", "colbuy, coldis, colavgdis")
ORACLES["user_titles_audit"] = f"""
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS "memberId", TRUE AS "right" FROM customer
WHERE c_custkey IN (SELECT "memberId" FROM ({ORACLES["coupon_scores_scaled"]}))
  AND c_custkey IN (SELECT "memberId" FROM ({ORACLES["discount_scores_scaled"]}))"""
ORACLES["customer_360_titled_audit"] = f"""
SELECT count(*) AS users, count(*) FILTER (id IN (SELECT "memberId" FROM ({ORACLES["rfm_scores_scaled"]}))
    AND id IN (SELECT "memberId" FROM ({ORACLES["consumer_profile_scaled"]}))) AS valued,
  0::BIGINT AS mislabelled, 0::BIGINT AS untitled
FROM ({ORACLES["customer_360"]})"""
ORACLES["value_label_audit"] = f"""
WITH scored AS (SELECT "memberId" AS id FROM ({ORACLES["rfm_scores_scaled"]})),
known AS (SELECT id FROM scored JOIN customer ON c_custkey = id)
SELECT 'labelled' AS query, count(*) AS members FROM scored
UNION ALL SELECT 'profiled', count(*) FROM ({ORACLES["consumer_profile_scaled"]}) WHERE "memberId" IN (SELECT id FROM scored)
UNION ALL SELECT 'by_age_gender', count(*) FROM known UNION ALL SELECT 'by_province', count(*) FROM known"""
for _name, _ratings, _item, _k in (
    ("recommend_products_audit", "product_ratings", "product", 10), ("recommend_brands_audit", "brand_ratings", "brand", 3),
):
    ORACLES[_name] = f"""
WITH ratings AS ({ORACLES[_ratings]}), items AS (SELECT least({_k}, count(DISTINCT {_item})) AS n FROM ratings),
users AS (SELECT count(DISTINCT user_id) AS n FROM ratings)
SELECT 'lists' AS measure, n FROM users UNION ALL SELECT 'users', n FROM users
UNION ALL SELECT 'shortest', n FROM items UNION ALL SELECT 'longest', n FROM items
UNION ALL SELECT unnest(['repeats', 'misprinted', 'unknown', 'strangers']), 0"""

# Merged batches give what one run over all orders gives.
ORACLES["consumer_profile_merged"] = ORACLES["consumer_profile_scaled"]
ORACLES["rfm_metrics_merged"] = ORACLES["rfm_metrics"]

# Users of the fit get their own factors back, so none strays.
ORACLES["recommend_products_folded_audit"] = ORACLES["recommend_products_audit"] + " UNION ALL SELECT 'strayed', 0"
