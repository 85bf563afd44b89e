"""The same answers in plain SQL, written from the definitions and not from the plans.

Each entry is one WITH chain over the benchmark tables. Columns have the names
and types of the registered query of the same key.
"""

from __future__ import annotations

from .queries import (
    FIRST_MONTH,
    LAST_MONTH,
    REGION,
    SEGMENT_CATEGORY,
    SEGMENT_REGION,
    SELECTED,
)

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, price_cents"

# Raw table with planted faults ---------------------------------------------

LINES = """
lines AS (
  SELECT *,
    ((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 7) + 7) % 7 AS lead,
    CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 4 WHEN '4' THEN 4 ELSE 5 END AS scheduled,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
    l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS line_profit
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
moments AS (
  SELECT *,
    CASE WHEN l_orderkey % 13 = 0 AND lead = 1 THEN o_orderdate + INTERVAL 23 HOUR
         ELSE o_orderdate END AS ordered,
    CASE WHEN l_orderkey % 13 = 0 AND lead = 1 THEN o_orderdate + to_days(CAST(lead AS INTEGER)) + INTERVAL 1 HOUR
         WHEN l_orderkey % 17 = 0 AND lead = 0 THEN o_orderdate - INTERVAL 1 HOUR
         ELSE o_orderdate + to_days(CAST(lead AS INTEGER)) END AS shipped
  FROM lines
)"""


def _text(moment: str) -> str:
    return (
        f"CASE WHEN l_orderkey % 2 = 0 THEN strftime({moment}, '%-m/%-d/%Y %-H:%M') "
        f"ELSE strftime({moment}, '%Y-%m-%d %H:%M:%S') END"
    )


RAW = f"""{LINES},
once AS (
  SELECT {KEY},
    CASE WHEN l_orderkey % 211 = 0 THEN 'not a date' ELSE {_text('ordered')} END
      AS order_date_dateorders,
    {_text('shipped')} AS shipping_date_dateorders,
    CASE WHEN l_suppkey % 7 <> 0 THEN CAST(lead > scheduled AS INTEGER) END AS late_delivery_risk,
    CASE WHEN c_custkey % 97 <> 0 THEN n_name END AS order_region,
    r_name AS market,
    n_name AS order_country,
    l_partkey AS product_card_id,
    CASE WHEN l_partkey % 101 = 0 AND l_linenumber % 2 = 0 THEN p_name || ' (renamed)'
         ELSE p_name END AS product_name,
    p_type AS category_name,
    p_brand AS department_name,
    o_custkey AS customer_id,
    c_mktsegment AS customer_segment,
    n_name AS customer_country,
    n_name AS customer_city,
    r_name AS customer_state,
    CASE WHEN l_orderkey % 301 <> 0 THEN l_orderkey END AS order_id,
    CASE WHEN lead > scheduled THEN 'Late delivery' WHEN lead = scheduled THEN 'Shipping on time'
         ELSE 'Advance shipping' END AS delivery_status,
    l_extendedprice AS sales,
    CASE WHEN l_partkey % 53 = 0 THEN 'n.a.' ELSE CAST(line_profit AS VARCHAR) END
      AS order_profit_per_order,
    l_discount AS order_item_discount_rate,
    CAST(l_quantity AS INTEGER) AS order_item_quantity,
    CASE WHEN l_orderkey % 10 >= 6 THEN 'About ' || p_name END AS product_description
  FROM moments
),
raw AS (
  SELECT * FROM once UNION ALL SELECT * FROM once WHERE l_orderkey % 20 = 0
)"""


def _parse(c: str) -> str:
    return f"COALESCE(try_strptime({c}, '%m/%d/%Y %H:%M'), TRY_CAST({c} AS TIMESTAMP))"


_FLOOR_DAYS = (
    "CAST(floor((epoch_us(shipping_date) - epoch_us(order_date)) / 86400000000.0) AS INTEGER)"
)

DATED = f"""{RAW},
dated AS (
  SELECT *, {_parse('order_date_dateorders')} AS order_date,
    {_parse('shipping_date_dateorders')} AS shipping_date
  FROM raw
)"""

CLEAN = f"""{RAW},
unified AS (
  SELECT DISTINCT * REPLACE (
    COALESCE(late_delivery_risk, 0) AS late_delivery_risk,
    COALESCE(TRY_CAST(order_profit_per_order AS DOUBLE), 0.0) AS order_profit_per_order)
  FROM raw
),
clean_dated AS (
  SELECT *, {_parse('order_date_dateorders')} AS order_date,
    {_parse('shipping_date_dateorders')} AS shipping_date
  FROM unified
),
clean AS (
  SELECT *, {_FLOOR_DAYS} AS actual_lead_days,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    strftime(order_date, '%Y-%m') AS order_year_month
  FROM clean_dated
)"""

FACT = f"""{CLEAN},
fact AS (
  SELECT order_id, customer_id, product_card_id AS product_id, order_region AS region_name,
    order_year_month AS year_month, order_date, shipping_date, actual_lead_days AS lead_days,
    late_delivery_risk AS late_risk_flag, delivery_status, sales AS sales_amount,
    order_profit_per_order AS profit, order_item_discount_rate AS discount_rate,
    order_item_quantity AS quantity, {KEY}
  FROM clean WHERE order_id IS NOT NULL
),
product AS (
  SELECT DISTINCT product_card_id AS product_id, product_name, category_name, department_name
  FROM clean WHERE product_card_id IS NOT NULL
),
customers AS (
  SELECT DISTINCT customer_id, customer_segment AS segment, customer_country AS country,
    customer_city AS city, customer_state AS state
  FROM clean WHERE customer_id IS NOT NULL
),
regions AS (
  SELECT DISTINCT order_region AS region_name, market AS market_name, order_country AS country
  FROM clean WHERE order_region IS NOT NULL
),
dates AS (
  SELECT DISTINCT order_year_month AS year_month, order_year AS year, order_month AS month,
    order_quarter AS quarter
  FROM clean WHERE order_year_month IS NOT NULL
)"""

FACT_COLUMNS = (
    "order_id, customer_id, product_id, region_name, year_month, order_date, shipping_date, "
    "lead_days, late_risk_flag, delivery_status, sales_amount, profit, discount_rate, quantity"
)


_UNIT = str(1 << 40) + ".0::DOUBLE"


def _sum(c: str, only: str = "") -> str:
    """A sum of doubles that does not depend on their order: wholes and two fractions apart."""
    fine = f"(({c} - round_even({c}, 0)) * {_UNIT})"
    finest = f"(({fine} - round_even({fine}, 0)) * {_UNIT})"
    whole, fine, finest = (
        f"CAST(SUM(CAST(round_even({part}, 0) AS HUGEINT)) {only} AS DOUBLE)" for part in (c, fine, finest)
    )
    return f"({whole} + ({fine} + {finest} / {_UNIT}) / {_UNIT})"


def _money(c: str) -> str:
    return f"ROUND({_sum(c)}, 2)"


def _mean(c: str) -> str:
    return f"{_sum(c)} / COUNT({c})"


MONTHLY = f"""{FACT},
monthly AS (
  SELECT year_month, region_name,
    COUNT(*) AS total_orders,
    CAST(SUM(late_risk_flag) AS BIGINT) AS late_orders,
    ROUND(AVG(late_risk_flag) * 100, 2) AS late_risk_pct,
    ROUND(AVG(lead_days), 1) AS avg_lead_days,
    {_money('sales_amount')} AS total_sales,
    {_money('profit')} AS total_profit,
    ROUND({_sum('discount_rate')} * 100 / COUNT(discount_rate), 2) AS avg_discount_pct
  FROM fact GROUP BY year_month, region_name
)"""

DEPARTMENTS = f"""{FACT},
departments AS (
  SELECT p.department_name, f.year_month,
    COUNT(*) AS total_orders,
    ROUND(AVG(f.late_risk_flag) * 100, 2) AS late_risk_pct,
    {_money('f.sales_amount')} AS total_sales,
    {_money('f.profit')} AS total_profit
  FROM fact f JOIN product p ON f.product_id = p.product_id
  GROUP BY p.department_name, f.year_month
)"""

_RATES = """
  SELECT year_month, region_name,
    COUNT(order_id) AS total_orders,
    CAST(COALESCE(SUM(is_anomaly), 0) AS BIGINT) AS anomaly_count,
    round_even(COALESCE(SUM(is_anomaly), 0) / CAST(COUNT(order_id) AS DOUBLE) * 100, 2)
      AS anomaly_rate_pct
  FROM {source}
  WHERE year_month IS NOT NULL AND region_name IS NOT NULL
  GROUP BY year_month, region_name
"""

RATES = f"""{MONTHLY},
loss_flagged AS (SELECT *, CAST(profit < 0 AS INTEGER) AS is_anomaly FROM fact),
rates AS ({_RATES.format(source='loss_flagged')})"""

SCORES = f"""{RATES},
base AS (
  SELECT m.*, COALESCE(r.anomaly_rate_pct, 0.0) AS anomaly_rate_pct
  FROM monthly m LEFT JOIN rates r
    ON m.year_month = r.year_month AND m.region_name = r.region_name
),
extremes AS (
  SELECT MIN(late_risk_pct) AS late_low, MAX(late_risk_pct) AS late_high,
    MIN(anomaly_rate_pct) AS rate_low, MAX(anomaly_rate_pct) AS rate_high
  FROM base
),
normed AS (
  SELECT base.*,
    CASE WHEN late_low = late_high THEN 50.0
         ELSE (late_risk_pct - late_low) / (late_high - late_low) * 100 END AS late_risk_norm,
    CASE WHEN rate_low = rate_high THEN 50.0
         ELSE (anomaly_rate_pct - rate_low) / (rate_high - rate_low) * 100 END AS anomaly_norm
  FROM base, extremes
),
scored AS (
  SELECT *, GREATEST(0.0, LEAST(100.0,
    round_even(late_risk_norm * CAST(0.5 AS DOUBLE) + anomaly_norm * CAST(0.3 AS DOUBLE) + 20, 1)))
    AS disruption_score
  FROM normed
),
scores AS (
  SELECT *, CASE WHEN disruption_score >= 70 THEN 'High' WHEN disruption_score >= 40 THEN 'Medium'
    ELSE 'Low' END AS risk_tier
  FROM scored
)"""

_IN = ", ".join(f"'{r}'" for r in SELECTED)
CHOSEN = f"""{SCORES},
chosen AS (
  SELECT * FROM scores
  WHERE region_name IN ({_IN}) AND year_month >= '{FIRST_MONTH}' AND year_month <= '{LAST_MONTH}'
    AND risk_tier IN ('High', 'Medium', 'Low')
)"""

ENCODED = f"""{FACT},
codes AS (
  SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS region_encoded
  FROM (SELECT DISTINCT COALESCE(region_name, 'Unknown') AS label FROM fact)
),
encoded AS (
  SELECT fact.*, region_encoded FROM fact JOIN codes ON COALESCE(region_name, 'Unknown') = label
)"""

# Forecast ------------------------------------------------------------------
# One recursion step per month; a grid point is a pair of whole numbers of 1/200.


def _recursion(name: str, grid: str) -> str:
    """Likelihood of each grid point, and the best point of each region."""
    return f"""
{name}_walk AS (
  SELECT g.region_name, g.p, g.q, 0 AS t, CAST(0.0 AS DOUBLE) AS ahead,
    (1.0 + CAST(2.0 AS DOUBLE) * (g.p / 200.0::DOUBLE) * (g.q / 200.0::DOUBLE)
      + (g.q / 200.0::DOUBLE) * (g.q / 200.0::DOUBLE))
      / (1.0 - (g.p / 200.0::DOUBLE) * (g.p / 200.0::DOUBLE)) AS r,
    CAST(0.0 AS DOUBLE) AS squares, CAST(1.0 AS DOUBLE) AS product
  FROM {grid} g
  UNION ALL
  SELECT s.region_name, s.p, s.q, s.t + 1,
    (s.p / 200.0::DOUBLE) * c.w + (s.q / 200.0::DOUBLE) / s.r * (c.w - s.ahead),
    1.0 + (s.q / 200.0::DOUBLE) * (s.q / 200.0::DOUBLE)
      - (s.q / 200.0::DOUBLE) * (s.q / 200.0::DOUBLE) / s.r,
    s.squares + (c.w - s.ahead) * (c.w - s.ahead) / s.r,
    s.product * s.r
  FROM {name}_walk s JOIN changes c ON c.region_name = s.region_name AND c.t = s.t + 1
),
{name}_best AS (
  SELECT * FROM (
    SELECT w.*, n.m, n.last_value,
      row_number() OVER (PARTITION BY w.region_name ORDER BY
        ROUND(n.m * CASE WHEN squares > 0 THEN ln(squares / n.m) ELSE -1e6 END + ln(product), 8),
        abs(p), abs(q), p, q) AS place
    FROM {name}_walk w JOIN lengths n ON n.region_name = w.region_name AND n.m = w.t)
  WHERE place = 1
)"""


SERIES = f"""{MONTHLY},
points AS (
  SELECT region_name, late_risk_pct,
    row_number() OVER (PARTITION BY region_name ORDER BY year_month) - 1 AS position,
    COUNT(*) OVER (PARTITION BY region_name) AS months
  FROM monthly WHERE region_name IS NOT NULL AND year_month IS NOT NULL
)"""

FITS = f"""{SERIES},
changes AS (
  SELECT a.region_name, a.position AS t, a.late_risk_pct - b.late_risk_pct AS w
  FROM points a JOIN points b ON a.region_name = b.region_name AND a.position = b.position + 1
  WHERE a.months >= 12
),
lengths AS (
  SELECT region_name, months - 1 AS m, late_risk_pct AS last_value
  FROM points WHERE months >= 12 AND position = months - 1
),
coarse_grid AS (
  SELECT region_name, p, q
  FROM lengths, range(-190, 200, 10) AS a(p), range(-190, 200, 10) AS b(q)
),
{_recursion('coarse', 'coarse_grid')},
fine_grid AS (
  SELECT region_name, c.p + a.d AS p, c.q + b.d AS q
  FROM coarse_best c, range(-10, 11) AS a(d), range(-10, 11) AS b(d)
  WHERE abs(c.p + a.d) <= 199 AND abs(c.q + b.d) <= 199
),
{_recursion('fine', 'fine_grid')},
fits AS (
  SELECT region_name, CAST(m + 1 AS INTEGER) AS months, p / 200.0::DOUBLE AS phi,
    q / 200.0::DOUBLE AS theta, squares / m AS sigma2, last_value, ahead AS next_change,
    r AS next_r
  FROM fine_best
)"""

# ``n`` is the forecast step; ``b`` and ``c`` are the moving-average weights of
# the first and second step, scaled by the variance of the prediction they follow.
FORECASTS = f"""{FITS},
outlook AS (
  SELECT *, 1.0 + theta * theta - theta * theta / next_r AS r2, phi + theta / next_r AS b
  FROM fits
),
outlook3 AS (
  SELECT *, 1.0 + theta * theta - theta * theta / r2 AS r3, phi + theta / r2 AS c FROM outlook
),
steps AS (
  SELECT region_name, n,
    last_value + next_change * CASE n WHEN 1 THEN 1.0 WHEN 2 THEN 1.0 + phi
      ELSE 1.0 + phi + phi * phi END AS centre,
    CAST(1.959963984540054 AS DOUBLE) * sqrt(sigma2 * CASE n
      WHEN 1 THEN next_r
      WHEN 2 THEN (1.0 + b) * (1.0 + b) * next_r + r2
      ELSE (1.0 + b + phi * b) * (1.0 + b + phi * b) * next_r + (1.0 + c) * (1.0 + c) * r2 + r3
      END) AS reach
  FROM outlook3, range(1, 4) AS s(n)
),
forecasts AS (
  SELECT region_name, CAST(n AS INTEGER) AS forecast_step, 'T+' || n AS forecast_month,
    round_even(GREATEST(0.0, LEAST(100.0, centre)), 2) AS predicted_risk,
    round_even(GREATEST(0.0, centre - reach), 2) AS lower_bound,
    round_even(LEAST(100.0, centre + reach), 2) AS upper_bound
  FROM steps
)"""

LOSS_SIZE = f"""{FACT},
loss_size AS (
  SELECT {KEY}, order_id, year_month, region_name,
    CASE WHEN lead_days IS NOT NULL THEN -profit END AS anomaly_score
  FROM fact
),
loss_limit AS (SELECT quantile_cont(anomaly_score, 0.95) AS bound FROM loss_size),
size_flagged AS (
  SELECT loss_size.*, CAST(anomaly_score > bound AS INTEGER) AS is_anomaly
  FROM loss_size, loss_limit
)"""


def _with(chain: str, select: str) -> str:
    recursive = "RECURSIVE " if "_walk AS" in chain else ""
    return f"WITH {recursive}{chain.strip()}{select if select.startswith(',') else chr(10) + select}"


_RAW_COLUMNS = (
    f"{KEY}, order_date_dateorders, shipping_date_dateorders, late_delivery_risk, order_region, "
    "market, order_country, product_card_id, product_name, category_name, department_name, "
    "customer_id, customer_segment, customer_country, customer_city, customer_state, order_id, "
    "delivery_status, sales, order_profit_per_order, order_item_discount_rate, "
    "order_item_quantity, product_description"
)

# Name, Spark type and null test of each raw column, in table order.
_RAW_PROFILE = [
    ("l_orderkey", "bigint", "l_orderkey"),
    ("l_partkey", "bigint", "l_partkey"),
    ("l_suppkey", "bigint", "l_suppkey"),
    ("l_linenumber", "int", "l_linenumber"),
    ("price_cents", "bigint", "price_cents"),
    ("order date (DateOrders)", "string", "order_date_dateorders"),
    ("shipping date (DateOrders)", "string", "shipping_date_dateorders"),
    ("Late_delivery_risk", "int", "late_delivery_risk"),
    ("Order Region", "string", "order_region"),
    ("Market", "string", "market"),
    ("Order Country", "string", "order_country"),
    ("Product Card Id", "bigint", "product_card_id"),
    ("Product Name", "string", "product_name"),
    ("Category Name", "string", "category_name"),
    ("Department Name", "string", "department_name"),
    ("Customer Id", "bigint", "customer_id"),
    ("Customer Segment", "string", "customer_segment"),
    ("Customer Country", "string", "customer_country"),
    ("Customer City", "string", "customer_city"),
    ("Customer State", "string", "customer_state"),
    ("Order Id", "bigint", "order_id"),
    ("Delivery Status", "string", "delivery_status"),
    ("Sales", "double", "sales"),
    ("Order Profit Per Order", "string", "order_profit_per_order"),
    ("Order Item Discount Rate     ", "double", "order_item_discount_rate"),
    ("Order Item Quantity", "int", "order_item_quantity"),
    ("Product Description", "string", "product_description"),
]

_NULL_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS column_type, "
    f"COUNT(*) - COUNT({column}) AS null_count, COUNT(*) AS n FROM raw"
    for i, (name, kind, column) in enumerate(_RAW_PROFILE)
)

_CHECKS = {
    "no_null_order_date": "COUNT(*) = COUNT(order_date)",
    "no_null_region": "COUNT(*) = COUNT(order_region)",
    "late_risk_binary": "COUNT(*) = COUNT(*) FILTER (late_delivery_risk IN (0, 1))",
    "positive_sales": "COUNT(*) FILTER (sales >= 0) / COUNT(*)::DOUBLE > 0.95",
    "reasonable_lead_days":
        "COUNT(*) FILTER (actual_lead_days BETWEEN -5 AND 365) / COUNT(*)::DOUBLE > 0.95",
    "row_count_above_100k": "COUNT(*) > 100000",
}


def _check(name: str) -> str:
    return f"SELECT '{name}' AS check_name, {_CHECKS[name]} AS passed FROM clean"


_NO_DESCRIPTION = (
    _RAW_COLUMNS.replace(", product_description", "")
    + ", order_date, shipping_date, actual_lead_days, order_year, order_month, order_quarter, "
    "order_year_month"
)
_NO_KEY = _NO_DESCRIPTION.replace(KEY + ", ", "") + ", product_description"

_REPORT = """
SELECT class, "precision", recall, f1_score, support FROM by_class
UNION ALL
SELECT 'accuracy', a, a, a, n FROM (
  SELECT SUM(hits) / CAST(SUM(support) AS DOUBLE) AS a, CAST(SUM(support) AS BIGINT) AS n FROM by_class)
UNION ALL
SELECT 'macro avg', AVG("precision"), AVG(recall), AVG(f1_score), CAST(SUM(support) AS BIGINT) FROM by_class
UNION ALL
SELECT 'weighted avg', SUM("precision" * support) / SUM(support), SUM(recall * support) / SUM(support),
  SUM(f1_score * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM by_class
"""

REPORT = f"""{FACT},
guesses AS (
  SELECT late_risk_flag AS actual, CAST(COALESCE(lead_days, 0) >= 3 AS INTEGER) AS guess FROM fact
),
classes AS (SELECT DISTINCT actual AS k FROM guesses UNION SELECT DISTINCT guess FROM guesses),
tallies AS (
  SELECT k, COUNT(*) FILTER (actual = k AND guess = k) AS hits,
    COUNT(*) FILTER (actual = k) AS support, COUNT(*) FILTER (guess = k) AS guessed
  FROM classes, guesses GROUP BY k
),
by_class AS (
  SELECT CAST(k AS VARCHAR) AS class,
    CASE WHEN guessed = 0 THEN 0.0 ELSE hits / CAST(guessed AS DOUBLE) END AS "precision",
    CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS recall,
    CASE WHEN guessed + support = 0 THEN 0.0
         ELSE 2 * hits / CAST(guessed + support AS DOUBLE) END AS f1_score,
    support, hits
  FROM tallies
)"""

_METRICS = """
SELECT 'late_share' AS experiment, region_name AS run_id, 'monthly' AS run_name, 'metric' AS kind,
  'late_risk_pct' AS key, late_risk_pct AS value, total_orders AS step,
  CAST(year_month || '-01' AS TIMESTAMP) AS logged_at
FROM monthly WHERE region_name IS NOT NULL AND year_month IS NOT NULL
"""

ALL_REGIONS = [f"NATION_{k}" for k in range(25)]
_MATRIX = ", ".join(
    _sum("disruption_score", f"FILTER (region_name = '{r}')")
    + f" / COUNT(disruption_score) FILTER (region_name = '{r}') AS \"{r}\""
    for r in ALL_REGIONS
)

_SEED_TEXT = f"'42|' || concat_ws('|', {KEY})"


def _split(source: str) -> str:
    """Rows with their place among the rows of their label, in the order of a draw."""
    return f""", drawn AS (
      SELECT *, CAST('0x' || substr(md5({_SEED_TEXT}), 1, 8) AS BIGINT) % 4096 AS bucket FROM {source}),
    counted AS (SELECT late_risk_flag, bucket, COUNT(*) AS n FROM drawn GROUP BY ALL),
    placed AS (
      SELECT *, SUM(n) OVER (PARTITION BY late_risk_flag ORDER BY bucket) - n AS place FROM counted),
    split AS (
      SELECT d.*, p.place * 20 % 100 < 20 AS is_test, CAST(p.place % 5 AS INTEGER) AS fold
      FROM drawn d JOIN placed p
      ON d.bucket = p.bucket AND d.late_risk_flag IS NOT DISTINCT FROM p.late_risk_flag)"""


_KNOWN = "lead_days IS NOT NULL AND quantity IS NOT NULL AND sales_amount IS NOT NULL AND discount_rate IS NOT NULL AND profit IS NOT NULL"
MODEL_ROWS = f"""{ENCODED},
model_rows AS (SELECT * FROM encoded WHERE {_KNOWN} AND late_risk_flag IS NOT NULL){_split('model_rows')}"""
_SHARES = "SELECT unnest(['lead_days', 'quantity', 'sales_amount', 'discount_rate', 'profit', 'region_encoded']) AS feature, true AS is_share, 1.0::DOUBLE AS total"

ORACLE: dict[str, str] = {
    # Sources and sinks
    "read_orders_csv": _with(CLEAN, f"SELECT DISTINCT {_NO_KEY} FROM clean"),
    "write_clean_parquet": _with(
        CLEAN, f"SELECT {KEY}, order_id, order_date, order_year, order_year_month, sales FROM clean"
    ),
    "write_feed_parquet": _with(RATES, "SELECT * FROM rates"),
    "read_feed_parquet": _with(SCORES, "SELECT * FROM scores"),
    "publish_table": _with(FACT, "SELECT * FROM customers"),
    "publish_view": _with(MONTHLY, "SELECT * FROM monthly"),
    "read_published": _with(FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "log_run_metrics": _with(MONTHLY, _METRICS),
    "read_run_metrics": _with(
        MONTHLY,
        f"""SELECT experiment, run_id, key, arg_max(value, logged_at) AS value,
        arg_max(step, logged_at) AS step, COUNT(*) AS entries
        FROM ({_METRICS}) GROUP BY experiment, run_id, key""",
    ),
    # Profiling
    "profile_shape": _with(
        RAW, f"SELECT COUNT(*) AS row_count, {len(_RAW_PROFILE)} AS column_count FROM raw"
    ),
    "profile_nulls": _with(
        RAW,
        f"""SELECT column_name, column_type, null_count, null_count * 100 / n::DOUBLE AS null_pct
        FROM ({_NULL_ROWS}) ORDER BY null_count DESC, position LIMIT 15""",
    ),
    "profile_value_counts": _with(
        RAW,
        """SELECT order_region AS value, COUNT(*) AS occurrences FROM raw
        WHERE order_region IS NOT NULL GROUP BY order_region""",
    ),
    "profile_distinct": _with(RAW, "SELECT DISTINCT order_region AS value FROM raw"),
    "profile_date_range": _with(
        DATED, "SELECT MIN(order_date) AS first_order, MAX(order_date) AS last_order FROM dated"
    ),
    # Cleaning
    "clean_normalize_columns": _with(RAW, f"SELECT {_RAW_COLUMNS} FROM raw"),
    "clean_parse_dates": _with(DATED, f"SELECT {KEY}, order_date, shipping_date FROM dated"),
    "clean_lead_days": _with(DATED, f"SELECT {KEY}, {_FLOOR_DAYS} AS actual_lead_days FROM dated"),
    "clean_calendar": _with(
        DATED,
        f"""SELECT {KEY}, CAST(year(order_date) AS INTEGER) AS order_year,
        CAST(month(order_date) AS INTEGER) AS order_month,
        CAST(quarter(order_date) AS INTEGER) AS order_quarter,
        strftime(order_date, '%Y-%m') AS order_year_month FROM dated""",
    ),
    "clean_late_flag": _with(
        RAW, f"SELECT {KEY}, COALESCE(late_delivery_risk, 0) AS late_delivery_risk FROM raw"
    ),
    "clean_profit": _with(
        RAW,
        f"""SELECT {KEY}, COALESCE(TRY_CAST(order_profit_per_order AS DOUBLE), 0.0)
        AS order_profit_per_order FROM raw""",
    ),
    "clean_dedup": _with(
        RAW,
        f"""SELECT {KEY}, ANY_VALUE(order_id) AS order_id, COUNT(*) - 1 AS removed
        FROM raw GROUP BY {KEY}""",
    ),
    "clean_drop_sparse": _with(
        RAW, f"SELECT DISTINCT {_RAW_COLUMNS.replace(', product_description', '')} FROM raw"
    ),
    "clean_orders": _with(CLEAN, f"SELECT {_NO_DESCRIPTION} FROM clean"),
    # Quality
    "dq_no_null_order_date": _with(CLEAN, _check("no_null_order_date")),
    "dq_no_null_region": _with(CLEAN, _check("no_null_region")),
    "dq_late_risk_binary": _with(CLEAN, _check("late_risk_binary")),
    "dq_positive_sales": _with(CLEAN, _check("positive_sales")),
    "dq_reasonable_lead_days": _with(CLEAN, _check("reasonable_lead_days")),
    "dq_min_rows": _with(CLEAN, _check("row_count_above_100k")),
    "dq_report": _with(
        CLEAN,
        " UNION ALL ".join(_check(name) for name in _CHECKS)
        + f" UNION ALL SELECT 'all_passed', {' AND '.join(f'({c})' for c in _CHECKS.values())}"
        " FROM clean",
    ),
    "dim_key_uniqueness": _with(
        FACT,
        """SELECT product_id AS key_value, COUNT(*) AS versions FROM product
        GROUP BY product_id HAVING COUNT(*) > 1""",
    ),
    # Star schema
    "dim_region": _with(FACT, "SELECT * FROM regions"),
    "dim_product": _with(FACT, "SELECT * FROM product"),
    "dim_customer": _with(FACT, "SELECT * FROM customers"),
    "dim_date": _with(FACT, "SELECT * FROM dates"),
    "fact_orders": _with(FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "table_row_counts": _with(
        FACT,
        """SELECT 'dim_region' AS table_name, COUNT(*) AS row_count FROM regions
        UNION ALL SELECT 'dim_product', COUNT(*) FROM product
        UNION ALL SELECT 'dim_customer', COUNT(*) FROM customers
        UNION ALL SELECT 'dim_date', COUNT(*) FROM dates
        UNION ALL SELECT 'fact_orders', COUNT(*) FROM fact""",
    ),
    # KPIs
    "monthly_risk_by_region": _with(MONTHLY, "SELECT * FROM monthly"),
    "department_kpis": _with(DEPARTMENTS, "SELECT * FROM departments"),
    "top_risk_region_months": _with(
        MONTHLY,
        """SELECT year_month, region_name, late_risk_pct, total_orders FROM monthly
        ORDER BY late_risk_pct DESC NULLS LAST, year_month NULLS LAST, region_name NULLS LAST
        LIMIT 5""",
    ),
    "segment_risk": _with(
        FACT,
        f"""SELECT c.segment, COUNT(*) AS total_orders,
          CAST(SUM(f.late_risk_flag) AS BIGINT) AS late_orders,
          ROUND(AVG(f.late_risk_flag) * 100, 2) AS late_risk_pct
        FROM fact f JOIN customers c ON f.customer_id = c.customer_id
        JOIN product p ON f.product_id = p.product_id
        WHERE f.region_name = '{SEGMENT_REGION}' AND p.category_name = '{SEGMENT_CATEGORY}'
        GROUP BY c.segment""",
    ),
    # Classification
    "encode_region": _with(ENCODED, f"SELECT {KEY}, region_name, region_encoded FROM encoded"),
    "classifier_features": _with(
        ENCODED,
        f"""SELECT {KEY}, lead_days, quantity, sales_amount, discount_rate, profit, region_encoded,
        late_risk_flag FROM encoded
        WHERE lead_days IS NOT NULL AND quantity IS NOT NULL AND sales_amount IS NOT NULL
          AND discount_rate IS NOT NULL AND profit IS NOT NULL AND late_risk_flag IS NOT NULL""",
    ),
    "stratified_split": _with(
        FACT,
        f"""{_split('fact')} SELECT {KEY}, late_risk_flag, is_test FROM split""",
    ),
    "auc_roc": _with(
        FACT,
        """, by_score AS (
          SELECT lead_days * 10 + quantity AS score, COUNT(*) FILTER (late_risk_flag = 1) AS pos,
            COUNT(*) FILTER (late_risk_flag = 0) AS neg
          FROM fact WHERE lead_days IS NOT NULL GROUP BY 1),
        curve AS (
          SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tp FROM by_score)
        SELECT CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives,
          CAST(SUM(neg * (tp - pos + tp)) AS DOUBLE)
            / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE) * 2) AS auc
        FROM curve""",
    ),
    "classification_report": _with(REPORT, _REPORT),
    # Forecast
    "region_series": _with(
        SERIES,
        """SELECT region_name, CAST(months AS INTEGER) AS months,
        CAST(position AS INTEGER) AS position, late_risk_pct FROM points""",
    ),
    "forecast_eligibility": _with(
        SERIES,
        """SELECT DISTINCT region_name, CAST(months AS INTEGER) AS months,
        months >= 12 AS is_eligible FROM points""",
    ),
    "arima_fit": _with(FITS, "SELECT * FROM fits"),
    "forecast_risk_by_region": _with(FORECASTS, "SELECT * FROM forecasts"),
    "forecast_failures": _with(
        SERIES,
        """SELECT DISTINCT region_name, CAST(months AS INTEGER) AS months,
        'fit is not finite' AS reason FROM points
        WHERE months >= 12 AND CAST(split_part(region_name, '_', 2) AS INTEGER) % 3 = 0""",
    ),
    # Anomalies
    "anomaly_features": _with(
        FACT,
        """SELECT lead_days, sales_amount, profit, discount_rate, quantity FROM fact
        WHERE lead_days IS NOT NULL AND sales_amount IS NOT NULL AND profit IS NOT NULL
          AND discount_rate IS NOT NULL AND quantity IS NOT NULL""",
    ),
    "flag_anomalies": _with(
        LOSS_SIZE, f"SELECT {KEY}, anomaly_score, is_anomaly FROM size_flagged"
    ),
    "anomaly_summary": _with(
        LOSS_SIZE,
        """SELECT CAST(SUM(is_anomaly) AS BIGINT) AS anomalies,
        AVG(is_anomaly) * 100 AS anomaly_pct FROM size_flagged""",
    ),
    "attach_anomaly_flag": _with(
        FACT,
        f"""SELECT {KEY}, order_id,
        lead_days IS NOT NULL AND sales_amount IS NOT NULL AND profit IS NOT NULL
          AND discount_rate IS NOT NULL AND quantity IS NOT NULL AS has_flag,
        true AS flag_is_right FROM fact""",
    ),
    "monthly_anomaly_rate": _with(LOSS_SIZE, _RATES.format(source="size_flagged")),
    # Risk score
    "join_anomaly_rate": _with(SCORES, "SELECT * FROM base"),
    "minmax_normalize": _with(
        MONTHLY,
        """, ends AS (
          SELECT MIN(late_risk_pct) AS a, MAX(late_risk_pct) AS b, MIN(total_sales) AS c,
            MAX(total_sales) AS d FROM monthly)
        SELECT year_month, region_name,
          CASE WHEN a = b THEN 50.0 ELSE (late_risk_pct - a) / (b - a) * 100 END AS late_risk_norm,
          CASE WHEN c = d THEN 50.0 ELSE (total_sales - c) / (d - c) * 100 END AS sales_norm
        FROM monthly, ends""",
    ),
    "disruption_score": _with(
        SCORES, "SELECT year_month, region_name, disruption_score FROM scores"
    ),
    "risk_tier": _with(
        SCORES, "SELECT risk_tier, COUNT(*) AS region_months FROM scores GROUP BY risk_tier"
    ),
    "build_risk_scores": _with(SCORES, "SELECT * FROM scores"),
    "top_risk_scores": _with(
        SCORES,
        """SELECT year_month, region_name, late_risk_pct, disruption_score, risk_tier FROM scores
        ORDER BY disruption_score DESC NULLS LAST, year_month NULLS LAST, region_name NULLS LAST
        LIMIT 10""",
    ),
    # Dashboard tables
    "filter_options": _with(
        SCORES,
        """SELECT 'region' AS filter, region_name AS choice,
          row_number() OVER (ORDER BY region_name) <= 5 AS is_default
        FROM (SELECT DISTINCT region_name FROM scores WHERE region_name IS NOT NULL)
        UNION ALL
        SELECT 'month', year_month,
          year_month = (SELECT MIN(year_month) FROM scores)
            OR year_month = (SELECT MAX(year_month) FROM scores)
        FROM (SELECT DISTINCT year_month FROM scores WHERE year_month IS NOT NULL)""",
    ),
    "filter_risk_scores": _with(CHOSEN, "SELECT * FROM chosen"),
    "kpi_cards": _with(
        CHOSEN,
        f"""SELECT {_mean('disruption_score')} AS avg_disruption_score,
          COUNT(*) FILTER (risk_tier = 'High') AS high_risk_periods,
          {_mean('late_risk_pct')} AS avg_late_risk_pct, {_money('total_sales')} AS total_sales,
          {_mean('avg_lead_days')} AS avg_lead_days
        FROM chosen""",
    ),
    "risk_trend": _with(
        CHOSEN,
        f"""SELECT year_month, region_name, {_mean('disruption_score')} AS disruption_score
        FROM chosen WHERE year_month IS NOT NULL AND region_name IS NOT NULL
        GROUP BY year_month, region_name""",
    ),
    "risk_matrix": _with(
        SCORES,
        f"SELECT year_month, {_MATRIX} FROM scores WHERE year_month IS NOT NULL GROUP BY year_month",
    ),
    "latest_risk_by_region": _with(
        CHOSEN,
        """SELECT year_month, region_name, disruption_score, risk_tier FROM chosen
        WHERE year_month = (SELECT MAX(year_month) FROM chosen)""",
    ),
    "late_trend": _with(
        CHOSEN,
        f"""SELECT year_month, {_mean('late_risk_pct')} AS late_risk_pct FROM chosen
        GROUP BY year_month""",
    ),
    "anomaly_rate_by_region": _with(
        CHOSEN,
        f"""SELECT region_name, {_mean('anomaly_rate_pct')} AS anomaly_rate_pct FROM chosen
        GROUP BY region_name""",
    ),
    "forecast_for_region": _with(
        FORECASTS, f"SELECT * FROM forecasts WHERE region_name = '{REGION}'"
    ),
    "forecast_bands": _with(
        FORECASTS,
        """SELECT region_name, forecast_step, forecast_month, predicted_risk,
          upper_bound - predicted_risk AS error_up, predicted_risk - lower_bound AS error_down,
          CASE WHEN predicted_risk >= 70 THEN '#E24B4A' WHEN predicted_risk >= 40 THEN '#EF9F27'
               ELSE '#639922' END AS colour
        FROM forecasts""",
    ),
    "department_performance": _with(
        DEPARTMENTS,
        f"""SELECT department_name, {_money('total_sales')} AS total_sales,
          {_money('total_profit')} AS total_profit, {_mean('late_risk_pct')} AS late_risk_pct
        FROM departments WHERE department_name IS NOT NULL GROUP BY department_name""",
    ),
    # Questions
    "adhoc_sql": _with(
        FACT,
        """SELECT c.segment, p.category_name, COUNT(*) AS order_lines,
          CAST(SUM(f.late_risk_flag) AS BIGINT) AS late_lines
        FROM fact f JOIN customers c ON f.customer_id = c.customer_id
        JOIN product p ON f.product_id = p.product_id
        GROUP BY c.segment, p.category_name""",
    ),
    "q_highest_avg_score_region": _with(
        SCORES,
        f"""SELECT region_name, {_mean('disruption_score')} AS avg_disruption_score FROM scores
        GROUP BY region_name
        ORDER BY avg_disruption_score DESC NULLS LAST, region_name NULLS LAST LIMIT 1""",
    ),
    "q_months_most_anomalies": _with(
        RATES,
        """SELECT year_month, CAST(SUM(anomaly_count) AS BIGINT) AS anomalies FROM rates
        GROUP BY year_month""",
    ),
    "q_department_most_profit": _with(
        DEPARTMENTS,
        f"""SELECT department_name, {_money('total_profit')} AS total_profit FROM departments
        GROUP BY department_name
        ORDER BY total_profit DESC NULLS LAST, department_name NULLS LAST LIMIT 1""",
    ),
    "q_region_late_trend": _with(
        MONTHLY, f"SELECT year_month, late_risk_pct FROM monthly WHERE region_name = '{REGION}'"
    ),
    # Models: what holds of any sound one
    "save_model": _SHARES,
    "feature_importance": _SHARES,
    "load_model": _with(
        MODEL_ROWS, "SELECT COUNT(*) AS tested, true AS scores_agree FROM split WHERE is_test"
    ),
    "train_late_risk_forest": _with(
        MODEL_ROWS,
        """SELECT COUNT(*) FILTER (late_risk_flag = 1) AS positives,
        COUNT(*) FILTER (late_risk_flag = 0) AS negatives, true AS is_sound FROM split WHERE is_test""",
    ),
    "score_late_risk": _with(MODEL_ROWS, f"SELECT {KEY}, is_test, true AS is_sound FROM split"),
    "cross_validated_auc": _with(MODEL_ROWS, "SELECT DISTINCT fold, true AS is_sound FROM split"),
    "isolation_forest_fit": (
        "SELECT unnest(range(100))::INTEGER AS tree, 255 AS nodes, true AS is_sound"
    ),
    "isolation_forest_score": _with(
        FACT,
        f"""SELECT {KEY}, {_KNOWN} AS has_score, CASE WHEN {_KNOWN} THEN true END AS is_sound
        FROM fact""",
    ),
}
