"""The registered queries once more, as DuckDB SQL over the given tables.

Quotients are rounded on integers: both sides then agree on exact ties.
"""

from __future__ import annotations

from tillgrain.functions import labels

# The ordered rules, from the fixed values of ``functions.labels``.
SEGMENT_CASE = "CASE " + " ".join(
    f"WHEN recency_score BETWEEN {r[0]} AND {r[1]} AND frequency_score BETWEEN {f[0]} AND {f[1]}"
    f" AND monetary_score BETWEEN {m[0]} AND {m[1]} THEN '{name}'"
    for name, r, f, m in labels.SEGMENTS
) + f" ELSE '{labels.OTHER_SEGMENT}' END"
STATUS_CASE = "CASE " + " ".join(
    f"WHEN recency_days > {days} THEN '{name}'" for name, days in labels.STATUSES
) + f" ELSE '{labels.OTHER_STATUS}' END"

LINES = """
lines AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS invoice_no,
         CASE WHEN l.l_partkey % 37 = 0 THEN 'POST'
              ELSE lpad(CAST(l.l_partkey AS VARCHAR), 5, '0')
                   || CASE WHEN l.l_partkey % 5 = 0 THEN 'A' ELSE '' END END AS stock_code,
         CASE WHEN l.l_partkey % 53 <> 0 THEN p.p_name END AS description,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         o.o_orderdate AS invoice_date,
         CAST(p.p_retailprice AS DECIMAL(12,3)) AS unit_price,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         n.n_name AS country,
         CASE WHEN o.o_orderdate < TIMESTAMP '1998-07-01 00:00:00'
              THEN 'Period A' ELSE 'Period B' END AS source_period,
         CAST(CAST(l.l_quantity AS INTEGER) * CAST(p.p_retailprice AS DECIMAL(12,3))
              AS DECIMAL(14,3)) AS revenue
  FROM lineitem l, orders o, part p, supplier s, nation n
  WHERE l.l_orderkey = o.o_orderkey AND l.l_partkey = p.p_partkey
    AND l.l_suppkey = s.s_suppkey AND s.s_nationkey = n.n_nationkey)"""

TRANSACTIONS = (
    LINES
    + """,
tx AS (
  SELECT row_number() OVER (ORDER BY invoice_date, invoice_no, stock_code,
           description NULLS FIRST, quantity, unit_price, customer_id, country,
           source_period, revenue) AS transaction_id, *
  FROM lines)"""
)


SCALED = """,
logs AS (
  SELECT customer_id, ln(1 + greatest(CAST(recency_days AS DOUBLE), 0)) AS r,
         ln(1 + greatest(CAST(frequency AS DOUBLE), 0)) AS f,
         ln(1 + greatest(CAST(monetary AS DOUBLE), 0)) AS m
  FROM features),
scaled AS (
  SELECT customer_id, (r - avg(r) OVER ()) / stddev_samp(r) OVER () AS x,
         (f - avg(f) OVER ()) / stddev_samp(f) OVER () AS y,
         (m - avg(m) OVER ()) / stddev_samp(m) OVER () AS z
  FROM logs)"""


def _lloyd_step(number: int) -> str:
    """Centres after one more pass, and the cost and sizes of the pass."""
    before = f"centres_{number - 1}"
    return f""",
pass_{number} AS (
  SELECT c.*, c.far FROM (
    SELECT s.customer_id, s.x, s.y, s.z, b.cluster,
           (s.x - b.x) ** 2 + (s.y - b.y) ** 2 + (s.z - b.z) ** 2 AS far
    FROM scaled s, {before} b) c
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY far, cluster) = 1),
centres_{number} AS (
  SELECT b.cluster, coalesce(avg(p.x), any_value(b.x)) AS x, coalesce(avg(p.y), any_value(b.y)) AS y,
         coalesce(avg(p.z), any_value(b.z)) AS z, count(p.cluster) AS n, coalesce(sum(far), 0) AS cost
  FROM {before} b LEFT JOIN pass_{number} p USING (cluster) GROUP BY b.cluster)"""


LLOYD = """,
centres_0 AS (SELECT * FROM (VALUES (0, -1.0, -1.0, -1.0), (1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0),
                                    (3, 1.0, -1.0, -1.0)) t(cluster, x, y, z))""" + "".join(
    _lloyd_step(i) for i in (1, 2, 3)
)

SILHOUETTES = """,
sampled AS (SELECT x, y, z, CAST(customer_id AS BIGINT) AS id FROM scaled ORDER BY md5(customer_id) LIMIT 5000),
labelled AS (SELECT id, x, y, z, labelling, id % k AS label
             FROM sampled, (VALUES ('by_2', 2), ('by_3', 3)) t(labelling, k)),
sizes AS (SELECT labelling, label, count(*) AS n FROM labelled GROUP BY ALL),
sums AS (
  SELECT a.labelling, a.id, a.label AS own, b.label,
         sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) AS total
  FROM labelled a JOIN labelled b USING (labelling) GROUP BY ALL),
sides AS (
  SELECT labelling, id, max(CASE WHEN label = own THEN total / greatest(n - 1, 1) END) AS inside,
         min(CASE WHEN label <> own THEN total / n END) AS outside, max(CASE WHEN label = own THEN n END) AS n
  FROM sums JOIN sizes USING (labelling, label) GROUP BY ALL)
SELECT labelling, round(avg(CASE WHEN n > 1 AND greatest(inside, outside) > 0
         THEN (outside - inside) / greatest(inside, outside) ELSE 0 END), 6) AS silhouette
FROM sides GROUP BY labelling"""


def _newton_step(number: int) -> str:
    """Coefficients after one more Newton step, the 3 x 3 system solved by Cramer's rule."""
    before = f"beta_{number - 1}"
    return f""",
sums_{number} AS (
  SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2,
         sum(w * (p - y)) AS g0, sum(w * (p - y) * x1) + any_value(b1) AS g1,
         sum(w * (p - y) * x2) + any_value(b2) AS g2,
         sum(w * p * (1 - p)) AS a, sum(w * p * (1 - p) * x1) AS b, sum(w * p * (1 - p) * x2) AS c,
         sum(w * p * (1 - p) * x1 * x1) + 1 AS d, sum(w * p * (1 - p) * x1 * x2) AS e,
         sum(w * p * (1 - p) * x2 * x2) + 1 AS f
  FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM inputs, {before})),
beta_{number} AS (
  SELECT b0 - (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / det AS b0,
         b1 - (a * (g1 * f - e * g2) - g0 * (b * f - e * c) + c * (b * g2 - g1 * c)) / det AS b1,
         b2 - (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - d * c)) / det AS b2
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM sums_{number}))"""


NEWTON = """,
weighted AS (
  SELECT CAST(churn AS DOUBLE) AS y, CAST(recency_days AS DOUBLE) AS r, CAST(frequency AS DOUBLE) AS f,
         count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY churn)) AS w
  FROM training),
inputs AS (
  SELECT y, w, (r - avg(r) OVER ()) / stddev_pop(r) OVER () AS x1,
         (f - avg(f) OVER ()) / stddev_pop(f) OVER () AS x2
  FROM weighted),
beta_0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)""" + _newton_step(1) + _newton_step(2)

SELECTION = """,
scored AS (
  SELECT name, snapshot_date, churn,
         CASE dense_rank() OVER (ORDER BY snapshot_date DESC) WHEN 1 THEN 'test' WHEN 2 THEN 'validation' END AS split,
         CASE name WHEN 'recency rule' THEN (recency_days * 37 % 200) / 200.0::DOUBLE
                   ELSE (frequency * 61 % 100) / 100.0::DOUBLE END AS p
  FROM training, (VALUES ('recency rule'), ('frequency rule')) t(name)),
points AS (
  SELECT name, split, snapshot_date, p, sum(churn) AS pos, sum(1 - churn) AS neg
  FROM scored WHERE split IS NOT NULL GROUP BY ALL),
curve AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
  FROM points WINDOW w AS (PARTITION BY name, split ORDER BY p DESC)),
sums AS (
  SELECT name, split, snapshot_date, CAST(sum(pos) AS DOUBLE) AS pp, CAST(sum(neg) AS DOUBLE) AS nn,
         sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0::DOUBLE)) AS ranked,
         sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) AS gained,
         coalesce(CAST(sum(pos) FILTER (WHERE p >= 0.5) AS DOUBLE), 0) AS hits,
         coalesce(CAST(sum(neg) FILTER (WHERE p >= 0.5) AS DOUBLE), 0) AS alarms
  FROM curve GROUP BY ALL),
best AS (
  SELECT name FROM sums WHERE split = 'validation'
  ORDER BY ranked / (pp * nn) DESC, name = 'recency rule' DESC LIMIT 1),
named AS (
  SELECT name, split, snapshot_date, unnest(['roc_auc', 'pr_auc', 'f1', 'precision', 'recall']) AS metric,
         unnest([ranked / (pp * nn), gained / pp, 2 * hits / (hits + alarms + pp),
                 coalesce(hits / nullif(hits + alarms, 0), 0), hits / pp]) AS value
  FROM sums)
SELECT 'churn_classification' AS model_type, name AS model_name, split AS evaluation_split,
       snapshot_date AS evaluation_snapshot, metric, round(value, 9) AS value,
       name = (SELECT name FROM best) AS selected_model
FROM named WHERE split = 'validation' OR name = (SELECT name FROM best)"""


def _quotient(top: str, bottom: str, places: int) -> str:
    """Non-negative integers ``top / bottom``, rounded half up, as a decimal."""
    unit = "0." + "0" * (places - 1) + "1"
    digits = f"CAST((2 * 10**{places} * ({top}) + ({bottom})) // (2 * ({bottom})) AS DECIMAL(20,0))"
    digits = digits.replace(f"10**{places}", str(10**places))
    return f"CASE WHEN ({bottom}) > 0 THEN {digits} * CAST({unit} AS DECIMAL({places + 1},{places})) END"


def _mean_money(total: str, count: str, scale: int, places: int = 2) -> str:
    """Mean of a decimal total with ``scale`` places."""
    units = f"CAST(({total}) * {10**scale} AS HUGEINT)"
    return _quotient(units, f"{10**scale} * CAST({count} AS HUGEINT)", places)


ORDERS = """,
country_votes AS (
  SELECT customer_id, invoice_no, country, count(*) AS votes
  FROM lines GROUP BY ALL),
order_country AS (
  SELECT customer_id, invoice_no, country
  FROM country_votes
  QUALIFY row_number() OVER (PARTITION BY customer_id, invoice_no
                             ORDER BY votes DESC, country) = 1),
order_rows AS (
  SELECT customer_id, invoice_no, min(invoice_date) AS placed, sum(revenue) AS exact_revenue,
         sum(quantity) AS items, count(DISTINCT stock_code) AS products
  FROM lines GROUP BY customer_id, invoice_no),
seq AS (
  SELECT r.*, c.country,
         lag(placed) OVER (PARTITION BY customer_id ORDER BY placed, invoice_no) AS placed_before
  FROM order_rows r JOIN order_country c USING (customer_id, invoice_no))"""

HISTORY = """,
history AS (
  SELECT customer_id, invoice_no, placed AS order_timestamp, CAST(placed AS DATE) AS order_date,
         CAST(exact_revenue AS DECIMAL(22,2)) AS order_revenue,
         CAST(items AS BIGINT) AS items_purchased, products AS unique_products, country,
         CAST(placed_before AS DATE) AS previous_order_date,
         CAST(date_diff('day', CAST(placed_before AS DATE), CAST(placed AS DATE)) AS INTEGER)
           AS days_since_previous_order
  FROM seq)"""

FEATURES = (
    ORDERS
    + HISTORY
    + f""",
home AS (
  SELECT customer_id, country
  FROM (SELECT customer_id, country, count(*) AS votes FROM history GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY votes DESC, country) = 1),
range_of AS (
  SELECT customer_id, count(DISTINCT stock_code) AS unique_products,
         count(DISTINCT strftime(invoice_date, '%Y-%m')) AS active_months
  FROM lines GROUP BY customer_id),
person AS (
  SELECT customer_id, min(order_date) AS first_purchase_date, max(order_date) AS last_purchase_date,
         count(DISTINCT invoice_no) AS frequency,
         CAST(sum(order_revenue) AS DECIMAL(22,2)) AS monetary,
         CAST({_mean_money("sum(order_revenue)", "count(*)", 2)} AS DECIMAL(22,2)) AS average_order_value,
         CAST(sum(items_purchased) AS BIGINT) AS total_items,
         CAST({_quotient("coalesce(CAST(sum(days_since_previous_order) AS HUGEINT), 0)", "count(days_since_previous_order)", 2)}
              AS DECIMAL(10,2)) AS avg_days_between_orders
  FROM history GROUP BY customer_id),
measured AS (
  SELECT p.*, h.country AS primary_country, r.unique_products, r.active_months,
         CAST(date_diff('day', last_purchase_date,
              (SELECT CAST(max(invoice_date) AS DATE) FROM lines)) AS INTEGER) AS recency_days,
         CAST(date_diff('day', first_purchase_date, last_purchase_date) AS INTEGER) AS tenure_days
  FROM person p JOIN home h USING (customer_id) JOIN range_of r USING (customer_id)),
quartered AS (
  SELECT *,
         CAST(ntile(4) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS recency_score,
         CAST(ntile(4) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS frequency_score,
         CAST(ntile(4) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS monetary_score
  FROM measured),
features AS (
  SELECT customer_id, first_purchase_date, last_purchase_date, frequency, monetary,
         average_order_value, total_items, avg_days_between_orders, primary_country,
         unique_products, active_months, recency_days, tenure_days,
         recency_score, frequency_score, monetary_score,
         recency_score + frequency_score + monetary_score AS rfm_score,
         {SEGMENT_CASE} AS rfm_segment,
         {STATUS_CASE} AS rule_based_churn_status
  FROM quartered)"""
)

CURRENT = """,
today AS (SELECT CAST(max(invoice_date) AS DATE) + 1 AS day FROM lines),
recent AS (
  SELECT s.*, CASE WHEN placed_before >= day - 180
                   THEN date_diff('second', placed_before, placed) // 86400 END AS gap
  FROM seq s, today WHERE placed >= day - 180),
recent_products AS (
  SELECT customer_id, count(DISTINCT stock_code) AS products
  FROM lines, today WHERE invoice_date >= day - 180 GROUP BY customer_id),
recent_orders AS (
  SELECT customer_id, count(*) AS n, sum(exact_revenue) AS revenue,
         count(DISTINCT CAST(placed AS DATE)) AS days,
         CAST(sum(gap) AS DOUBLE) / nullif(count(gap), 0) AS mean_gap
  FROM recent GROUP BY customer_id),
life AS (
  SELECT customer_id, CAST(min(placed) AS DATE) AS first_day, CAST(max(placed) AS DATE) AS last_day
  FROM seq GROUP BY customer_id),
current_rows AS (
  SELECT customer_id,
         CAST(date_diff('day', last_day, day) AS INTEGER) AS recency_days,
         coalesce(n, 0) AS frequency,
         CAST(coalesce(revenue, 0) AS DECIMAL(24,3)) AS monetary,
         coalesce(CAST(revenue AS DOUBLE) / n, 0) AS average_order_value,
         coalesce(products, 0) AS unique_products,
         coalesce(days, 0) AS active_days,
         CAST(date_diff('day', first_day, day) AS INTEGER) AS tenure_days,
         mean_gap AS avg_days_between_orders
  FROM life LEFT JOIN recent_orders USING (customer_id)
       LEFT JOIN recent_products USING (customer_id), today)"""

# Scores that SQL can compute stand in for model output, so the steps behind the
# models are comparable.
ANALYTICS = (
    CURRENT
    + """,
raw_scores AS (
  SELECT customer_id, frequency,
         CASE WHEN frequency > 0 THEN (recency_days * 37 % 1000) / 1000.0::DOUBLE ELSE 0.99::DOUBLE END AS p,
         CASE WHEN frequency > 0 THEN frequency * 12.25::DOUBLE ELSE 0 END AS v
  FROM current_rows),
analytics AS (
  SELECT customer_id, CAST(CAST(customer_id AS BIGINT) % 2 AS INTEGER) AS rfm_cluster,
         CAST(p AS DECIMAL(6,4)) AS churn_probability,
         CASE WHEN p > 0.7 THEN 'High' WHEN p > 0.4 THEN 'Medium' ELSE 'Low' END AS churn_risk_band,
         CAST(v AS DECIMAL(16,2)) AS predicted_90d_value,
         CASE frequency WHEN 0 THEN 'Rule: no purchase in observation window'
              ELSE 'Selected classification model' END AS churn_score_method
  FROM raw_scores)"""
)

SNAPSHOTS = (
    ORDERS
    + """,
snap AS (
  SELECT CAST(unnest(['1999-12-01', '2000-03-01', '2000-06-01', '2000-09-01', '2000-12-01',
                      '2001-03-01']) AS DATE) AS snapshot_date),
past AS (
  SELECT snapshot_date, customer_id, count(*) AS frequency, sum(exact_revenue) AS revenue,
         max(placed) AS last_order_date, count(DISTINCT CAST(placed AS DATE)) AS active_days,
         CAST(sum(gap) AS DOUBLE) / nullif(count(gap), 0) AS mean_gap
  FROM (SELECT snapshot_date, seq.*,
               CASE WHEN placed_before >= snapshot_date - 180
                    THEN date_diff('second', placed_before, placed) // 86400 END AS gap
        FROM seq JOIN snap ON placed >= snapshot_date - 180 AND placed < snapshot_date)
  GROUP BY snapshot_date, customer_id),
past_products AS (
  SELECT snapshot_date, customer_id, count(DISTINCT stock_code) AS products
  FROM lines JOIN snap ON invoice_date >= snapshot_date - 180 AND invoice_date < snapshot_date
  GROUP BY snapshot_date, customer_id),
ahead AS (
  SELECT snapshot_date, customer_id, count(*) AS n, sum(exact_revenue) AS revenue
  FROM seq JOIN snap ON placed >= snapshot_date AND placed < snapshot_date + 90
  GROUP BY snapshot_date, customer_id),
firsts AS (SELECT customer_id, CAST(min(placed) AS DATE) AS first_day FROM seq GROUP BY customer_id),
training AS (
  SELECT customer_id,
         CAST(date_diff('day', CAST(last_order_date AS DATE), snapshot_date) AS INTEGER) AS recency_days,
         frequency, CAST(past.revenue AS DECIMAL(24,3)) AS monetary,
         CAST(past.revenue AS DOUBLE) / frequency AS average_order_value,
         products AS unique_products, active_days,
         CAST(date_diff('day', first_day, snapshot_date) AS INTEGER) AS tenure_days,
         mean_gap AS avg_days_between_orders, last_order_date,
         coalesce(n, 0) AS future_orders,
         CAST(coalesce(ahead.revenue, 0) AS DECIMAL(24,3)) AS future_revenue,
         CASE WHEN n IS NULL THEN 1 ELSE 0 END AS churn, snapshot_date
  FROM past LEFT JOIN past_products USING (snapshot_date, customer_id)
       LEFT JOIN ahead USING (snapshot_date, customer_id) JOIN firsts USING (customer_id))"""
)

DIRTY = """
joined AS (
  SELECT *, l_returnflag = 'R' AND l_linenumber % 4 = 0 AS returned,
         o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'
           AND o_orderdate < TIMESTAMP '1998-08-01 00:00:00' AS repeated,
         CASE WHEN o_orderdate < TIMESTAMP '1998-07-01 00:00:00'
              THEN 'Period A' ELSE 'Period B' END AS period
  FROM lineitem, orders, part, supplier, nation
  WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
    AND l_suppkey = s_suppkey AND s_nationkey = n_nationkey),
copied AS (
  SELECT *, period AS source_period FROM joined
  UNION ALL SELECT *, period FROM joined WHERE l_linenumber = 1
  UNION ALL SELECT *, 'Period A' FROM joined WHERE repeated),
tidy AS (
  SELECT CASE WHEN returned THEN 'c' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CASE WHEN l_partkey % 37 = 0 THEN 'POST'
              ELSE lpad(CAST(l_partkey AS VARCHAR), 5, '0') END AS stock_code,
         CASE WHEN l_partkey % 53 <> 0 THEN p_name END AS description,
         CASE WHEN returned THEN -l_quantity ELSE l_quantity END AS quantity,
         o_orderdate AS invoice_date,
         CASE WHEN l_partkey % 97 = 0 THEN 0
              WHEN l_partkey % 89 <> 0 THEN p_retailprice END AS price,
         CASE WHEN o_custkey % 43 = 0 THEN CAST(o_custkey + 9007199254740993 AS VARCHAR)
              WHEN o_custkey % 41 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE n_name WHEN 'NATION_3' THEN 'Nation Three' ELSE n_name END AS country,
         source_period
  FROM copied),
kept AS (
  SELECT invoice_no, stock_code, description, CAST(quantity AS INTEGER) AS quantity, invoice_date,
         CAST(price AS DECIMAL(12,3)) AS unit_price, customer_id, country, source_period,
         CAST(CAST(quantity AS INTEGER) * CAST(price AS DECIMAL(12,3)) AS DECIMAL(14,3)) AS revenue
  FROM (SELECT DISTINCT * FROM tidy)
  WHERE NOT starts_with(invoice_no, 'c') AND quantity > 0 AND price > 0
    AND customer_id IS NOT NULL)"""

MONTHLY = f""",
monthly AS (
  SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
         count(DISTINCT invoice_no) AS total_orders, count(DISTINCT customer_id) AS active_customers,
         CAST(sum(quantity) AS BIGINT) AS items_sold, CAST(sum(revenue) AS DECIMAL(22,2)) AS revenue,
         CAST({_mean_money("sum(revenue)", "count(DISTINCT invoice_no)", 3)} AS DECIMAL(22,2)) AS average_order_value
  FROM lines GROUP BY 1)"""

COUNTRIES = f""",
countries AS (
  SELECT country, count(DISTINCT customer_id) AS customers, count(DISTINCT invoice_no) AS orders,
         CAST(sum(revenue) AS DECIMAL(22,2)) AS revenue,
         CAST({_mean_money("sum(revenue)", "count(DISTINCT invoice_no)", 3)} AS DECIMAL(22,2)) AS average_order_value
  FROM lines GROUP BY country)"""

PRODUCTS = """,
products AS (
  SELECT stock_code, coalesce(max(description), 'Unknown Product') AS description,
         CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT invoice_no) AS orders,
         count(DISTINCT customer_id) AS customers, CAST(sum(revenue) AS DECIMAL(22,2)) AS revenue
  FROM lines WHERE regexp_full_match(stock_code, '[0-9]{5}[A-Z]?') GROUP BY stock_code)"""

EXECUTIVE = """
  SELECT transaction_id, invoice_no, stock_code,
         coalesce(description, 'Unknown Product') AS description, quantity, invoice_date,
         unit_price, customer_id, country, source_period, revenue,
         regexp_full_match(stock_code, '[0-9]{5}[A-Z]?') AS is_merchandise
  FROM tx"""

CUSTOMER_VIEW = """
  SELECT f.customer_id, primary_country, first_purchase_date, last_purchase_date, recency_days,
         f.frequency, monetary, average_order_value, total_items, unique_products, active_months,
         tenure_days, avg_days_between_orders, rfm_score, rfm_segment, rule_based_churn_status,
         rfm_cluster, churn_probability, churn_risk_band, predicted_90d_value, churn_score_method
  FROM features f LEFT JOIN analytics a ON f.customer_id = a.customer_id"""

DATASET = f""",
executive AS ({EXECUTIVE}),
customer_view AS ({CUSTOMER_VIEW}),
dataset AS (
  SELECT 'Transaction' AS record_type, 'T-' || CAST(transaction_id AS VARCHAR) AS record_id,
         CAST(year(invoice_date) AS INTEGER) AS transaction_year,
         CAST(date_trunc('month', invoice_date) AS DATE) AS transaction_month, *
  FROM executive
  UNION ALL BY NAME
  SELECT 'Customer' AS record_type, 'C-' || customer_id AS record_id, primary_country AS country, *
  FROM customer_view)"""

HOLDOUT = (
    SNAPSHOTS
    + """,
holdout AS (
  SELECT churn, CAST(future_revenue AS DOUBLE) AS actual,
         (recency_days * 37 % 200) / 200.0::DOUBLE AS p, frequency * 1024.0::DOUBLE AS guess
  FROM training WHERE snapshot_date = DATE '2001-03-01'),
points AS (
  SELECT p, sum(churn) AS pos, sum(1 - churn) AS neg FROM holdout GROUP BY p),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM points),
sums AS (
  SELECT CAST(sum(pos) AS DOUBLE) AS pp, CAST(sum(neg) AS DOUBLE) AS nn,
         sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0::DOUBLE)) AS ranked,
         sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) AS gained,
         CAST(sum(pos) FILTER (WHERE p >= 0.5) AS DOUBLE) AS hits,
         CAST(sum(neg) FILTER (WHERE p >= 0.5) AS DOUBLE) AS alarms
  FROM curve)"""
)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    signed_growth = (
        "CASE WHEN revenue < previous_month_revenue THEN -1 ELSE 1 END * "
        + _quotient(
            "100 * CAST(abs(revenue - previous_month_revenue) * 1000 AS HUGEINT)",
            "CAST(previous_month_revenue * 1000 AS HUGEINT)",
            2,
        )
    )
    return {
        "transactions": _with(TRANSACTIONS, "SELECT * FROM tx"),
        "clean_transactions": _with(DIRTY, "SELECT * FROM kept"),
        "quality_report": _with(
            DIRTY,
            """
SELECT count(*) AS raw_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tidy)) AS duplicate_rows_detected,
       count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_rows,
       count(*) FILTER (WHERE description IS NULL) AS missing_description_rows,
       count(*) FILTER (WHERE starts_with(upper(invoice_no), 'C')) AS cancelled_invoice_rows,
       count(*) FILTER (WHERE quantity <= 0) AS quantity_le_zero_rows,
       count(*) FILTER (WHERE price <= 0) AS price_le_zero_rows,
       (SELECT count(*) FROM kept) AS clean_rows,
       (SELECT count(DISTINCT customer_id) FROM kept) AS clean_customers,
       (SELECT count(DISTINCT invoice_no) FROM kept) AS clean_invoices,
       (SELECT count(DISTINCT country) FROM kept) AS clean_countries,
       (SELECT strftime(min(invoice_date), '%Y-%m-%dT%H:%M:%S') FROM kept) AS clean_date_min,
       (SELECT strftime(max(invoice_date), '%Y-%m-%dT%H:%M:%S') FROM kept) AS clean_date_max,
       (SELECT CAST(sum(revenue) AS DECIMAL(38,3)) FROM kept) AS clean_revenue
FROM tidy""",
        ),
        "run_checks": _with(
            LINES + ORDERS + ANALYTICS + "," + DIRTY.strip(),
            """,
raw_lines AS (
  SELECT *, CAST(price AS DECIMAL(12,3)) AS unit_price,
         CAST(quantity AS INTEGER) * CAST(price AS DECIMAL(12,3)) AS revenue
  FROM (SELECT DISTINCT * FROM tidy)),
broken AS (
  SELECT 'raw lines' AS table_name, unnest(['invoice_no missing', 'stock_code missing',
      'invoice_date missing', 'customer_id missing', 'country missing', 'source_period missing',
      'quantity not positive', 'unit_price not positive', 'revenue not positive',
      'revenue differs from quantity x price']) AS rule,
    unnest([count(*) - count(invoice_no), count(*) - count(stock_code),
      count(*) - count(invoice_date), count(*) - count(customer_id), count(*) - count(country),
      count(*) - count(source_period), count(*) - count_if(quantity > 0),
      count(*) - count_if(unit_price > 0), count(*) - count_if(revenue > 0),
      count(*) - count(revenue)]) AS broken
  FROM raw_lines
  UNION ALL
  SELECT 'scores', unnest(['customer_id missing', 'churn_score_method missing',
      'rfm_cluster negative', 'churn_probability outside 0-1', 'churn_risk_band unknown',
      'predicted_90d_value negative']),
    unnest([count(*) - count(customer_id), count(*) - count(churn_score_method),
      count(*) - count_if(rfm_cluster >= 0), count(*) - count_if(churn_probability BETWEEN 0 AND 1),
      count(*) - count_if(churn_risk_band IN ('Low', 'Medium', 'High')),
      count(*) - count_if(predicted_90d_value >= 0)])
  FROM analytics
  UNION ALL
  SELECT 'scores', 'customer_id without parent', count(*) FROM analytics
  WHERE customer_id NOT IN (SELECT customer_id FROM analytics)
  UNION ALL
  SELECT 'scores', 'customer_id repeated', count(*)
  FROM (SELECT customer_id FROM analytics GROUP BY customer_id HAVING count(*) > 1)
  UNION ALL
  SELECT 'raw lines', 'customer_id without parent', count(*) FROM raw_lines
  WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM analytics)
  UNION ALL
  SELECT 'raw lines', 'customer_id repeated', count(*)
  FROM (SELECT customer_id FROM raw_lines GROUP BY customer_id HAVING count(*) > 1))
SELECT table_name, rule, CAST(broken AS BIGINT) AS broken FROM broken""",
        ),
        "split_summary": _with(
            LINES + SNAPSHOTS,
            """,
parts AS (
  SELECT CASE dense_rank() OVER (ORDER BY snapshot_date DESC)
              WHEN 1 THEN 'test' WHEN 2 THEN 'validation' ELSE 'train' END AS split, churn
  FROM training)
SELECT split, churn, count(*) AS customers,
       round(sum(count(*)) OVER (PARTITION BY split)
             / (count(*) OVER (PARTITION BY split) * count(*)), 9) AS class_weight
FROM parts GROUP BY split, churn""",
        ),
        "value_targets": _with(
            LINES + SNAPSHOTS,
            """
SELECT snapshot_date, customer_id,
       round(ln(1 + greatest(CAST(future_revenue AS DOUBLE), 0)), 6) AS log_revenue,
       round(greatest(CAST(future_revenue AS DOUBLE), 0), 3) AS value
FROM training""",
        ),
        "scaled_measures": _with(
            LINES + FEATURES + SCALED,
            """
SELECT customer_id, round(x, 6) AS scaled_recency_days, round(y, 6) AS scaled_frequency,
       round(z, 6) AS scaled_monetary
FROM scaled""",
        ),
        "lloyd_steps": _with(
            LINES + FEATURES + SCALED + LLOYD,
            """
SELECT cluster, n, round(cost, 5) AS cost, round(x, 6) AS scaled_recency_days,
       round(y, 6) AS scaled_frequency, round(z, 6) AS scaled_monetary
FROM centres_3""",
        ),
        "logistic_steps": _with(
            LINES + SNAPSHOTS + NEWTON,
            """
SELECT unnest(['intercept', 'recency_days', 'frequency']) AS term,
       unnest([round(b0, 7), round(b1, 7), round(b2, 7)]) AS value
FROM beta_2""",
        ),
        "model_selection": _with(LINES + SNAPSHOTS, SELECTION),
        "period_reach": _with(
            LINES,
            """
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
       count(DISTINCT customer_id) AS active_customers, count(DISTINCT invoice_no) AS total_orders
FROM lines GROUP BY 1""",
        ),
        "silhouette_scores": _with(LINES + FEATURES + SCALED, SILHOUETTES),
        "order_history": _with(LINES + ORDERS + HISTORY, "SELECT * FROM history"),
        "customer_features": _with(LINES + FEATURES, "SELECT * FROM features"),
        "monthly_sales": _with(LINES + MONTHLY, "SELECT * FROM monthly"),
        "country_performance": _with(LINES + COUNTRIES, "SELECT * FROM countries"),
        "product_performance": _with(LINES + PRODUCTS, "SELECT * FROM products"),
        "snapshot_dataset": _with(LINES + SNAPSHOTS, "SELECT * FROM training"),
        "current_features": _with(LINES + ORDERS + CURRENT, "SELECT * FROM current_rows"),
        "customer_analytics_rules": _with(LINES + ORDERS + ANALYTICS, "SELECT * FROM analytics"),
        "classifier_metrics": _with(
            LINES + HOLDOUT,
            """
SELECT round(ranked / (pp * nn), 9) AS roc_auc, round(gained / pp, 9) AS pr_auc,
       round(2 * hits / (hits + alarms + pp), 9) AS f1,
       round(hits / (hits + alarms), 9) AS precision, round(hits / pp, 9) AS recall
FROM sums""",
        ),
        "regression_metrics": _with(
            LINES + HOLDOUT,
            """
SELECT round(avg(abs(actual - guess)), 3) AS mae,
       round(sqrt(avg((actual - guess) * (actual - guess))), 3) AS rmse,
       round(1 - sum((actual - guess) * (actual - guess)) / (var_pop(actual) * count(*)), 9) AS r2
FROM holdout""",
        ),
        "executive_dashboard": _with(TRANSACTIONS, EXECUTIVE),
        "customer_dashboard": _with(LINES + FEATURES + ANALYTICS, CUSTOMER_VIEW),
        "dashboard_dataset": _with(
            TRANSACTIONS + FEATURES + ANALYTICS + DATASET, "SELECT * FROM dataset"
        ),
        "export_rows": _with(
            TRANSACTIONS + FEATURES + ANALYTICS + DATASET, "SELECT * FROM dataset"
        ),
        "dashboard_integrity": _with(
            TRANSACTIONS + FEATURES + ANALYTICS + DATASET,
            """
SELECT count(*) AS total_rows, count(DISTINCT record_id) AS unique_record_ids,
       count(*) FILTER (WHERE record_type = 'Transaction') AS transaction_rows,
       count(*) FILTER (WHERE record_type = 'Customer') AS customer_rows,
       count(*) FILTER (WHERE record_id IS NULL) AS missing_record_ids,
       count(*) FILTER (WHERE record_type = 'Transaction'
         AND coalesce(CAST(monetary AS DOUBLE), CAST(churn_probability AS DOUBLE)) IS NOT NULL)
         AS contaminated_transaction_rows,
       count(*) FILTER (WHERE record_type = 'Customer'
         AND coalesce(CAST(transaction_id AS DOUBLE), CAST(revenue AS DOUBLE)) IS NOT NULL)
         AS contaminated_customer_rows
FROM dataset""",
        ),
        "record_counts": _with(
            TRANSACTIONS + FEATURES + ANALYTICS + DATASET,
            "SELECT record_type, count(*) AS row_count FROM dataset GROUP BY record_type",
        ),
        "data_validation": _with(
            LINES,
            """
SELECT count(*) AS transaction_rows, count(DISTINCT invoice_no) AS orders,
       count(DISTINCT customer_id) AS customers, min(invoice_date) AS first_transaction,
       max(invoice_date) AS last_transaction, CAST(sum(revenue) AS DECIMAL(24,3)) AS total_revenue
FROM lines""",
        ),
        "mom_growth": _with(
            LINES
            + """,
sums AS (
  SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
         CAST(sum(revenue) AS DECIMAL(24,3)) AS revenue
  FROM lines GROUP BY 1),
paired AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS previous_month_revenue FROM sums)""",
            f"""
SELECT month, revenue, previous_month_revenue,
       CAST({signed_growth} AS DECIMAL(18,2)) AS month_over_month_growth_pct
FROM paired ORDER BY month""",
        ),
        "country_ranking": _with(
            LINES + COUNTRIES, "SELECT * FROM countries ORDER BY revenue DESC, country"
        ),
        "top_products": _with(
            LINES + PRODUCTS, "SELECT * FROM products ORDER BY revenue DESC, stock_code LIMIT 20"
        ),
        "segment_contribution": _with(
            LINES + FEATURES,
            f"""
SELECT rfm_segment, count(*) AS customers,
       CAST(sum(monetary) AS DECIMAL(32,2)) AS historical_revenue,
       CAST({_quotient("CAST(sum(recency_days) AS HUGEINT)", "count(*)", 1)} AS DECIMAL(12,1)) AS average_recency,
       CAST({_quotient("CAST(sum(frequency) AS HUGEINT)", "count(*)", 1)} AS DECIMAL(12,1)) AS average_frequency,
       CAST({_mean_money("sum(monetary)", "count(*)", 2)} AS DECIMAL(22,2)) AS average_monetary
FROM features GROUP BY rfm_segment ORDER BY historical_revenue DESC, rfm_segment""",
        ),
        "churn_distribution": _with(
            LINES + FEATURES + ANALYTICS,
            f"""
SELECT churn_risk_band, count(*) AS customers,
       CAST({_mean_money("sum(churn_probability)", "count(*)", 4, 4)} AS DECIMAL(6,4)) AS average_probability,
       CAST(sum(monetary) AS DECIMAL(32,2)) AS historical_revenue,
       CAST(sum(predicted_90d_value) AS DECIMAL(26,2)) AS predicted_90d_value
FROM analytics JOIN features USING (customer_id)
GROUP BY churn_risk_band
ORDER BY list_position(['High', 'Medium', 'Low'], churn_risk_band)""",
        ),
        "retention_targets": _with(
            LINES + FEATURES + ANALYTICS,
            """
SELECT customer_id, primary_country, rfm_segment, recency_days, features.frequency, monetary,
       churn_probability, predicted_90d_value
FROM analytics JOIN features USING (customer_id)
WHERE churn_risk_band = 'High' ORDER BY monetary DESC, customer_id LIMIT 50""",
        ),
        "metrics_report": _with(
            LINES
            + HOLDOUT
            + """,
named AS (
  SELECT 'churn_classification' AS model_type,
         unnest(['roc_auc', 'pr_auc', 'f1', 'precision', 'recall']) AS metric,
         unnest([ranked / (pp * nn), gained / pp, 2 * hits / (hits + alarms + pp),
                 hits / (hits + alarms), hits / pp]) AS value
  FROM sums
  UNION ALL
  SELECT 'customer_value_regression', unnest(['mae', 'rmse', 'r2']),
         unnest([avg(abs(actual - guess)), sqrt(avg((actual - guess) * (actual - guess))),
                 1 - sum((actual - guess) * (actual - guess)) / (var_pop(actual) * count(*))])
  FROM holdout)""",
            """
SELECT model_type, 'stand-in' AS model_name, 'test' AS evaluation_split,
       DATE '2001-03-01' AS evaluation_snapshot, metric, CAST(value AS DECIMAL(20,4)) AS value,
       TRUE AS selected_model
FROM named""",
        ),
        "feature_medians": _with(
            LINES + SNAPSHOTS,
            """
SELECT median(avg_days_between_orders) AS avg_days_between_orders,
       median(average_order_value) AS average_order_value,
       CAST(median(recency_days) AS DOUBLE) AS recency_days
FROM training""",
        ),
        "cluster_profile_rules": _with(
            LINES + FEATURES,
            """
SELECT CAST(CAST(customer_id AS BIGINT) % 2 AS INTEGER) AS rfm_cluster,
       count(DISTINCT customer_id) AS customers,
       round(avg(recency_days), 3) AS avg_recency, round(avg(frequency), 3) AS avg_frequency,
       round(avg(monetary), 3) AS avg_monetary,
       round(CAST(sum(monetary) AS DOUBLE), 3) AS total_revenue
FROM features GROUP BY 1""",
        ),
        "order_gaps": _with(
            LINES + ORDERS + HISTORY,
            """
SELECT customer_id, invoice_no, order_date, previous_order_date, days_since_previous_order,
       order_revenue
FROM history WHERE previous_order_date IS NOT NULL
ORDER BY customer_id, order_date, invoice_no LIMIT 100""",
        ),
        "pareto": _with(
            LINES
            + FEATURES
            + """,
ranked AS (
  SELECT customer_id, monetary,
         row_number() OVER (ORDER BY monetary DESC, customer_id) AS customer_rank,
         count(*) OVER () AS customers,
         CAST(100 * sum(monetary) OVER (ORDER BY monetary DESC) AS HUGEINT) AS running,
         CAST(100 * sum(monetary) OVER () AS HUGEINT) AS total
  FROM features)""",
            f"""
SELECT customer_rank, customer_id, monetary,
       CAST({_quotient("100 * CAST(customer_rank AS HUGEINT)", "customers", 2)} AS DECIMAL(18,2)) AS customer_pct,
       CAST({_quotient("100 * running", "total", 2)} AS DECIMAL(18,2)) AS cumulative_revenue_pct
FROM ranked ORDER BY customer_rank""",
        ),
    }
