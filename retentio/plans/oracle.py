"""DuckDB oracle SQL for each catalogue key (same column names as Spark)."""

from __future__ import annotations

from .sqlbase import _flag
from .sqlbase import np_round_sql as npr
from .sqlbase import with_base
from .oracle_models import isolation_ctes, kmeans_ctes

ORACLES: dict[str, str] = {}

ORACLES["churn_label"] = with_base(
    "SELECT customer_id, label, tenure_months, last_order FROM cf")

ORACLES["derived_features"] = with_base(
    "SELECT customer_id, tenure_months, monthly_charges, total_charges, implied_tenure, "
    "is_new_customer, is_long_tenure, charge_gap, is_high_value, is_at_risk FROM eng")

ORACLES["customer_value"] = with_base(
    "SELECT customer_id, total_revenue_6mo, lifetime_value, avg_order_value, "
    "charge_to_ltv_ratio FROM eng")

_ENGAGEMENT = ["total_orders", "total_orders_6mo", "total_revenue_6mo", "avg_monthly_revenue_6mo", "revenue_volatility_6mo", "active_months_6mo", "total_cancellations_6mo", "avg_order_value", "total_support_tickets", "negative_support_tickets", "tickets_last_6mo", "negative_ticket_ratio"]
ORACLES["engagement_features"] = with_base(f"SELECT customer_id, {', '.join(_ENGAGEMENT)} FROM eng")

ORACLES["churn_by_contract"] = with_base(
    "SELECT contract_type, CAST(count(*) AS BIGINT) AS n_customers, "
    "CAST(sum(label) AS BIGINT) AS churned, "
    f"{npr('CAST(sum(label) AS BIGINT) / count(*) * 100.0::DOUBLE', 1)} AS churn_rate "
    "FROM cf GROUP BY contract_type")

ORACLES["risk_tier_distribution"] = with_base(
    "SELECT risk_tier, CAST(count(*) AS BIGINT) AS n FROM sc GROUP BY risk_tier", scored=True)

ORACLES["churn_by_tenure_band"] = with_base(
    "SELECT tenure_band, CAST(count(*) AS BIGINT) AS n_customers, "
    "CAST(sum(label) AS BIGINT) / count(*) AS churn_rate, "
    "CAST(CASE tenure_band WHEN '0-12' THEN 1 WHEN '12-24' THEN 2 WHEN '24-36' THEN 3 "
    "WHEN '36-48' THEN 4 WHEN '48-72' THEN 5 END AS INTEGER) AS band_order "
    "FROM (SELECT label, CASE WHEN tenure_months > 0 AND tenure_months <= 12 THEN '0-12' "
    "WHEN tenure_months > 12 AND tenure_months <= 24 THEN '12-24' "
    "WHEN tenure_months > 24 AND tenure_months <= 36 THEN '24-36' "
    "WHEN tenure_months > 36 AND tenure_months <= 48 THEN '36-48' "
    "WHEN tenure_months > 48 AND tenure_months <= 72 THEN '48-72' END AS tenure_band FROM cf) b "
    "WHERE tenure_band IS NOT NULL GROUP BY tenure_band")

ORACLES["segment_metrics"] = with_base(
    "SELECT segment, CAST(count(*) AS BIGINT) AS n_customers, CAST(sum(label) AS BIGINT) AS churned, "
    "CAST(sum(tenure_months) AS BIGINT) / count(*) AS avg_tenure, "
    f"{npr('avg(monthly_charges)', 4)} AS avg_monthly_charges, "
    "CAST(sum(total_support_tickets) AS BIGINT) / count(*) AS avg_tickets, "
    "CAST(sum(label) AS BIGINT) / count(*) AS churn_rate FROM eng GROUP BY segment")

ORACLES["segment_profile"] = with_base(
    "SELECT *, churn_pct::VARCHAR || '%' AS churn_display, '$' || format('{:,}', avg_ltv) AS ltv_display "
    "FROM (SELECT contract_type, CAST(count(*) AS BIGINT) AS n_customers, "
    "CAST(sum(label) AS BIGINT) AS churned, "
    f"{npr('CAST(sum(tenure_months) AS BIGINT) / count(*)', 2)} AS avg_tenure, "
    f"{npr('CAST(sum(total_support_tickets) AS BIGINT) / count(*)', 2)} AS avg_tickets, "
    f"CAST({npr('CAST(sum(CAST(lifetime_value AS DECIMAL(18,2))) AS DOUBLE) / count(lifetime_value)', 0)} AS BIGINT) AS avg_ltv, "
    f"{npr('CAST(sum(label) AS BIGINT) / count(*) * 100.0::DOUBLE', 1)} AS churn_pct "
    "FROM eng GROUP BY contract_type) g")

_MEAN_FEATURES = ["tenure_months", "total_orders", "total_orders_6mo", "active_months_6mo",
                  "total_support_tickets", "is_new_customer", "is_long_tenure", "label"]
ORACLES["segment_feature_means"] = with_base(
    "SELECT segment, CAST(count(*) AS BIGINT) AS n, "
    + ", ".join(f"{npr(f'avg(CAST({c} AS DOUBLE))', 1)} AS avg_{c}" for c in _MEAN_FEATURES)
    + " FROM eng GROUP BY segment")

ORACLES["prob_histogram"] = with_base(
    "SELECT risk_tier, bin, CAST(count(*) AS BIGINT) AS n, 0.0::DOUBLE + bin * 0.025::DOUBLE AS bin_lo "
    "FROM (SELECT risk_tier, CAST(least(floor(churn_prob / 0.025::DOUBLE), 39) AS INTEGER) AS bin "
    "FROM sc WHERE churn_prob BETWEEN 0.0 AND 1.0) h GROUP BY risk_tier, bin", scored=True)

_MONTHLY_CTES = """
mfacts AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ds,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS y_dec, CAST(count(*) AS BIGINT) AS n_orders
  FROM orders GROUP BY 1),
mcal AS (
  SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 MONTH)) AS DATE) AS ds FROM mfacts),
monthly AS (
  SELECT c.ds, CAST(coalesce(f.y_dec, 0) AS DOUBLE) AS y, CAST(coalesce(f.n_orders, 0) AS BIGINT) AS n_orders
  FROM mcal c LEFT JOIN mfacts f ON c.ds = f.ds),
"""


def monthly_sql(body: str, ctes: str = "") -> str:
    extra = (_MONTHLY_CTES + ctes).strip().rstrip(",")
    return f"WITH {extra}\n{body}"


ORACLES["kpi_summary"] = with_base(
    "SELECT CAST(count(*) AS BIGINT) AS total_customers, CAST(sum(label) AS BIGINT) AS churned, "
    "CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS churn_rate, "
    "CAST(count_if(risk_tier = 'HIGH') AS BIGINT) AS high_risk, "
    "CAST(sum(tenure_months) AS BIGINT) / count(*) AS avg_tenure, "
    f"{npr('avg(monthly_charges)', 4)} AS avg_monthly_charges, "
    "(SELECT y FROM mg ORDER BY ds DESC LIMIT 1) AS mrr, "
    "(SELECT mom_growth_pct FROM mg ORDER BY ds DESC LIMIT 1) AS mom_growth_pct FROM sc",
    scored=True, ctes=_MONTHLY_CTES + """
mg AS (SELECT ds, y, (y - lag(y) OVER (ORDER BY ds)) * 100.0::DOUBLE / nullif(lag(y) OVER (ORDER BY ds), 0)
       AS mom_growth_pct FROM monthly),""")

ORACLES["bronze_lineage"] = (
    "SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, 'orders_parquet' AS _source, "
    "'batch_0001' AS _batch_id FROM orders")

ORACLES["numeric_coerce"] = (
    "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0::DOUBLE) AS k_value, "
    "coalesce(TRY_CAST(event_type AS DOUBLE), 0.0::DOUBLE) AS type_value, "
    "coalesce(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 0.0::DOUBLE) AS value_text FROM events")


_FLAGS = ["is_male", "has_partner", "has_dependents", "has_paperless_billing", "is_monthly_contract",
          "is_annual_contract", "is_biannual_contract", "uses_electronic_check", "has_fiber_optic", "has_dsl",
          "no_internet", "has_online_security", "has_tech_support", "has_phone", "has_multiple_lines",
          "has_online_backup", "has_device_protect", "has_streaming_tv", "has_streaming_movies"]
ORACLES["binary_flags"] = with_base(f"SELECT customer_id, is_senior_citizen, {', '.join(_FLAGS)} FROM cf")

_TENURE = "CAST(tenure_months AS DOUBLE)"
_TICKETS = "CAST(num_support_tickets AS INTEGER)"
ORACLES["serving_features"] = with_base(
    "SELECT customer_id, is_male, is_senior_citizen, has_partner, has_dependents, "
    f"{_TENURE} AS tenure_months, monthly_charges, total_charges, "
    "CASE WHEN monthly_charges > 0 THEN total_charges / monthly_charges ELSE 0.0::DOUBLE END AS implied_tenure, "
    "is_monthly_contract, is_annual_contract, is_biannual_contract, uses_electronic_check, has_paperless_billing, "
    "has_fiber_optic, has_dsl, no_internet, has_online_security, has_tech_support, 1 AS has_phone, "
    "0 AS has_multiple_lines, 0 AS has_online_backup, 0 AS has_device_protect, 0 AS has_streaming_tv, "
    f"0 AS has_streaming_movies, is_new_customer, is_long_tenure, monthly_charges * {_TENURE} - total_charges AS charge_gap, "
    "0 AS services_count, is_high_value, is_at_risk, "
    f"{_TICKETS} AS total_support_tickets, greatest({_TICKETS} - 1, 0) AS negative_support_tickets, "
    f"{_TICKETS} AS tickets_last_6mo, 5 AS total_orders_6mo, "
    "monthly_charges * 6.0::DOUBLE AS total_revenue_6mo, monthly_charges AS avg_monthly_revenue_6mo, "
    "monthly_charges * 0.1::DOUBLE AS revenue_volatility_6mo, 0 AS total_cancellations_6mo, "
    f"least(6, CAST(trunc({_TENURE}) AS INTEGER)) AS active_months_6mo, "
    "total_charges AS lifetime_value, monthly_charges AS avg_order_value, "
    f"greatest(1, CAST(trunc({_TENURE}) AS INTEGER)) AS total_orders, "
    f"CASE WHEN num_support_tickets > 0 THEN greatest({_TICKETS} - 1, 0) / {_TICKETS} ELSE 0.0::DOUBLE END "
    "AS negative_ticket_ratio, "
    "CASE WHEN total_charges > 0 THEN monthly_charges / total_charges ELSE 0.0::DOUBLE END AS charge_to_ltv_ratio "
    "FROM eng")

_SERVICE = "('Yes', 'No', 'No internet service')"
_RULES = [
    ("customer_id_present", "customer_id IS NOT NULL"),
    ("tenure_months_non_negative", "tenure_months >= 0"),
    ("monthly_charges_non_negative", "monthly_charges >= 0"),
    ("total_charges_non_negative", "total_charges >= 0"),
    ("contract_type_domain", "contract_type IN ('Month-to-month', 'One year', 'Two year')"),
    ("payment_method_domain", "payment_method IN ('Electronic check', 'Mailed check', "
                              "'Bank transfer (automatic)', 'Credit card (automatic)')"),
    ("internet_service_domain", "internet_service IN ('Fiber optic', 'DSL', 'No')"),
    ("online_security_domain", f"online_security IN {_SERVICE}"),
    ("tech_support_domain", f"tech_support IN {_SERVICE}"),
    ("has_partner_domain", "partner IN ('Yes', 'No')"),
    ("has_dependents_domain", "dependents IN ('Yes', 'No')"),
    ("paperless_billing_domain", "paperless_billing IN ('Yes', 'No')"),
    ("gender_domain", "gender IN ('Male', 'Female')"),
    ("num_support_tickets_non_negative", "total_support_tickets >= 0"),
    ("is_senior_citizen_domain", "is_senior_citizen IN (0, 1)"),
    ("balance_non_negative", "acctbal >= 0"),
]
_FAILS = [f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in _RULES]
ORACLES["validate_rows"] = with_base(
    "SELECT customer_id, n_violations = 0 AS is_valid, n_violations, violations FROM ("
    "SELECT customer_id, CAST(" + " + ".join(f"(CASE WHEN NOT coalesce({c}, false) THEN 1 ELSE 0 END)"
                                          for _, c in _RULES)
    + " AS INTEGER) AS n_violations, concat_ws(',', " + ", ".join(_FAILS) + ") AS violations FROM cf) v")

ORACLES["risk_tier"] = with_base(
    "SELECT customer_id, churn_prob, churn_prob >= 0.5::DOUBLE AS churn_prediction, risk_tier FROM sc",
    scored=True)

_P4 = npr("churn_prob", 4)
ORACLES["risk_score"] = with_base(
    f"SELECT customer_id, {npr(f'{_P4} * 100.0::DOUBLE', 1)} AS risk_score, "
    f"['Champions', 'Loyal Customers', 'At Risk', 'Hibernating', 'Lost']"
    f"[least(CAST(trunc({_P4} * 5.0::DOUBLE) AS INTEGER), 4) + 1] AS prob_segment FROM sc", scored=True)

_FACTORS = [
    ("contract_type", 0.42, "contract_type = 'Month-to-month'"),
    ("tenure_months", 0.31, "tenure_months < 12"),
    ("internet_service", 0.24, "internet_service = 'Fiber optic'"),
    ("num_support_tickets", 0.19, "num_support_tickets >= 3"),
    ("online_security", 0.15, "online_security = 'No'"),
    ("tech_support", 0.12, "tech_support = 'No'"),
    ("monthly_charges", 0.10, "monthly_charges > 80"),
]
_FLIST = ("list_slice(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, _, c in _FACTORS)
          + "], lambda x: x IS NOT NULL), 1, 5)")
_IMPACT = ("list_slice(list_filter([" + ", ".join(f"CASE WHEN {c} THEN {w!r}::DOUBLE END" for _, w, c in _FACTORS)
           + "], lambda x: x IS NOT NULL), 1, 5)")
_TITLE = ("CASE x " + " ".join(f"WHEN '{n}' THEN '{n.replace('_', ' ').title()}'" for n, _, _ in _FACTORS)
          + " END")
ORACLES["top_factors"] = with_base(
    "SELECT customer_id, CAST(len(f) AS INTEGER) AS n_factors, array_to_string(f, ',') AS factor_names, "
    f"array_to_string(list_transform(list_slice(f, 1, 3), lambda x: {_TITLE}), '|') AS factor_titles, "
    "imp[1] AS top_impact "
    f"FROM (SELECT customer_id, {_FLIST} AS f, {_IMPACT} AS imp FROM sc) t", scored=True)

ORACLES["recommendation"] = with_base(
    "SELECT customer_id, risk_tier, CASE "
    "WHEN risk_tier = 'HIGH' AND coalesce(contract_type = 'Month-to-month', false) THEN "
    "'Offer a 20% discount to upgrade to a 1-year contract. Assign a dedicated customer success manager immediately.' "
    "WHEN risk_tier = 'HIGH' THEN 'Schedule a proactive retention call. Offer a loyalty reward or service upgrade.' "
    "WHEN risk_tier = 'MEDIUM' AND (coalesce(online_security = 'No', false) OR coalesce(tech_support = 'No', false)) "
    "THEN 'Bundle online security + tech support at a reduced rate. Send a personalised value email.' "
    "WHEN risk_tier = 'MEDIUM' THEN 'Send a satisfaction survey and offer a loyalty discount.' "
    "ELSE 'Customer is healthy. Continue standard engagement.' END AS recommendation FROM sc", scored=True)

_DRIVERS = ("list_slice(list_filter(["
            "CASE WHEN contract_type = 'Month-to-month' THEN 'Month-to-month contract with no lock-in' END, "
            "CASE WHEN tenure_months < 12 THEN 'Low tenure (' || CAST(CAST(tenure_months AS INTEGER) AS VARCHAR) "
            "|| ' months)' END, "
            "CASE WHEN num_support_tickets >= 3 THEN 'High support ticket volume (' "
            "|| CAST(CAST(num_support_tickets AS INTEGER) AS VARCHAR) || ' tickets)' END, "
            "CASE WHEN internet_service = 'Fiber optic' THEN 'Fiber optic customers churn at higher rates' END, "
            "CASE WHEN online_security = 'No' THEN 'No online security subscription' END"
            "], lambda x: x IS NOT NULL), 1, 4)")
ORACLES["risk_drivers"] = with_base(
    "SELECT customer_id, CAST(len(r) AS INTEGER) AS n_drivers, array_to_string(r, ' | ') AS risk_drivers "
    f"FROM (SELECT customer_id, {_DRIVERS} AS r FROM sc) t", scored=True)

ORACLES["customer_filter"] = with_base(
    "SELECT customer_id, contract_type, tenure_months, risk_tier, churn_prob FROM sc "
    "WHERE contract_type IN ('Month-to-month', 'One year') AND tenure_months BETWEEN 6 AND 48 "
    "AND risk_tier IN ('HIGH', 'MEDIUM')", scored=True)

_MART = ["customer_id", "segment", "contract_type", "payment_method", "internet_service",
         "online_security", "tech_support", "label", "tenure_months", "monthly_charges",
         "total_charges", "total_orders", "total_orders_6mo", "total_revenue_6mo",
         "active_months_6mo", "total_support_tickets", "negative_support_tickets",
         "lifetime_value", "negative_ticket_ratio", "charge_to_ltv_ratio", "churn_prob", "risk_tier"]
ORACLES["churn_mart"] = with_base(f"SELECT {', '.join(_MART)} FROM sc", scored=True)

ORACLES["inactive_customers"] = (
    "SELECT c_custkey, c_name, c_mktsegment FROM customer c WHERE NOT EXISTS ("
    "SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey "
    "AND o.o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 6 MONTH)")

_RFM_CTES = """
rfm0 AS (
  SELECT o_custkey AS customer_id,
         CAST(date_diff('day', CAST(max(o_orderdate) AS DATE),
                        CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS INTEGER) AS recency_days,
         CAST(count(*) AS BIGINT) AS frequency,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary
  FROM orders GROUP BY o_custkey),
rfm1 AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM rfm0),
rfm AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
         CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
              WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
              WHEN r_score + f_score + m_score >= 8 THEN 'At Risk'
              WHEN r_score + f_score + m_score >= 6 THEN 'Hibernating' ELSE 'Lost' END AS rfm_segment
  FROM rfm1),
"""
ORACLES["rfm_scores"] = f"WITH {_RFM_CTES.strip().rstrip(',')}\nSELECT * FROM rfm"

ORACLES["upsell_candidates"] = with_base(
    "SELECT r.customer_id, r.rfm_segment, s.risk_tier, r.monetary FROM rfm r "
    "JOIN sc s ON r.customer_id = s.customer_id "
    "WHERE r.rfm_segment IN ('Champions', 'Loyal Customers') AND s.risk_tier <> 'HIGH'", scored=True, ctes=_RFM_CTES)

ORACLES["scd2_history"] = (
    "WITH c AS (SELECT o_custkey AS customer_id, o_orderdate, o_orderpriority, o_orderkey, "
    "lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev, "
    "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders), "
    "s AS (SELECT * FROM c WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority) "
    "SELECT customer_id, o_orderpriority, o_orderdate AS valid_from, "
    "lead(o_orderdate) OVER (PARTITION BY customer_id ORDER BY o_orderdate, o_orderkey) AS valid_to, "
    "CAST(row_number() OVER (PARTITION BY customer_id ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS version, "
    "lead(o_orderdate) OVER (PARTITION BY customer_id ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current "
    "FROM s")

ORACLES["scd2_incremental"] = ORACLES["scd2_history"]

ORACLES["value_distribution"] = (
    "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS mean_price, "
    f"{npr('stddev_pop(o_totalprice)', 2)} AS std_pop_price FROM orders GROUP BY o_orderstatus")

ORACLES["monthly_revenue"] = monthly_sql("SELECT ds, y, n_orders FROM monthly")

ORACLES["daily_activity"] = (
    "SELECT *, n_views + 2 * n_clicks + 5 * n_purchases - 3 * n_errors AS engagement_score FROM ("
    "SELECT user_id, CAST(ts AS DATE) AS activity_date, CAST(count(*) AS BIGINT) AS n_events, "
    "CAST(count_if(event_type = 'view') AS BIGINT) AS n_views, "
    "CAST(count_if(event_type = 'click') AS BIGINT) AS n_clicks, "
    "CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchases, "
    "CAST(count_if(event_type = 'error') AS BIGINT) AS n_errors, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value "
    "FROM events GROUP BY user_id, CAST(ts AS DATE)) a")

ORACLES["staged_orders"] = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, "
    "CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, o_totalprice AS amount, "
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fulfilled, "
    "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open, "
    "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_pending, "
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_priority FROM orders")

ORACLES["validate_service_requests"] = """
WITH r AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
q AS (
  SELECT event_id, coalesce(['executive', 'churn', 'revenue', 'risk', 'weekly', NULL][k % 6 + 1], 'executive') AS report_type,
         ['last_7_days', 'last_30_days', 'last_90_days', 'last_year'][k % 4 + 1] AS date_range, k - 2 AS periods,
         coalesce(['monthly', 'daily', NULL][k % 3 + 1], 'monthly') AS granularity FROM r)
SELECT *, array_to_string(list_filter([
    CASE WHEN report_type = 'weekly' THEN 'report_type_domain' END, CASE WHEN date_range = 'last_year' THEN 'date_range_domain' END,
    CASE WHEN periods NOT BETWEEN 1 AND 24 THEN 'periods_range' END, CASE WHEN granularity <> 'monthly' THEN 'granularity_domain' END],
    lambda x: x IS NOT NULL), ',') AS violations FROM q"""

ORACLES["cutoff_features"] = """
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS last FROM orders),
c AS (SELECT CAST(last - (12 + 6 * k) * INTERVAL 1 MONTH AS DATE) AS cutoff FROM m, range(6) r(k)),
o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)
SELECT o_custkey, cutoff, CAST(count_if(day < cutoff) AS BIGINT) AS n_before,
       CAST(sum(CASE WHEN day < cutoff THEN amount END) AS DOUBLE) AS spend_before,
       CAST(count_if(day < cutoff AND day >= cutoff - INTERVAL 12 MONTH) AS BIGINT) AS n_trailing,
       CAST(coalesce(sum(CASE WHEN day < cutoff AND day >= cutoff - INTERVAL 12 MONTH THEN amount END), 0) AS DOUBLE) AS spend_trailing,
       CAST(date_diff('day', max(CASE WHEN day < cutoff THEN day END), cutoff) AS INTEGER) AS recency_days,
       CASE WHEN count_if(day >= cutoff AND day < cutoff + INTERVAL 12 MONTH) > 0 THEN 0 ELSE 1 END AS label
FROM o, c GROUP BY o_custkey, cutoff HAVING count_if(day < cutoff) > 0"""

ORACLES["staged_customers"] = (
    "SELECT c_custkey AS customer_id, trim(c_name) AS customer_name, lower(c_mktsegment) AS segment, c_nationkey AS nation_key, "
    "lower(n_name) AS nation, CAST(c_acctbal AS DOUBLE) AS balance, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_indebted, "
    "CASE WHEN c_custkey IS NOT NULL AND c_acctbal IS NOT NULL THEN 1 ELSE 0 END AS is_complete "
    "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")

ORACLES["staged_tickets"] = (
    "SELECT event_id AS ticket_id, user_id AS customer_id, CAST(ts AS DATE) AS created_date, "
    "CAST(date_trunc('month', ts) AS DATE) AS created_month, sentiment, "
    "CASE sentiment WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END AS sentiment_code, "
    "CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END AS is_negative, "
    "CASE WHEN k % 5 <> 0 THEN 1 ELSE 0 END AS is_resolved, "
    "CASE WHEN sentiment = 'negative' AND NOT (k % 5 <> 0) THEN 1 ELSE 0 END AS needs_action "
    "FROM (SELECT *, CASE event_type WHEN 'error' THEN 'negative' WHEN 'purchase' THEN 'positive' ELSE 'neutral' END AS sentiment, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e")

ORACLES["period_summary"] = (
    "WITH r AS (SELECT * FROM (VALUES ('last_7_days', 7, 1), ('last_30_days', 30, 2), "
    "('last_90_days', 90, 3)) t(date_range, days, k)), "
    "m AS (SELECT max(o_orderdate) AS as_of FROM orders), "
    "a AS (SELECT r.date_range, CAST(count(o.o_orderkey) AS BIGINT) AS n_orders, "
    "CAST(count(DISTINCT o.o_custkey) AS BIGINT) AS n_customers, "
    "coalesce(CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0.0::DOUBLE) AS revenue "
    "FROM r CROSS JOIN m LEFT JOIN orders o ON o.o_orderdate >= m.as_of - r.days * INTERVAL 1 DAY "
    "GROUP BY r.date_range) "
    "SELECT *, printf('Activity report (%s): %d orders from %d customers, revenue ', replace(date_range, '_', ' '), "
    "n_orders, n_customers) || format('{:,}', CAST(" + npr("revenue / 1000.0::DOUBLE", 0) + " AS BIGINT)) "
    "|| ' thousand.' AS summary FROM a")

ORACLES["revenue_lags"] = monthly_sql(
    "SELECT ds, y, " + ", ".join(f"lag(y, {k}) OVER (ORDER BY ds) AS lag_{k}" for k in (1, 2, 3, 6, 12))
    + " FROM monthly")


def _rolling(w: int) -> str:
    fr = f"OVER (ORDER BY ds ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    full = f"count(y) {fr} = {w}"
    return (f"CASE WHEN {full} THEN {npr(f'avg(y) {fr}', 2)} END AS rolling_mean_{w}, "
            f"CASE WHEN {full} THEN {npr(f'stddev_samp(y) {fr}', 2)} END AS rolling_std_{w}, "
            f"CASE WHEN {full} THEN max(y) {fr} END AS rolling_max_{w}")


ORACLES["revenue_rolling"] = monthly_sql(
    f"SELECT ds, y, {_rolling(3)}, {_rolling(6)} FROM monthly")

ORACLES["revenue_features"] = monthly_sql(
    "SELECT * FROM (SELECT ds, y, CAST(month(ds) AS INTEGER) AS month, CAST(quarter(ds) AS INTEGER) AS quarter, "
    "CAST(year(ds) AS INTEGER) AS year, "
    f"{npr('sin(6.283185307179586::DOUBLE * month(ds) / 12.0::DOUBLE)', 9)} AS month_sin, "
    f"{npr('cos(6.283185307179586::DOUBLE * month(ds) / 12.0::DOUBLE)', 9)} AS month_cos, "
    + ", ".join(f"lag(y, {k}) OVER (ORDER BY ds) AS lag_{k}" for k in (1, 2, 3, 6, 12))
    + f", {_rolling(3)}, {_rolling(6)} FROM monthly) f "
    "WHERE lag_12 IS NOT NULL AND rolling_mean_6 IS NOT NULL AND rolling_std_6 IS NOT NULL")

ORACLES["mom_growth"] = monthly_sql(
    "SELECT ds, y, lag(y) OVER (ORDER BY ds) AS prev_y, "
    "(y - lag(y) OVER (ORDER BY ds)) * 100.0::DOUBLE / nullif(lag(y) OVER (ORDER BY ds), 0) AS mom_growth_pct "
    "FROM monthly")

ORACLES["cumulative_revenue"] = monthly_sql(
    "SELECT ds, y, CAST(sum(CAST(y AS DECIMAL(18,2))) OVER (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS DOUBLE) AS cumulative_y FROM monthly")

ORACLES["last_12_months"] = monthly_sql(
    "SELECT ds, y, n_orders FROM monthly ORDER BY ds DESC LIMIT 12")

ORACLES["revenue_trend"] = monthly_sql(
    "SELECT *, total_y / n_months AS mean_y, "
    "(last_y - first_y) * 100.0::DOUBLE / nullif(first_y, 0) AS growth_pct, "
    "CASE WHEN last_y > first_y * 1.05::DOUBLE THEN 'growing' WHEN last_y < first_y * 0.95::DOUBLE "
    "THEN 'declining' ELSE 'stable' END AS trend FROM ("
    "SELECT arg_min(y, ds) AS first_y, arg_max(y, ds) AS last_y, "
    "CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS total_y, CAST(count(*) AS BIGINT) AS n_months "
    "FROM monthly) s")

ORACLES["time_split"] = monthly_sql(
    "SELECT ds, y, CAST(t AS INTEGER) AS t, CASE WHEN t <= floor(n * 0.8::DOUBLE) THEN 'train' "
    "ELSE 'test' END AS split FROM (SELECT ds, y, row_number() OVER (ORDER BY ds) AS t, "
    "count(*) OVER () AS n FROM monthly) p")

# Trend + month-effect fit from exact moment sums (same expression order as Spark).
_FIT_CTES = """
pos AS (SELECT ds, y, CAST(row_number() OVER (ORDER BY ds) AS INTEGER) AS t,
               count(*) OVER () AS n_months FROM monthly),
trainset AS (SELECT * FROM pos WHERE {train}),
mom AS (SELECT CAST(count(*) AS DOUBLE) AS k, CAST(sum(t) AS DOUBLE) AS st,
               CAST(sum(CAST(t AS BIGINT) * t) AS DOUBLE) AS stt,
               CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS sy,
               CAST(sum(CAST(y AS DECIMAL(18,2)) * t) AS DOUBLE) AS sty,
               max(t) AS t_last, max(ds) AS ds_last FROM trainset),
coef0 AS (SELECT *, coalesce((k * sty - st * sy) / nullif(k * stt - st * st, 0), 0.0::DOUBLE) AS b FROM mom),
coef AS (SELECT *, (sy - b * st) / k AS a FROM coef0),
eff AS (SELECT CAST(month(p.ds) AS INTEGER) AS month, avg(p.y - (c.a + c.b * p.t)) AS effect
        FROM trainset p CROSS JOIN coef c GROUP BY 1),
"""


def _fit(train: str = "true") -> str:
    return _FIT_CTES.replace("{train}", train)


ORACLES["forecast_trend_season"] = monthly_sql(
    f"SELECT h, ds, forecast, {npr('forecast * 0.92::DOUBLE', 2)} AS lower_bound, "
    f"{npr('forecast * 1.08::DOUBLE', 2)} AS upper_bound FROM ("
    f"SELECT s.h, s.ds, {npr('c.a + c.b * (c.t_last + s.h) + coalesce(e.effect, 0.0::DOUBLE)', 2)} AS forecast "
    "FROM (SELECT CAST(h AS INTEGER) AS h, CAST(ds_last + h * INTERVAL 1 MONTH AS DATE) AS ds "
    "FROM coef, range(1, 13) r(h)) s CROSS JOIN coef c "
    "LEFT JOIN eff e ON e.month = month(s.ds)) f", ctes=_fit())

ORACLES["forecast_errors"] = monthly_sql(
    f"SELECT CAST(count(*) AS BIGINT) AS n_test, {npr('avg(abs((predicted - y) / nullif(y, 0)))', 6)} AS mape, "
    f"{npr('sqrt(avg((predicted - y) * (predicted - y)))', 2)} AS rmse, "
    f"{npr('avg(abs(predicted - y))', 2)} AS mae FROM ("
    f"SELECT p.y, {npr('c.a + c.b * p.t + e.effect', 2)} AS predicted FROM pos p CROSS JOIN coef c "
    "JOIN eff e ON e.month = month(p.ds) WHERE p.t > floor(p.n_months * 0.8::DOUBLE)) q",
    ctes=_fit("t <= floor(n_months * 0.8::DOUBLE)"))

ORACLES["history_plus_forecast"] = monthly_sql(
    "SELECT * FROM (SELECT ds, 'history' AS type, y AS value, y AS lower_bound, y AS upper_bound "
    "FROM monthly ORDER BY ds DESC LIMIT 12) h UNION ALL "
    f"SELECT ds, 'forecast' AS type, forecast AS value, {npr('forecast * 0.92::DOUBLE', 2)} AS lower_bound, "
    f"{npr('forecast * 1.08::DOUBLE', 2)} AS upper_bound FROM ("
    f"SELECT s.ds, {npr('c.a + c.b * (c.t_last + s.h) + coalesce(e.effect, 0.0::DOUBLE)', 2)} AS forecast "
    "FROM (SELECT CAST(h AS INTEGER) AS h, CAST(ds_last + h * INTERVAL 1 MONTH AS DATE) AS ds "
    "FROM coef, range(1, 13) r(h)) s CROSS JOIN coef c "
    "LEFT JOIN eff e ON e.month = month(s.ds)) f", ctes=_fit())

ORACLES["high_risk_top20"] = with_base(
    "SELECT customer_id, segment, contract_type, tenure_months, monthly_charges, churn_prob, risk_tier "
    "FROM sc WHERE risk_tier = 'HIGH' ORDER BY churn_prob DESC, customer_id LIMIT 20", scored=True)

ORACLES["top_outliers"] = (
    f"SELECT o_orderkey, o_orderpriority, o_totalprice, {npr('z', 6)} AS z FROM ("
    "SELECT o.o_orderkey, o.o_orderpriority, o.o_totalprice, (o.o_totalprice - g.m) / nullif(g.s, 0) AS z "
    "FROM orders o JOIN (SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) "
    "/ count(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders GROUP BY 1) g "
    "ON o.o_orderpriority = g.o_orderpriority) z ORDER BY abs(z) DESC, o_orderkey LIMIT 10")

ORACLES["sample_customers"] = (
    "SELECT c_custkey, c_name, c_mktsegment FROM customer "
    "ORDER BY (c_custkey * 2654435761 + 42) % 4294967296, c_custkey LIMIT 800")

ORACLES["stratified_split"] = with_base(
    "SELECT customer_id, label, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split "
    "FROM (SELECT customer_id, label, row_number() OVER (PARTITION BY label ORDER BY "
    "(customer_id * 2654435761 + 42) % 4294967296, customer_id) AS rn, "
    "count(*) OVER (PARTITION BY label) AS n FROM cf) r")

ORACLES["row_count_checks"] = (
    "SELECT table_name, n_rows, min_rows, n_rows >= min_rows AS ok FROM ("
    "SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(7000 AS BIGINT) AS min_rows FROM customer "
    "UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), CAST(10000 AS BIGINT) FROM orders "
    "UNION ALL SELECT 'events', CAST(count(*) AS BIGINT), CAST(2000 AS BIGINT) FROM events) t")


def _checks(table: str, min_rows: int, checks: list) -> str:
    parts = [f"SELECT 'row_count' AS \"check\", count(*) >= {min_rows} AS ok, "
             f"CAST(CASE WHEN count(*) >= {min_rows} THEN 0 ELSE count(*) END AS BIGINT) AS failing_rows, "
             f"'{table}' AS table_name FROM {table}"]
    for name, cond in checks:
        parts.append(f"SELECT '{name}', count_if(NOT coalesce({cond}, false)) = 0, "
                     f"CAST(count_if(NOT coalesce({cond}, false)) AS BIGINT), '{table}' FROM {table}")
    return " UNION ALL ".join(parts)


ORACLES["quality_checks"] = (
    _checks("customer", 1000, [
        ("no_null_ids", "c_custkey IS NOT NULL"),
        ("valid_segment", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
        ("non_negative_balance", "TRY_CAST(c_acctbal AS DOUBLE) >= 0")])
    + " UNION ALL " +
    _checks("orders", 10000, [
        ("no_null_ids", "o_orderkey IS NOT NULL"),
        ("valid_status", "o_orderstatus IN ('F', 'O', 'P')"),
        ("non_negative_price", "TRY_CAST(o_totalprice AS DOUBLE) >= 0")]))

_DRIFT_CTES = """
src AS (SELECT o_totalprice, CAST(day(o_orderdate) AS INTEGER) AS order_day,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank, o_orderdate FROM orders),
base AS (SELECT * FROM src WHERE o_orderdate < TIMESTAMP '1999-01-01'),
cur AS (SELECT * FROM src WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
"""
_PSI_FEATURES = ["o_totalprice", "order_day", "priority_rank"]
_LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, '{{side}}' AS side FROM {{tbl}} WHERE {f} IS NOT NULL"
    for f in _PSI_FEATURES)
ORACLES["psi_by_feature"] = (
    "WITH " + _DRIFT_CTES.strip() + "\n"
    "lng AS (" + _LONG.replace("{side}", "base").replace("{tbl}", "base") + " UNION ALL "
    + _LONG.replace("{side}", "cur").replace("{tbl}", "cur") + "),\n"
    "edges AS (SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e "
    "FROM lng WHERE side = 'base' GROUP BY feature),\n"
    "binned AS (SELECT l.feature, l.side, len(list_filter(d.e, lambda v: v <= l.x)) AS bin "
    "FROM lng l JOIN edges d ON l.feature = d.feature),\n"
    "grid AS (SELECT feature, unnest(range(0, 10)) AS bin FROM edges),\n"
    "cnt AS (SELECT feature, bin, count_if(side = 'base') AS nb, count_if(side = 'cur') AS nc "
    "FROM binned GROUP BY feature, bin),\n"
    "full_ AS (SELECT g.feature, g.bin, coalesce(c.nb, 0) AS nb, coalesce(c.nc, 0) AS nc "
    "FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin),\n"
    "sh AS (SELECT feature, bin, nb / sum(nb) OVER (PARTITION BY feature) AS e, "
    "nc / sum(nc) OVER (PARTITION BY feature) AS a FROM full_),\n"
    "fl AS (SELECT feature, CASE WHEN e = 0 THEN 0.0001::DOUBLE ELSE e END AS e, "
    "CASE WHEN a = 0 THEN 0.0001::DOUBLE ELSE a END AS a FROM sh),\n"
    "p AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM fl GROUP BY feature)\n"
    f"SELECT feature, {npr('psi', 6)} AS psi, CASE WHEN psi > 0.2::DOUBLE THEN 'DRIFT' "
    "WHEN psi > 0.1::DOUBLE THEN 'WARNING' ELSE 'STABLE' END AS status FROM p")

ORACLES["drift_by_profile"] = (
    "WITH " + _DRIFT_CTES.strip() + "\n"
    "lng AS (" + _LONG.replace("{side}", "base").replace("{tbl}", "base") + " UNION ALL "
    + _LONG.replace("{side}", "cur").replace("{tbl}", "cur") + "),\n"
    "o AS (SELECT feature, side, x, row_number() OVER (PARTITION BY feature, side ORDER BY x) AS r, "
    "count(*) OVER (PARTITION BY feature, side) AS n FROM lng),\n"
    "pts AS (SELECT feature, side, i, min(x) AS v FROM o, range(1, 201) p(i) WHERE r >= ceil(round(i * n / 200.0::DOUBLE, 7)) "
    "GROUP BY feature, side, i),\n"
    "cum AS (SELECT feature, x, sum(nb) OVER w / sum(nb) OVER t AS fb, sum(nc) OVER w / sum(nc) OVER t AS fc FROM "
    "(SELECT feature, x, count_if(side = 'base') AS nb, count_if(side = 'cur') AS nc FROM lng GROUP BY feature, x) "
    "WINDOW w AS (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY feature)),\n"
    "ks AS (SELECT a.feature, max(abs(fb - fc)) AS ks FROM (SELECT DISTINCT feature, v FROM pts) a JOIN cum c ON c.feature = a.feature AND c.x = a.v "
    "GROUP BY a.feature),\n"
    "e AS (SELECT a.feature, i / 20 AS b, fb, fc FROM pts a JOIN cum c ON c.feature = a.feature AND c.x = a.v "
    "WHERE a.side = 'base' AND i % 20 = 0 AND i < 200 "
    "UNION ALL SELECT DISTINCT feature, 0, 0.0::DOUBLE, 0.0::DOUBLE FROM lng UNION ALL SELECT DISTINCT feature, 10, 1.0::DOUBLE, 1.0::DOUBLE FROM lng),\n"
    "sh AS (SELECT feature, lead(fb) OVER w - fb AS e, lead(fc) OVER w - fc AS a FROM e WINDOW w AS (PARTITION BY feature ORDER BY b)),\n"
    "fl AS (SELECT feature, CASE WHEN e <= 0 THEN 0.0001::DOUBLE ELSE e END AS e, CASE WHEN a <= 0 THEN 0.0001::DOUBLE ELSE a END AS a "
    "FROM sh WHERE e IS NOT NULL),\n"
    "p AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM fl GROUP BY feature)\n"
    f"SELECT feature, {npr('psi', 6)} AS psi, {npr('ks', 6)} AS ks, 0.0::DOUBLE AS missing_base, 0.0::DOUBLE AS missing_cur, "
    "CASE WHEN psi > 0.2::DOUBLE THEN 'DRIFT' WHEN psi > 0.1::DOUBLE THEN 'WARNING' ELSE 'STABLE' END AS status FROM p JOIN ks USING (feature)")

ORACLES["mean_drift"] = (
    "WITH " + _DRIFT_CTES.strip().rstrip(",") + "\n"
    "SELECT *, abs(current_mean - baseline_mean) * 100.0::DOUBLE / nullif(baseline_mean, 0) AS drift_pct, "
    "abs(current_mean - baseline_mean) * 100.0::DOUBLE / nullif(baseline_mean, 0) > 15.0::DOUBLE AS alarm FROM "
    "(SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS baseline_mean, "
    "CAST(count(*) AS BIGINT) AS n_baseline FROM base) b CROSS JOIN "
    "(SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS current_mean, "
    "CAST(count(*) AS BIGINT) AS n_current FROM cur) c")

ORACLES["ks_statistic"] = (
    "WITH " + _DRIFT_CTES.strip() + "\n"
    "u AS (SELECT CAST(o_totalprice AS DOUBLE) AS v, 1 AS b, 0 AS c FROM base WHERE o_totalprice IS NOT NULL "
    "UNION ALL SELECT CAST(o_totalprice AS DOUBLE), 0, 1 FROM cur WHERE o_totalprice IS NOT NULL),\n"
    "g AS (SELECT v, sum(b) AS nb, sum(c) AS nc FROM u GROUP BY v),\n"
    "cm AS (SELECT sum(nb) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb, "
    "sum(nc) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cc, sum(nb) OVER () AS tb, sum(nc) OVER () AS tc FROM g)\n"
    f"SELECT {npr('max(abs(cb / tb - cc / tc))', 9)} AS ks_statistic, CAST(max(tb) AS BIGINT) AS n_baseline, "
    "CAST(max(tc) AS BIGINT) AS n_current FROM cm")

_DOC_CTES = """
ds0 AS (SELECT d.doc_id, l.quality, d.n_chars / (d.n_chars + 2000.0::DOUBLE) AS score_a,
              (strlen(d.text) - strlen(replace(d.text, ' ', ''))) AS spaces
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
dsc AS (SELECT doc_id, quality, score_a, spaces / (spaces + 300.0::DOUBLE) AS score_b,
              0.6::DOUBLE * score_a + 0.4::DOUBLE * (spaces / (spaces + 300.0::DOUBLE)) AS vote_prob FROM ds0),
"""


def doc_sql(body: str, ctes: str = "") -> str:
    return "WITH " + (_DOC_CTES + ctes).strip().rstrip(",") + "\n" + body


ORACLES["soft_vote"] = doc_sql(
    "SELECT doc_id, score_a, score_b, vote_prob, CASE WHEN vote_prob >= 0.5::DOUBLE THEN 1 ELSE 0 END AS vote_label "
    "FROM dsc")

ORACLES["classifier_metrics"] = doc_sql(
    "SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, "
    f"{npr('u / (n_pos * n_neg)', 12)} AS roc_auc, {npr('ap', 9)} AS average_precision, "
    "coalesce(tp / nullif(tp + fp, 0), 0.0::DOUBLE) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0::DOUBLE) AS recall, "
    "coalesce(2 * coalesce(tp / nullif(tp + fp, 0), 0.0::DOUBLE) * coalesce(tp / nullif(tp + fn, 0), 0.0::DOUBLE) "
    "/ nullif(coalesce(tp / nullif(tp + fp, 0), 0.0::DOUBLE) + coalesce(tp / nullif(tp + fn, 0), 0.0::DOUBLE), 0), 0.0::DOUBLE) AS f1, "
    "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM ("
    "SELECT sum(pos * ((cum_neg - neg) + neg / 2.0::DOUBLE)) AS u, max(tpos) AS n_pos, max(tneg) AS n_neg, "
    "sum(pos * (tpos - cum_pos + pos) / (tpos * ((tpos - cum_pos + pos) + (tneg - cum_neg + neg)))) AS ap, "
    "sum(CASE WHEN s >= 0.5::DOUBLE THEN pos ELSE 0 END) AS tp, sum(CASE WHEN s >= 0.5::DOUBLE THEN neg ELSE 0 END) AS fp, "
    "sum(CASE WHEN s < 0.5::DOUBLE THEN pos ELSE 0 END) AS fn FROM ("
    "SELECT s, pos, neg, sum(pos) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_pos, "
    "sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_neg, sum(pos) OVER () AS tpos, "
    "sum(neg) OVER () AS tneg FROM (SELECT vote_prob AS s, count_if(quality = 1) AS pos, "
    "count_if(quality = 0) AS neg FROM dsc GROUP BY vote_prob) g) c) a")

ORACLES["confusion_report"] = doc_sql(
    "SELECT k AS class_label, coalesce(tp / nullif(pp, 0), 0.0::DOUBLE) AS precision, "
    "coalesce(tp / nullif(sup, 0), 0.0::DOUBLE) AS recall, "
    "coalesce(2 * coalesce(tp / nullif(pp, 0), 0.0::DOUBLE) * coalesce(tp / nullif(sup, 0), 0.0::DOUBLE) / "
    "nullif(coalesce(tp / nullif(pp, 0), 0.0::DOUBLE) + coalesce(tp / nullif(sup, 0), 0.0::DOUBLE), 0), 0.0::DOUBLE) AS f1, "
    "CAST(sup AS BIGINT) AS support FROM (SELECT k, "
    "count_if(quality = k AND CAST(vote_prob >= 0.5::DOUBLE AS INTEGER) = k) AS tp, "
    "count_if(CAST(vote_prob >= 0.5::DOUBLE AS INTEGER) = k) AS pp, count_if(quality = k) AS sup "
    "FROM dsc CROSS JOIN (VALUES (0), (1)) v(k) GROUP BY k) t")

ORACLES["gain_curve"] = doc_sql(
    "SELECT decile, n, positives, CAST(sum(positives) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS cum_positives, sum(positives) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) / sum(positives) OVER () "
    "AS capture_rate FROM (SELECT CAST(decile AS INTEGER) AS decile, CAST(count(*) AS BIGINT) AS n, "
    "CAST(sum(quality) AS BIGINT) AS positives FROM (SELECT quality, ntile(10) OVER (ORDER BY vote_prob DESC, doc_id) "
    "AS decile FROM dsc) r GROUP BY decile) g")

ORACLES["class_weights"] = doc_sql(
    "SELECT class_label, n_class, sum(n_class) OVER () / (count(*) OVER () * n_class) AS weight FROM ("
    "SELECT CAST(quality AS INTEGER) AS class_label, CAST(count(*) AS BIGINT) AS n_class FROM dsc GROUP BY 1) g")

_Z = ["tenure_months", "total_orders", "total_support_tickets"]
ORACLES["zscore_features"] = with_base(
    "SELECT customer_id, " + ", ".join(
        npr(f"({c} - m_{c}) / (CASE WHEN coalesce(s_{c}, 0) = 0 THEN 1.0::DOUBLE ELSE s_{c} END)", 6) + f" AS {c}_z"
        for c in _Z)
    + " FROM cf CROSS JOIN (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in _Z)
    + " FROM cf) st")

ORACLES["run_history"] = monthly_sql(
    "SELECT *, value - prev_value AS change FROM (SELECT experiment, run_id, metric, value, "
    "lag(value) OVER (PARTITION BY experiment, metric ORDER BY run_id) AS prev_value FROM ("
    "SELECT 'monthly_revenue' AS experiment, strftime(ds, '%Y-%m') AS run_id, 'y' AS metric, y AS value FROM monthly "
    "UNION ALL SELECT 'monthly_revenue', strftime(ds, '%Y-%m'), 'n_orders', CAST(n_orders AS DOUBLE) FROM monthly) l) w")

ORACLES["stream_daily_activity"] = (
    "SELECT user_id, CAST(ts AS DATE) AS activity_date, CAST(count(*) AS BIGINT) AS n_events, "
    "CAST(count_if(event_type = 'view') AS BIGINT) AS n_views, "
    "CAST(count_if(event_type = 'click') AS BIGINT) AS n_clicks, "
    "CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchases, "
    "CAST(count_if(event_type = 'error') AS BIGINT) AS n_errors, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value "
    "FROM events GROUP BY user_id, CAST(ts AS DATE)")

ORACLES["stream_bronze_ingest"] = (
    "SELECT event_id, user_id, event_type, value, ts, 'events' AS _source, 'batch_0001' AS _batch_id "
    "FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM events) e WHERE rn = 1")

ORACLES["stream_quiet_users"] = """
WITH e AS (SELECT DISTINCT user_id, epoch_us(ts) // 1000 AS t FROM events),
n AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS after FROM e),
w AS (SELECT max(t) - 86400000 AS last FROM e)
SELECT user_id, t + 172800000 AS quiet_since_ms FROM n, w
WHERE (after IS NULL OR after > t + 172800000) AND t + 172800000 <= last"""

ORACLES["stream_order_tickets"] = """
WITH m AS (SELECT (SELECT CAST(max(ts) AS DATE) FROM events) AS newest, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS last),
o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate + date_diff('day', last, newest) * INTERVAL 1 DAY AS ordered_at, newest
      FROM orders, m),
t AS (SELECT event_id AS ticket_id, user_id, ts FROM events WHERE event_type = 'error')
SELECT order_id, customer_id, CAST(ordered_at AS DATE) AS ordered_on, ticket_id, epoch_us(ts) AS opened_us
FROM o LEFT JOIN t ON t.user_id = o.customer_id AND t.ts >= o.ordered_at AND t.ts <= o.ordered_at + INTERVAL 7 DAY
WHERE ordered_at < newest - INTERVAL 9 DAY"""

ORACLES["stream_risk_scoring"] = with_base(
    "SELECT customer_id, churn_prob, churn_prob >= 0.5::DOUBLE AS churn_prediction, risk_tier, "
    f"array_to_string({_FLIST}, ',') AS factor_names, CASE "
    "WHEN risk_tier = 'HIGH' AND coalesce(contract_type = 'Month-to-month', false) THEN "
    "'Offer a 20% discount to upgrade to a 1-year contract. Assign a dedicated customer success manager immediately.' "
    "WHEN risk_tier = 'HIGH' THEN 'Schedule a proactive retention call. Offer a loyalty reward or service upgrade.' "
    "WHEN risk_tier = 'MEDIUM' AND (coalesce(online_security = 'No', false) OR coalesce(tech_support = 'No', false)) "
    "THEN 'Bundle online security + tech support at a reduced rate. Send a personalised value email.' "
    "WHEN risk_tier = 'MEDIUM' THEN 'Send a satisfaction survey and offer a loyalty discount.' "
    "ELSE 'Customer is healthy. Continue standard engagement.' END AS recommendation FROM sc", scored=True)

ORACLES["monitoring_report"] = (
    "SELECT q.quality_ok, p.max_psi, s.prediction_drift, k.ks_statistic, p.max_psi > 0.2::DOUBLE AS feature_drift, "
    "(p.max_psi > 0.2::DOUBLE) OR s.prediction_drift OR NOT q.quality_ok AS retrain_required FROM "
    f"(SELECT bool_and(ok) AS quality_ok FROM ({ORACLES['quality_checks']}) x) q CROSS JOIN "
    f"(SELECT max(psi) AS max_psi FROM ({ORACLES['psi_by_feature']}) y) p CROSS JOIN "
    f"(SELECT alarm AS prediction_drift FROM ({ORACLES['mean_drift']}) z) s CROSS JOIN "
    f"(SELECT ks_statistic FROM ({ORACLES['ks_statistic']}) u) k")

_PER = ORACLES["period_summary"]
_RNG = "replace(p.date_range, '_', ' ')"
_REVK = "format('{:,}', CAST(" + npr("revenue / 1000.0::DOUBLE", 0) + " AS BIGINT))"
_CUST = "format('{:,}', total_customers)"
_RATE = "CAST(churn_rate_pct AS VARCHAR) || '%'"
ORACLES["period_summary_cube"] = "SELECT date_range, n_orders, n_customers, revenue FROM (" + _PER + ") p"

ORACLES["summary_report"] = with_base(
    "SELECT report_type, p.date_range, n_orders, n_customers, revenue, total_customers, churn_rate_pct, "
    "high_risk_customers, k.mrr, k.avg_tenure_months, k.avg_monthly_charges, "
    f"(SELECT {npr('mape * 100.0::DOUBLE', 2)} FROM ({ORACLES['forecast_errors']}) fe) AS forecast_mape_pct, CASE report_type "
    f"WHEN 'executive' THEN 'Platform overview (' || {_RNG} || '): ' || {_CUST} || ' customers monitored, churn rate ' "
    f"|| {_RATE} || ', ' || CAST(n_orders AS VARCHAR) || ' orders worth ' || {_REVK} || ' thousand; ' "
    "|| CAST(high_risk_customers AS VARCHAR) || ' customers at high risk need retention action.' "
    f"WHEN 'churn' THEN 'Churn analysis (' || {_RNG} || '): churn rate ' || {_RATE} || ' across ' || {_CUST} "
    "|| ' customers; ' || CAST(high_risk_customers AS VARCHAR) || ' are predicted to churn without action.' "
    f"WHEN 'revenue' THEN 'Revenue report (' || {_RNG} || '): ' || {_REVK} || ' thousand from ' "
    "|| CAST(n_orders AS VARCHAR) || ' orders placed by ' || CAST(n_customers AS VARCHAR) || ' customers.' "
    f"ELSE 'Risk assessment (' || {_RNG} || '): ' || CAST(high_risk_customers AS VARCHAR) || ' of ' || {_CUST} "
    "|| ' customers are HIGH risk; ' || CAST(n_customers AS VARCHAR) || ' customers ordered in the period.' END AS summary "
    f"FROM (SELECT date_range, n_orders, n_customers, revenue FROM ({_PER}) p0) p JOIN "
    "(SELECT r.date_range, "
    f"{npr('coalesce(sum(monthly_charges), 0.0::DOUBLE)', 2)} AS mrr, {npr('avg(CAST(tenure_months AS DOUBLE))', 2)} AS avg_tenure_months, "
    f"{npr('avg(monthly_charges)', 2)} AS avg_monthly_charges "
    "FROM (VALUES ('last_7_days', 7), ('last_30_days', 30), ('last_90_days', 90)) r(date_range, days) CROSS JOIN ref "
    "LEFT JOIN sc ON sc.last_order >= ref.as_of - r.days * INTERVAL 1 DAY GROUP BY r.date_range) k ON k.date_range = p.date_range CROSS JOIN "
    "(SELECT CAST(count(*) AS BIGINT) AS total_customers, "
    f"{npr('CAST(sum(label) AS DOUBLE) / count(*) * 100.0::DOUBLE', 1)} AS churn_rate_pct, "
    "CAST(count_if(risk_tier = 'HIGH') AS BIGINT) AS high_risk_customers FROM sc) s "
    "CROSS JOIN (VALUES ('executive'), ('churn'), ('revenue'), ('risk')) t(report_type)", scored=True)

ORACLES["scd2_as_of"] = (
    "SELECT o.o_orderkey, o.o_custkey AS customer_id, o.o_orderdate - INTERVAL 90 DAY AS at, "
    "h.o_orderpriority AS priority_then, h.version FROM orders o LEFT JOIN "
    f"({ORACLES['scd2_history']}) h ON h.customer_id = o.o_custkey "
    "AND h.valid_from <= o.o_orderdate - INTERVAL 90 DAY "
    "AND (h.valid_to IS NULL OR o.o_orderdate - INTERVAL 90 DAY < h.valid_to)")

ORACLES["segment_revenue_growth"] = (
    "WITH f AS (SELECT c.c_mktsegment AS series, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS ds, "
    "sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS y_dec, CAST(count(*) AS BIGINT) AS n "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2), "
    "span AS (SELECT series, min(ds) AS lo, max(ds) AS hi FROM f GROUP BY series), "
    "cal AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ds FROM span), "
    "m AS (SELECT cal.series, cal.ds, CAST(coalesce(f.y_dec, 0) AS DOUBLE) AS y, "
    "CAST(coalesce(f.n, 0) AS BIGINT) AS n_orders FROM cal LEFT JOIN f ON cal.series = f.series AND cal.ds = f.ds) "
    "SELECT series AS segment, ds, y, n_orders, lag(y) OVER w AS prev_y, "
    "(y - lag(y) OVER w) * 100.0::DOUBLE / nullif(lag(y) OVER w, 0) AS mom_growth_pct, "
    f"CASE WHEN count(y) OVER w3 = 3 THEN {npr('avg(y) OVER w3', 2)} END AS rolling_mean_3 FROM m "
    "WINDOW w AS (PARTITION BY series ORDER BY ds), "
    "w3 AS (PARTITION BY series ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")

_MODEL = ["is_male", "is_senior_citizen", "has_partner", "has_dependents", "tenure_months", "monthly_charges",
          "total_charges", "implied_tenure", "is_monthly_contract", "is_annual_contract", "is_biannual_contract",
          "uses_electronic_check", "has_paperless_billing", "has_fiber_optic", "has_dsl", "no_internet",
          "has_online_security", "has_tech_support", "has_phone", "has_multiple_lines", "has_online_backup",
          "has_device_protect", "has_streaming_tv", "has_streaming_movies", "is_new_customer", "is_long_tenure",
          "charge_gap", "services_count", "is_high_value", "is_at_risk", "total_support_tickets",
          "negative_support_tickets", "tickets_last_6mo", "total_orders_6mo", "total_revenue_6mo",
          "avg_monthly_revenue_6mo", "revenue_volatility_6mo", "total_cancellations_6mo", "active_months_6mo",
          "lifetime_value", "avg_order_value", "total_orders", "negative_ticket_ratio", "charge_to_ltv_ratio"]
ORACLES["telco_features"] = with_base(
    "SELECT customer_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MODEL) + ", label FROM eng")

_ANOMALY = ["monthly_charges", "total_charges", "total_support_tickets", "negative_support_tickets",
            "total_cancellations_6mo", "revenue_volatility_6mo", "charge_gap", "tickets_last_6mo",
            "negative_ticket_ratio"]
ISOLATION_CTES = isolation_ctes("eng", "customer_id", _ANOMALY, "monthly_charges, total_support_tickets, negative_support_tickets, ")

ORACLES["isolation_scores"] = with_base("SELECT customer_id, anomaly_score, is_anomaly FROM iso", ctes=ISOLATION_CTES)

_TOP_ANOMALIES = "SELECT * FROM iso WHERE is_anomaly = 1 ORDER BY score DESC, customer_id LIMIT 10"

ORACLES["top_anomalies"] = with_base(
    "SELECT customer_id, anomaly_score, monthly_charges, total_support_tickets, negative_support_tickets "
    f"FROM ({_TOP_ANOMALIES}) t", ctes=ISOLATION_CTES)

ORACLES["anomaly_summary"] = with_base(
    "SELECT count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS n_anomalies, "
    f"{npr('avg(CAST(is_anomaly AS DOUBLE))', 6)} AS anomaly_rate, {npr('avg(score)', 6)} AS score_mean, "
    f"{npr('stddev_pop(score)', 6)} AS score_std, "
    f"(SELECT string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id) FROM ({_TOP_ANOMALIES}) t) AS top_customers FROM iso", ctes=ISOLATION_CTES)

_SEGMENT = ["tenure_months", "monthly_charges", "total_charges", "lifetime_value", "avg_order_value", "total_orders",
            "active_months_6mo", "total_revenue_6mo", "total_support_tickets", "services_count"]
_KMEANS_CTES, _KMEANS = kmeans_ctes("eng", "customer_id", "lifetime_value", _SEGMENT, range(3, 8))
ORACLES["kmeans_segments"] = with_base(_KMEANS, ctes=_KMEANS_CTES).replace("WITH", "WITH RECURSIVE", 1)

ORACLES["risk_response"] = with_base(
    f"SELECT customer_id, {npr(f'{_P4} * 100.0::DOUBLE', 1)} AS score, risk_tier AS tier, "
    f"{_P4} AS churn_probability, {npr('iso.score', 3)} AS anomaly_score, "
    "['Champions', 'Loyal Customers', 'At Risk', 'Hibernating', 'Lost']"
    f"[least(CAST(trunc({_P4} * 5.0::DOUBLE) AS INTEGER), 4) + 1] AS segment, "
    "r.recommendation AS recommendations FROM sc JOIN (SELECT customer_id, recommendation FROM "
    f"({ORACLES['recommendation']}) x) r USING (customer_id) JOIN iso USING (customer_id)", scored=True, ctes=ISOLATION_CTES)

_ORDER_TEXTS = ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus", "printf('%.2f', o_totalprice)",
                "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderpriority"]
_DIGESTS = """t AS (SELECT o_orderdate, concat_ws('|', """ + ", ".join(
    f"CASE WHEN {t} IS NULL THEN 'n' ELSE CAST(length({t}) AS VARCHAR) || ':' || {t} END" for t in _ORDER_TEXTS) + """) AS text FROM orders),
h AS (SELECT o_orderdate, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS h FROM t)"""
_SUMS = "CAST(count(*) AS BIGINT) AS n_rows, bit_xor(h) AS xor_hash, CAST(sum(h % 1000003) AS BIGINT) AS mod_sum_hash"

ORACLES["dataset_fingerprint"] = f"WITH {_DIGESTS} SELECT {_SUMS} FROM h"

ORACLES["partition_digests"] = f"""WITH {_DIGESTS},
d AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, h FROM h)
SELECT 2 AS level, CAST(y AS VARCHAR) || '/' || CAST(m AS VARCHAR) AS unit, {_SUMS} FROM d GROUP BY y, m
UNION ALL SELECT 1, CAST(y AS VARCHAR), {_SUMS} FROM d GROUP BY y
UNION ALL SELECT 0, '', {_SUMS} FROM d"""
