"""DuckDB-dialect twins of the adaptation, shared by the oracle strings.

These strings are the *reference answers* the driver runs in DuckDB beside
the Spark queries; they never run on Spark.
"""

from __future__ import annotations


def np_round_sql(expr: str, digits: int) -> str:
    """numpy rounding (rint of the scaled double) in DuckDB SQL."""
    s = f"{float(10 ** digits)!r}::DOUBLE"
    y = f"(({expr}) * {s})"
    return (f"((CASE WHEN abs({y} - trunc({y})) = 0.5 THEN 2.0::DOUBLE * round({y} / 2.0::DOUBLE) "
            f"ELSE round({y}) END) / {s})")


def _yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"


def _flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


# Money is in thousands; constants are written out here, not imported from the
# code under test.
RECENT = "o.o_orderdate >= r.as_of - INTERVAL 6 MONTH"


def _window(k: int) -> str:
    upper = f" AND o.o_orderdate < r.as_of - INTERVAL {k} MONTH" if k else ""
    return (f"CAST(sum(CASE WHEN o.o_orderdate >= r.as_of - INTERVAL {k + 1} MONTH{upper} "
            f"THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) "
            f"/ 1000.0::DOUBLE AS w{k}")


_DEV = " + ".join(f"(w{k} - mean_w) * (w{k} - mean_w)" for k in range(6))

# Customer feature frame (cf) and engineered frame (eng), one row per customer.
BASE_CTES = f"""
ref AS (SELECT max(o_orderdate) AS as_of FROM orders),
evref AS (SELECT max(ts) AS ev_max FROM events),
oa0 AS (
  SELECT o.o_custkey AS customer_id,
         min(o.o_orderdate) AS first_order,
         max(o.o_orderdate) AS last_order,
         CAST(count(*) AS BIGINT) AS total_orders,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000.0::DOUBLE AS total_spend,
         CAST(count_if({RECENT}) AS BIGINT) AS total_orders_6mo,
         CAST(sum(CASE WHEN {RECENT} THEN CAST(o.o_totalprice AS DECIMAL(18,2))
                       ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) / 1000.0::DOUBLE AS total_revenue_6mo,
         CAST(count(DISTINCT CASE WHEN {RECENT} THEN date_trunc('month', o.o_orderdate) END) AS BIGINT)
           AS active_months_6mo,
         CAST(count_if({RECENT} AND o.o_orderstatus = 'P') AS BIGINT) AS total_cancellations_6mo,
         {", ".join(_window(k) for k in range(6))}
  FROM orders o CROSS JOIN ref r
  GROUP BY o.o_custkey),
oa1 AS (SELECT *, (w0 + w1 + w2 + w3 + w4 + w5) / 6.0::DOUBLE AS mean_w FROM oa0),
oa AS (
  SELECT *,
         {np_round_sql('coalesce(total_spend / nullif(total_orders, 0), 0.0::DOUBLE)', 2)} AS avg_order_value,
         {np_round_sql('total_revenue_6mo / 6.0::DOUBLE', 2)} AS avg_monthly_revenue_6mo,
         {np_round_sql(f'sqrt(({_DEV}) / 6.0::DOUBLE)', 2)} AS revenue_volatility_6mo
  FROM oa1),
ta AS (
  SELECT e.user_id AS customer_id,
         CAST(count(*) AS BIGINT) AS total_support_tickets,
         CAST(count_if(e.event_type = 'error') AS BIGINT) AS negative_support_tickets,
         CAST(count_if(e.ts >= v.ev_max - INTERVAL 6 MONTH) AS BIGINT) AS tickets_last_6mo
  FROM events e CROSS JOIN evref v
  GROUP BY e.user_id),
cf0 AS (
  SELECT c.c_custkey AS customer_id,
         c.c_mktsegment AS segment,
         c.c_acctbal AS acctbal,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Month-to-month' WHEN 'FURNITURE' THEN 'Month-to-month'
              WHEN 'HOUSEHOLD' THEN 'One year' WHEN 'MACHINERY' THEN 'One year' ELSE 'Two year' END AS contract_type,
         CASE WHEN c.c_acctbal < 0 THEN 'Electronic check' WHEN c.c_acctbal < 3000 THEN 'Mailed check'
              WHEN c.c_acctbal < 6000 THEN 'Bank transfer (automatic)'
              ELSE 'Credit card (automatic)' END AS payment_method,
         CASE n.n_regionkey WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' WHEN 3 THEN 'Fiber optic' WHEN 4 THEN 'DSL'
              ELSE 'No' END AS internet_service,
         {_yn("c.c_acctbal >= 5000")} AS online_security,
         {_yn("coalesce(oa.total_orders, 0) >= 12")} AS tech_support,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         {_yn("c.c_nationkey % 2 = 0")} AS partner,
         {_yn("c.c_nationkey % 3 = 0")} AS dependents,
         {_yn("c.c_custkey % 4 <> 0")} AS paperless_billing,
         CASE WHEN oa.last_order IS NULL OR oa.last_order < r.as_of - INTERVAL 365 DAY
              THEN 1 ELSE 0 END AS label,
         {_flag("c.c_acctbal < 0")} AS is_senior_citizen,
         CAST(coalesce((year(r.as_of) - year(oa.first_order)) * 12
                       + (month(r.as_of) - month(oa.first_order)), 0) AS INTEGER) AS tenure_months,
         coalesce(oa.total_spend, 0.0::DOUBLE) AS total_charges,
         CAST(coalesce(ta.total_support_tickets, 0) AS BIGINT) AS total_support_tickets,
         CAST(coalesce(ta.negative_support_tickets, 0) AS BIGINT) AS negative_support_tickets,
         CAST(coalesce(ta.tickets_last_6mo, 0) AS BIGINT) AS tickets_last_6mo,
         CAST(coalesce(oa.total_orders_6mo, 0) AS BIGINT) AS total_orders_6mo,
         coalesce(oa.total_revenue_6mo, 0.0::DOUBLE) AS total_revenue_6mo,
         coalesce(oa.avg_monthly_revenue_6mo, 0.0::DOUBLE) AS avg_monthly_revenue_6mo,
         coalesce(oa.revenue_volatility_6mo, 0.0::DOUBLE) AS revenue_volatility_6mo,
         CAST(coalesce(oa.total_cancellations_6mo, 0) AS BIGINT) AS total_cancellations_6mo,
         CAST(coalesce(oa.active_months_6mo, 0) AS BIGINT) AS active_months_6mo,
         coalesce(oa.avg_order_value, 0.0::DOUBLE) AS avg_order_value,
         CAST(coalesce(oa.total_orders, 0) AS BIGINT) AS total_orders,
         oa.last_order AS last_order,
         {_flag("c.c_custkey % 2 = 0")} AS is_male,
         {_flag("c.c_nationkey % 2 = 0")} AS has_partner,
         {_flag("c.c_nationkey % 3 = 0")} AS has_dependents,
         {_flag("c.c_custkey % 4 <> 0")} AS has_paperless_billing,
         {_flag("c.c_custkey % 10 <> 0")} AS has_phone,
         {_flag("c.c_custkey % 3 = 0")} AS has_multiple_lines,
         {_flag("c.c_custkey % 5 < 2")} AS has_online_backup,
         {_flag("c.c_custkey % 7 < 3")} AS has_device_protect,
         {_flag("c.c_custkey % 4 = 1")} AS has_streaming_tv,
         {_flag("c.c_custkey % 6 = 1")} AS has_streaming_movies
  FROM customer c
  CROSS JOIN ref r
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN oa ON c.c_custkey = oa.customer_id
  LEFT JOIN ta ON c.c_custkey = ta.customer_id),
cf AS (
  SELECT *, total_charges / greatest(tenure_months, 1) AS monthly_charges,
         {_flag("contract_type = 'Month-to-month'")} AS is_monthly_contract,
         {_flag("contract_type = 'One year'")} AS is_annual_contract,
         {_flag("contract_type = 'Two year'")} AS is_biannual_contract,
         {_flag("payment_method = 'Electronic check'")} AS uses_electronic_check,
         {_flag("internet_service = 'Fiber optic'")} AS has_fiber_optic,
         {_flag("internet_service = 'DSL'")} AS has_dsl,
         {_flag("internet_service = 'No'")} AS no_internet,
         {_flag("online_security = 'Yes'")} AS has_online_security,
         {_flag("tech_support = 'Yes'")} AS has_tech_support
  FROM cf0),
eng0 AS (
  SELECT *,
         total_support_tickets AS num_support_tickets,
         coalesce(total_charges / nullif(monthly_charges, 0), 0.0::DOUBLE) AS implied_tenure,
         {_flag("tenure_months < 12")} AS is_new_customer,
         {_flag("tenure_months > 48")} AS is_long_tenure,
         monthly_charges * tenure_months - total_charges AS charge_gap,
         {_flag("monthly_charges > 70")} AS is_high_value,
         {_flag("is_monthly_contract = 1 AND tenure_months < 12")} AS is_at_risk,
         has_online_security + has_tech_support + has_online_backup + has_device_protect
           + has_streaming_tv + has_streaming_movies AS services_count,
         {np_round_sql('monthly_charges * tenure_months + total_revenue_6mo', 2)} AS lifetime_value,
         {np_round_sql('negative_support_tickets / (CASE WHEN total_support_tickets = 0 THEN 1 ELSE total_support_tickets END)', 3)}
           AS negative_ticket_ratio
  FROM cf),
eng AS (
  SELECT *,
         {np_round_sql('coalesce(monthly_charges / nullif(lifetime_value, 0), 0.0::DOUBLE)', 4)} AS charge_to_ltv_ratio
  FROM eng0),
"""


def _rule_prob_sql() -> str:
    conds = [
        ("contract_type = 'Month-to-month'", 0.42),
        ("tenure_months < 12", 0.31),
        ("internet_service = 'Fiber optic'", 0.24),
        ("num_support_tickets >= 3", 0.19),
        ("online_security = 'No'", 0.15),
        ("tech_support = 'No'", 0.12),
        ("monthly_charges > 80", 0.10),
    ]
    terms = [f"(CASE WHEN {c} THEN {w!r}::DOUBLE ELSE 0.0::DOUBLE END)" for c, w in conds]
    s = terms[0]
    for t in terms[1:]:
        s = f"({s} + {t})"
    return f"({s} / {sum(w for _, w in conds)!r}::DOUBLE)"


RULE_PROB = _rule_prob_sql()
TIER_SQL = ("CASE WHEN churn_prob >= 0.7::DOUBLE THEN 'HIGH' WHEN churn_prob >= 0.4::DOUBLE THEN 'MEDIUM' "
            "ELSE 'LOW' END")

SCORED_CTES = BASE_CTES + f"""
sc0 AS (SELECT *, {RULE_PROB} AS churn_prob FROM eng),
sc AS (SELECT *, {TIER_SQL} AS risk_tier FROM sc0),
"""


def with_base(body: str, scored: bool = False, ctes: str = "") -> str:
    """Prefix a query body with the base CTEs plus optional extra CTEs."""
    base = (SCORED_CTES if scored else BASE_CTES).rstrip()
    extra = ctes.strip().rstrip(",")
    allc = (base + "\n" + extra) if extra else base.rstrip(",")
    return f"WITH {allc}\n{body}"
