"""Standard adaptation of the test tables to the churn data model.

customer = ``customer``; orders = ``orders`` (money in thousands);
tickets = ``events`` with ``user_id = c_custkey``, negative = ``error``;
``as_of`` = latest order date; label = no order in the 365 days before
``as_of``.  Telco attributes the tables lack are derived from columns that
exist (fixed mapping below), so the risk rules see realistic domains.  The
features are the library's own functions over these columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import months_between_floor, strict_int, sum_columns
from ..functions import rules as R
from ..operators.features import (CATEGORICAL_DEFAULTS, ENGAGEMENT_COLUMNS, SERVICE_FLAGS,
                                  binary_flag_columns, derived_columns, label_column, ratio_to_ltv,
                                  value_columns)
from ..operators.engagement import as_of, engagement_join, order_activity, ticket_activity
from ..sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the adaptation (documented in README).
# ---------------------------------------------------------------------------
CONTRACT_BY_SEGMENT = {
    "AUTOMOBILE": "Month-to-month",
    "FURNITURE": "Month-to-month",
    "HOUSEHOLD": "One year",
    "MACHINERY": "One year",
    "BUILDING": "Two year",
}
INTERNET_BY_REGION = ["DSL", "Fiber optic", "No", "Fiber optic", "DSL"]  # region 0..4
PAYMENT_BY_BALANCE = [(0.0, "Electronic check"), (3000.0, "Mailed check"),
                      (6000.0, "Bank transfer (automatic)")]
PAYMENT_DEFAULT = "Credit card (automatic)"
SECURITY_BALANCE = 5000.0
SUPPORT_MIN_ORDERS = 12
CHURN_DAYS = 365
MONEY_SCALE = 1000.0
CANCELLED_STATUS = "P"
# ---------------------------------------------------------------------------


def contract_of(segment: Column) -> Column:
    m = F.create_map(*[x for kv in CONTRACT_BY_SEGMENT.items() for x in map(F.lit, kv)])
    return F.coalesce(m[segment], F.lit("Two year"))


def internet_of(regionkey: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, INTERNET_BY_REGION)), (regionkey + 1).cast("int"))


def payment_of(balance: Column) -> Column:
    e = None
    for bound, name in PAYMENT_BY_BALANCE:
        e = (F.when(balance < bound, F.lit(name)) if e is None
             else e.when(balance < bound, F.lit(name)))
    return e.otherwise(F.lit(PAYMENT_DEFAULT))


def yes_no(cond: Column) -> Column:
    return F.when(cond, "Yes").otherwise("No")


def bronze(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer with the telco table's column names, and the
    engagement facts beside them."""
    customer = read_table(spark, d, "customer")
    nation = read_table(spark, d, "nation")
    orders = read_table(spark, d, "orders")
    events = read_table(spark, d, "events")

    ref = as_of(orders, "o_orderdate")
    oa = order_activity(orders, "o_custkey", "o_orderdate", "o_totalprice",
                        status="o_orderstatus", cancelled_value=CANCELLED_STATUS,
                        reference_ts=ref, money_scale=MONEY_SCALE)
    ta = ticket_activity(events, "user_id", "ts", F.col("event_type") == "error")
    # as_of-dependent columns are computed on the per-customer aggregate,
    # below the join: later projections see plain attributes, so the scalar
    # subquery is not copied into every expression that uses tenure or label.
    oa = oa.withColumns({
        "_tenure": months_between_floor(ref, F.col("first_order")),
        "_lapsed": F.col("last_order") < ref - F.make_dt_interval(F.lit(CHURN_DAYS)),
    })
    cust = customer.join(nation.select("n_nationkey", "n_regionkey"),
                         customer.c_nationkey == nation.n_nationkey, "left")
    j = engagement_join(cust, "c_custkey", oa, ta)

    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    internet = internet_of(F.col("n_regionkey"))
    tenure = F.coalesce(F.col("_tenure"), F.lit(0))
    total = F.coalesce(F.col("total_spend"), F.lit(0.0))
    n_orders = F.coalesce(F.col("total_orders"), F.lit(0))
    return j.select(
        key.alias("customerid"), F.col("c_mktsegment").alias("segment"), bal.alias("acctbal"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(bal < 0, 1).otherwise(0).alias("seniorcitizen"),
        yes_no(F.col("c_nationkey") % 2 == 0).alias("partner"),
        yes_no(F.col("c_nationkey") % 3 == 0).alias("dependents"),
        yes_no(key % 10 != 0).alias("phoneservice"), yes_no(key % 3 == 0).alias("multiplelines"),
        internet.alias("internetservice"), yes_no(bal >= SECURITY_BALANCE).alias("onlinesecurity"),
        yes_no(key % 5 < 2).alias("onlinebackup"), yes_no(key % 7 < 3).alias("deviceprotection"),
        yes_no(n_orders >= SUPPORT_MIN_ORDERS).alias("techsupport"),
        yes_no(key % 4 == 1).alias("streamingtv"), yes_no(key % 6 == 1).alias("streamingmovies"),
        contract_of(F.col("c_mktsegment")).alias("contract"),
        yes_no(key % 4 != 0).alias("paperlessbilling"), payment_of(bal).alias("paymentmethod"),
        yes_no(F.coalesce(F.col("_lapsed"), F.lit(True))).alias("churn"),  # no order at all → churned
        tenure.alias("tenure_months"), total.alias("total_charges"),
        (total / F.greatest(tenure, F.lit(1))).alias("monthly_charges"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ENGAGEMENT_COLUMNS],
        F.col("last_order"))


def customer_features(spark: SparkSession, d: str) -> DataFrame:
    """Labels, flags and categories from the bronze columns."""
    b = bronze(spark, d)
    return b.select(
        F.col("customerid").alias("customer_id"), "segment", "acctbal",
        *[F.coalesce(F.col(src), F.lit(v)).alias(n) for n, (src, v) in CATEGORICAL_DEFAULTS.items()],
        F.col("onlinesecurity").alias("online_security"), F.col("techsupport").alias("tech_support"),
        "gender", F.col("partner").alias("partner"), F.col("dependents").alias("dependents"),
        F.col("paperlessbilling").alias("paperless_billing"),
        label_column("churn").alias("label"), strict_int("seniorcitizen").alias("is_senior_citizen"),
        "tenure_months", "total_charges", "monthly_charges", *ENGAGEMENT_COLUMNS, "last_order",
        *[c.alias(n) for n, c in binary_flag_columns(set(b.columns)).items()])


def engineered(spark: SparkSession, d: str) -> DataFrame:
    """customer_features + derived flags, value and ratio columns."""
    e = customer_features(spark, d).withColumn("num_support_tickets", F.col("total_support_tickets"))
    e = e.withColumns({**derived_columns(), "services_count": sum_columns(SERVICE_FLAGS)})
    return e.withColumns(value_columns()).withColumn("charge_to_ltv_ratio", ratio_to_ltv())


# Rule score: the sum of the seven factor weights that fire, divided by the sum
# of all weights, so it lies in [0, 1].  Used where no trained model is given.
WEIGHT_TOTAL = sum(w for _, w in R.FACTOR_WEIGHTS)


def rule_probability(contract="contract_type", tenure="tenure_months",
                     internet="internet_service", tickets="num_support_tickets",
                     security="online_security", support="tech_support",
                     monthly="monthly_charges") -> Column:
    conds = R._factor_conditions(contract, tenure, internet, tickets, security,
                                 support, monthly)
    s = None
    for cond, (_, w) in zip(conds, R.FACTOR_WEIGHTS):
        term = F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
        s = term if s is None else s + term
    return s / F.lit(WEIGHT_TOTAL)


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Engineered customers with the rule probability and tier."""
    e = engineered(spark, d)
    return e.withColumn("churn_prob", rule_probability()).withColumn(
        "risk_tier", R.risk_tier(F.col("churn_prob")))
