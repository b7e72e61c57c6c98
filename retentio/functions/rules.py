"""Decision rules of the scoring service as ``Column`` expressions.

Each builder takes column names (or Columns) so the same rule serves a
request table, a scored feature table or a stream.  Arrays are built with
``array_compact(array(when(rule, value)))`` which keeps the rule order and
drops rules that did not fire — a per-row loop is never needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c, np_round

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's outputs (thresholds, weights,
# texts).  Kept together, in the reference's order.
# ---------------------------------------------------------------------------
PRED_THRESHOLD = 0.5
TIER_HIGH = 0.70
TIER_MEDIUM = 0.40
TIERS = ("HIGH", "MEDIUM", "LOW")

# top factors: (feature, impact); all have direction "increases"
FACTOR_WEIGHTS = [
    ("contract_type", 0.42),
    ("tenure_months", 0.31),
    ("internet_service", 0.24),
    ("num_support_tickets", 0.19),
    ("online_security", 0.15),
    ("tech_support", 0.12),
    ("monthly_charges", 0.10),
]
MAX_FACTORS = 5
MAX_DRIVERS = 4

REC_HIGH_MONTHLY = ("Offer a 20% discount to upgrade to a 1-year contract. "
                    "Assign a dedicated customer success manager immediately.")
REC_HIGH_OTHER = ("Schedule a proactive retention call. "
                  "Offer a loyalty reward or service upgrade.")
REC_MEDIUM_BUNDLE = ("Bundle online security + tech support at a reduced rate. "
                     "Send a personalised value email.")
REC_MEDIUM_OTHER = "Send a satisfaction survey and offer a loyalty discount."
REC_LOW = "Customer is healthy. Continue standard engagement."

PROB_SEGMENTS = ["Champions", "Loyal Customers", "At Risk", "Hibernating", "Lost"]

DRIVER_MONTHLY = "Month-to-month contract with no lock-in"
DRIVER_TENURE = "Low tenure (%d months)"
DRIVER_TICKETS = "High support ticket volume (%d tickets)"
DRIVER_FIBER = "Fiber optic customers churn at higher rates"
DRIVER_SECURITY = "No online security subscription"

MODEL_VERSION = "xgb_lgb_ensemble_v1"

DRIFT_ALARM = 0.20
DRIFT_WARN = 0.10
PRED_DRIFT_ALARM_PCT = 15.0
TREND_UP = 1.05
TREND_DOWN = 0.95
BAND_LOW = 0.92
BAND_HIGH = 1.08
# ---------------------------------------------------------------------------


def churn_prediction(prob) -> Column:
    """prediction = prob >= 0.5."""
    return _c(prob) >= F.lit(PRED_THRESHOLD)


def risk_tier(prob) -> Column:
    """HIGH >= .70, MEDIUM >= .40, else LOW (on the unrounded prob)."""
    p = _c(prob)
    return (F.when(p >= TIER_HIGH, F.lit("HIGH"))
            .when(p >= TIER_MEDIUM, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def _factor_conditions(contract, tenure, internet, tickets, security, support, monthly):
    return [
        _c(contract) == "Month-to-month",
        _c(tenure) < 12,
        _c(internet) == "Fiber optic",
        _c(tickets) >= 3,
        _c(security) == "No",
        _c(support) == "No",
        _c(monthly) > 80,
    ]


def top_factors(contract="contract_type", tenure="tenure_months",
                internet="internet_service", tickets="num_support_tickets",
                security="online_security", support="tech_support",
                monthly="monthly_charges", limit: int = MAX_FACTORS) -> Column:
    """P20: ordered rule factors, first ``limit`` that fire.

    Returns ``array<struct<feature:string, impact:double, direction:string>>``.
    """
    conds = _factor_conditions(contract, tenure, internet, tickets, security,
                               support, monthly)
    items = [F.when(cond, F.struct(F.lit(name).alias("feature"),
                                   F.lit(w).alias("impact"),
                                   F.lit("increases").alias("direction")))
             for cond, (name, w) in zip(conds, FACTOR_WEIGHTS)]
    return F.slice(F.array_compact(F.array(*items)), 1, limit)


def factor_titles(factors, n: int = 3) -> Column:
    """First ``n`` factor names in title case ("Contract Type")."""
    return F.transform(F.slice(_c(factors), 1, n),
                       lambda f: F.initcap(F.replace(f["feature"], F.lit("_"), F.lit(" "))))


def recommendation(tier, contract="contract_type", security="online_security",
                   support="tech_support") -> Column:
    """Recommendation text from tier × contract × (security/support)."""
    t = _c(tier)
    bundle = (F.coalesce(_c(security) == "No", F.lit(False))
              | F.coalesce(_c(support) == "No", F.lit(False)))
    monthly = F.coalesce(_c(contract) == "Month-to-month", F.lit(False))
    return (F.when((t == "HIGH") & monthly, F.lit(REC_HIGH_MONTHLY))
            .when(t == "HIGH", F.lit(REC_HIGH_OTHER))
            .when((t == "MEDIUM") & bundle, F.lit(REC_MEDIUM_BUNDLE))
            .when(t == "MEDIUM", F.lit(REC_MEDIUM_OTHER))
            .otherwise(F.lit(REC_LOW)))


def risk_score(prob) -> Column:
    """round(prob * 100, 1) with numpy rounding."""
    return np_round(_c(prob) * 100.0, 1)


def probability_segment(prob) -> Column:
    """Segment name = list[min(int(prob * 5), 4)]."""
    idx = F.least((_c(prob) * 5.0).cast("int"), F.lit(4))
    return F.try_element_at(F.array(*[F.lit(s) for s in PROB_SEGMENTS]), idx + 1)


def risk_drivers(contract="contract_type", tenure="tenure_months",
                 tickets="num_support_tickets", internet="internet_service",
                 security="online_security", limit: int = MAX_DRIVERS) -> Column:
    """Ordered driver sentences, first ``limit``; tenure truncated to int."""
    items = [
        F.when(_c(contract) == "Month-to-month", F.lit(DRIVER_MONTHLY)),
        F.when(_c(tenure) < 12,
               F.format_string(DRIVER_TENURE, _c(tenure).cast("int"))),
        F.when(_c(tickets) >= 3,
               F.format_string(DRIVER_TICKETS, _c(tickets).cast("int"))),
        F.when(_c(internet) == "Fiber optic", F.lit(DRIVER_FIBER)),
        F.when(_c(security) == "No", F.lit(DRIVER_SECURITY)),
    ]
    return F.slice(F.array_compact(F.array(*items)), 1, limit)


def drift_status(psi) -> Column:
    """P29 (DAG variant): > .20 DRIFT, > .10 WARNING, else STABLE."""
    p = _c(psi)
    return (F.when(p > DRIFT_ALARM, F.lit("DRIFT"))
            .when(p > DRIFT_WARN, F.lit("WARNING"))
            .otherwise(F.lit("STABLE")))


def trend_class(first, last) -> Column:
    """Growing if last > 1.05·first, declining if < .95·first."""
    f, l = _c(first), _c(last)
    return (F.when(l > f * TREND_UP, F.lit("growing"))
            .when(l < f * TREND_DOWN, F.lit("declining"))
            .otherwise(F.lit("stable")))


def forecast_band(value):
    """(lower, upper) = round(.92·v, 2), round(1.08·v, 2)."""
    v = _c(value)
    return np_round(v * BAND_LOW, 2), np_round(v * BAND_HIGH, 2)


def error_pct(pred, actual) -> Column:
    """(pred − actual) / actual · 100, null when actual is 0."""
    return F.try_divide((_c(pred) - _c(actual)) * 100.0, _c(actual))


def tenure_band(tenure) -> Column:
    """Right-closed bands (0,12] (12,24] (24,36] (36,48] (48,72]; else null."""
    t = _c(tenure)
    return (F.when((t > 0) & (t <= 12), F.lit("0-12"))
            .when((t > 12) & (t <= 24), F.lit("12-24"))
            .when((t > 24) & (t <= 36), F.lit("24-36"))
            .when((t > 36) & (t <= 48), F.lit("36-48"))
            .when((t > 48) & (t <= 72), F.lit("48-72")))


def tenure_band_order(band) -> Column:
    """Sort key of the ordered categorical of A7."""
    return F.array_position(F.array(*[F.lit(x) for x in
                                      ("0-12", "12-24", "24-36", "36-48", "48-72")]),
                            _c(band))


def violations(rules: dict) -> Column:
    """``{rule_name: ok_condition}`` → array of failed rule names.

    A null condition counts as a failure (a required field is missing).
    """
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
        for name, ok in rules.items()]))


# The request's domains and defaults.
YES_NO = ("Yes", "No")
SERVICE = ("Yes", "No", "No internet service")
DOMAINS = {
    "contract_type": ("Month-to-month", "One year", "Two year"),
    "payment_method": ("Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"),
    "internet_service": ("Fiber optic", "DSL", "No"),
    "online_security": SERVICE, "tech_support": SERVICE,
    "has_partner": YES_NO, "has_dependents": YES_NO, "paperless_billing": YES_NO,
    "gender": ("Male", "Female"),
}
NON_NEGATIVE = ("tenure_months", "monthly_charges", "total_charges")
CHURN_DEFAULTS = {"online_security": "No", "tech_support": "No", "num_support_tickets": 0, "is_senior_citizen": 0,
                  "has_partner": "No", "has_dependents": "No", "paperless_billing": "Yes", "gender": "Male"}
RISK_DEFAULTS = {**CHURN_DEFAULTS, "contract_type": "Month-to-month", "payment_method": "Electronic check",
                 "internet_service": "Fiber optic"}
PERIODS_RANGE = (1, 24)


def with_request_defaults(df, defaults: dict = CHURN_DEFAULTS):
    """Absent columns and null values of optional fields take their defaults."""
    return df.withColumns({c: (F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
                           for c, v in defaults.items()})


def request_rules(names: dict | None = None, charges: bool = True) -> dict:
    """The scoring request's rules, ``{rule: ok_condition}``.

    ``names`` maps a field to another column name.  The risk request, which
    doesn't bound tenure and charges from below, has ``charges=False``.
    """
    c = lambda f: F.col((names or {}).get(f, f))
    rules = {"customer_id_present": c("customer_id").isNotNull()}
    rules |= {f"{f}_non_negative": c(f) >= 0 if charges else c(f).isNotNull() for f in NON_NEGATIVE}
    rules |= {f"{f}_domain": c(f).isin(*values) for f, values in DOMAINS.items()}
    return rules | {"num_support_tickets_non_negative": c("num_support_tickets") >= 0,
                    "is_senior_citizen_domain": c("is_senior_citizen").isin(0, 1)}


# What the summary and revenue requests may ask for, and their defaults.
REPORT_TYPES = ["executive", "churn", "revenue", "risk"]
DATE_RANGES = ["last_7_days", "last_30_days", "last_90_days"]
GRANULARITIES = ["monthly"]
SUMMARY_DEFAULTS = {"report_type": "executive", "date_range": "last_30_days"}
REVENUE_DEFAULTS = {"periods": 6, "granularity": "monthly"}


def periods_rule(periods) -> Column:
    """A forecast request asks for 1 to 24 periods."""
    return _c(periods).between(*PERIODS_RANGE)


def summary_rules(report_type="report_type", date_range="date_range") -> dict:
    """The summary request's rules, ``{rule: ok_condition}``."""
    return {"report_type_domain": _c(report_type).isin(*REPORT_TYPES), "date_range_domain": _c(date_range).isin(*DATE_RANGES)}


def revenue_rules(periods="periods", granularity="granularity") -> dict:
    """The revenue request's rules, ``{rule: ok_condition}``."""
    return {"periods_range": periods_rule(periods), "granularity_domain": _c(granularity).isin(*GRANULARITIES)}


def risk_response(prob, anomaly_score, factors_col=None, contract="contract_type",
                  security="online_security", support="tech_support") -> Column:
    """P25: nested risk response.

    ``struct<score, tier, churn_probability, anomaly_score, segment,
    recommendations array<string>>`` where the probability is first rounded
    to 4 places as the service does; the anomaly score comes from the
    isolation forest rather than a constant.
    """
    p4 = np_round(_c(prob), 4)
    tier = risk_tier(_c(prob))
    return F.struct(
        risk_score(p4).alias("score"),
        tier.alias("tier"),
        p4.alias("churn_probability"),
        np_round(_c(anomaly_score), 3).alias("anomaly_score"),
        probability_segment(p4).alias("segment"),
        F.array(recommendation(tier, contract, security, support)).alias("recommendations"),
    )


def split_valid(df, rules: dict, reasons: str = "violations"):
    """``(valid, quarantine)`` frames; quarantine rows carry the names of
    the rules they broke.  One projection, two filters — no second scan when
    the caller persists or writes both from the same source."""
    tagged = df.withColumn(reasons, violations(rules))
    return (tagged.filter(F.size(reasons) == 0).drop(reasons),
            tagged.filter(F.size(reasons) > 0))
