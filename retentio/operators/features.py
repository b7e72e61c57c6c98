"""Churn feature builder (P1–P16) as one fused projection.

``churn_features`` takes a bronze telco frame (normalised names) plus an
optional per-customer engagement frame and returns the model-ready table.
The whole builder is a single ``select`` over ``withColumns`` stages that
Catalyst collapses into one Project inside the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, flag_eq, np_round, safe_div, strict_int, sum_columns, to_number

# ---------------------------------------------------------------------------
# Flag definitions (source column, value, case-insensitive?).
# ---------------------------------------------------------------------------
CASE_INSENSITIVE_FLAGS = {
    "is_male": ("gender", "male"),
    "has_partner": ("partner", "YES"),
    "has_dependents": ("dependents", "YES"),
    "has_paperless_billing": ("paperlessbilling", "YES"),
}
CASE_SENSITIVE_FLAGS = {
    "is_monthly_contract": ("contract", "Month-to-month"),
    "is_annual_contract": ("contract", "One year"),
    "is_biannual_contract": ("contract", "Two year"),
    "uses_electronic_check": ("paymentmethod", "Electronic check"),
    "has_fiber_optic": ("internetservice", "Fiber optic"),
    "has_dsl": ("internetservice", "DSL"),
    "no_internet": ("internetservice", "No"),
    "has_online_security": ("onlinesecurity", "Yes"),
    "has_tech_support": ("techsupport", "Yes"),
    "has_phone": ("phoneservice", "Yes"),
    "has_multiple_lines": ("multiplelines", "Yes"),
    "has_online_backup": ("onlinebackup", "Yes"),
    "has_device_protect": ("deviceprotection", "Yes"),
    "has_streaming_tv": ("streamingtv", "Yes"),
    "has_streaming_movies": ("streamingmovies", "Yes"),
}
SERVICE_FLAGS = ["has_online_security", "has_tech_support", "has_online_backup",
                 "has_device_protect", "has_streaming_tv", "has_streaming_movies"]
CATEGORICAL_DEFAULTS = {
    "contract_type": ("contract", "Month-to-month"),
    "payment_method": ("paymentmethod", "Electronic check"),
    "internet_service": ("internetservice", "No"),
}
NEW_CUSTOMER_MONTHS = 12
LONG_TENURE_MONTHS = 48
HIGH_VALUE_CHARGE = 70

ENGAGEMENT_COLUMNS = [
    "total_support_tickets", "negative_support_tickets", "tickets_last_6mo",
    "total_orders_6mo", "total_revenue_6mo", "avg_monthly_revenue_6mo",
    "revenue_volatility_6mo", "total_cancellations_6mo", "active_months_6mo",
    "avg_order_value", "total_orders",
]

# Model feature list, in model order (44 features).
FEATURE_COLUMNS = [
    "is_male", "is_senior_citizen", "has_partner", "has_dependents",
    "tenure_months", "monthly_charges", "total_charges", "implied_tenure",
    "is_monthly_contract", "is_annual_contract", "is_biannual_contract",
    "uses_electronic_check", "has_paperless_billing",
    "has_fiber_optic", "has_dsl", "no_internet", "has_online_security",
    "has_tech_support", "has_phone", "has_multiple_lines", "has_online_backup",
    "has_device_protect", "has_streaming_tv", "has_streaming_movies",
    "is_new_customer", "is_long_tenure", "charge_gap", "services_count",
    "is_high_value", "is_at_risk",
    "total_support_tickets", "negative_support_tickets", "tickets_last_6mo",
    "total_orders_6mo", "total_revenue_6mo", "avg_monthly_revenue_6mo",
    "revenue_volatility_6mo", "total_cancellations_6mo", "active_months_6mo",
    "lifetime_value", "avg_order_value", "total_orders",
    "negative_ticket_ratio", "charge_to_ltv_ratio",
]
# ---------------------------------------------------------------------------


def label_column(churn="churn") -> Column:
    """``upper(churn) == 'YES'`` → 0/1, null → 0."""
    return flag_eq(churn, "YES", case_insensitive=True)


def binary_flag_columns(present=None) -> dict:
    """Every flag as a Column; ``present`` limits to existing sources."""
    out = {}
    for name, (src, val) in CASE_INSENSITIVE_FLAGS.items():
        if present is None or src in present:
            out[name] = flag_eq(src, val, case_insensitive=True)
    for name, (src, val) in CASE_SENSITIVE_FLAGS.items():
        if present is None or src in present:
            out[name] = flag_eq(src, val)
    return out


def derived_columns(tenure="tenure_months", monthly="monthly_charges",
                    total="total_charges", monthly_contract="is_monthly_contract") -> dict:
    """Implied tenure, lifecycle flags and the charge gap."""
    t, m, tot = F.col(tenure), F.col(monthly), F.col(total)
    return {
        "implied_tenure": safe_div(tot, m),
        "is_new_customer": flag(t < NEW_CUSTOMER_MONTHS),
        "is_long_tenure": flag(t > LONG_TENURE_MONTHS),
        "charge_gap": m * t - tot,
        "is_high_value": flag(m > HIGH_VALUE_CHARGE),
        "is_at_risk": flag((F.col(monthly_contract) == 1) & (t < NEW_CUSTOMER_MONTHS)),
    }


def value_columns(tenure="tenure_months", monthly="monthly_charges",
                  revenue_6mo="total_revenue_6mo", negative="negative_support_tickets",
                  tickets="total_support_tickets") -> dict:
    """P10–P12 as two dependent stages (ltv first, then the ratios)."""
    ltv = np_round(F.col(monthly) * F.col(tenure) + F.col(revenue_6mo), 2)
    return {
        "lifetime_value": ltv,
        "negative_ticket_ratio": np_round(
            F.col(negative) / F.when(F.col(tickets) == 0, F.lit(1)).otherwise(F.col(tickets)), 3),
    }


def ratio_to_ltv(monthly="monthly_charges", ltv="lifetime_value") -> Column:
    """round(monthly / ltv, 4), zero ltv → 0."""
    return np_round(safe_div(monthly, ltv), 4)


def churn_features(bronze: DataFrame, engagement: DataFrame | None = None,
                   key: str = "customerid") -> DataFrame:
    """P1–P14 over a normalised telco frame.

    ``engagement`` (one row per ``customer_id``, columns of
    ``ENGAGEMENT_COLUMNS``) is left-joined; missing customers get 0.
    ``seniorcitizen`` is cast strictly (P4): a null or junk value fails the
    job, as ``astype(int)`` does in the reference.
    """
    present = set(bronze.columns)
    base = bronze.select(
        F.col(key).alias("customer_id"),
        label_column("churn").alias("label"),
        strict_int("seniorcitizen").alias("is_senior_citizen"),
        to_number("tenure").alias("tenure_months"),
        to_number("monthlycharges").alias("monthly_charges"),
        to_number("totalcharges").alias("total_charges"),
        *[c.alias(n) for n, c in binary_flag_columns(present).items()],
        *[F.coalesce(F.col(src), F.lit(d)).alias(n)
          for n, (src, d) in CATEGORICAL_DEFAULTS.items()],
    )
    feat = base.withColumns(derived_columns()).withColumn(
        "services_count", sum_columns(SERVICE_FLAGS))
    if engagement is None:
        eng_cols = {c: F.lit(0.0) if "revenue" in c or c == "avg_order_value" else F.lit(0)
                    for c in ENGAGEMENT_COLUMNS}
        feat = feat.withColumns(eng_cols)
    else:
        feat = feat.join(engagement.select("customer_id", *ENGAGEMENT_COLUMNS),
                         "customer_id", "left")
    feat = feat.withColumns(value_columns())
    feat = feat.withColumn("charge_to_ltv_ratio", ratio_to_ltv())
    numeric = [f.name for f in feat.schema.fields
               if f.dataType.typeName() in ("integer", "long", "double", "float")]
    return feat.na.fill(0, subset=numeric)


def model_matrix(df: DataFrame, features=FEATURE_COLUMNS, label: str = "label", strict: bool = False,
                 keep=()) -> DataFrame:
    """Add missing features as 0, fixed order, null → 0, cast double.

    ``strict`` raises on a missing feature instead of adding zeros; ``keep``
    lists further columns to carry along.
    """
    present = set(df.columns)
    missing = [c for c in features if c not in present]
    if strict and missing:
        raise ValueError(f"model features missing: {missing}")
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in present
            else F.lit(0.0).alias(c) for c in features]
    extra = [F.col(label).cast("int").alias(label)] if label in present else []
    names = {label, *features}
    ids = [c for c in dict.fromkeys(["customer_id", *keep]) if c in present and c not in names]
    return df.select(*ids, *cols, *extra)


def keep_existing(df: DataFrame, columns) -> DataFrame:
    """Project the listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add each ``{name: Column}`` only when the frame lacks it."""
    missing = {k: v for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df
