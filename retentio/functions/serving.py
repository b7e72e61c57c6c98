"""Serving-time feature row (P17) from the request fields only.

The request carries 15 fields; the model wants 44.  Missing engagement
fields are imputed from charges and tenure exactly as the scoring service
does, as Column expressions so a whole table or stream is featurised in one
projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import (CASE_INSENSITIVE_FLAGS, CASE_SENSITIVE_FLAGS, FEATURE_COLUMNS, HIGH_VALUE_CHARGE, LONG_TENURE_MONTHS,
                                  NEW_CUSTOMER_MONTHS)
from .numeric import _c, flag, flag_eq

# ---------------------------------------------------------------------------
# What the scoring service puts where a request says nothing.
# ---------------------------------------------------------------------------
IMPUTED_ORDERS_6MO = 5
REVENUE_MONTHS = 6
VOLATILITY_SHARE = 0.1
ACTIVE_MONTHS_CAP = 6
ALWAYS = {"has_phone": 1, "services_count": 0, "total_cancellations_6mo": 0, "total_orders_6mo": IMPUTED_ORDERS_6MO}
#: The request's field for a column of the customer table.
FIELDS = {"gender": "gender", "partner": "has_partner", "dependents": "has_dependents", "paperlessbilling": "paperless_billing",
          "contract": "contract_type", "paymentmethod": "payment_method", "internetservice": "internet_service",
          "onlinesecurity": "online_security", "techsupport": "tech_support"}
# ---------------------------------------------------------------------------


def _flags(names: dict[str, str]) -> dict[str, Column]:
    """The flags of the feature builder over request fields; services that a request doesn't name are 0."""
    out = {}
    for table, fold in ((CASE_INSENSITIVE_FLAGS, True), (CASE_SENSITIVE_FLAGS, False)):
        for name, (source, value) in table.items():
            field = FIELDS.get(source)
            out[name] = flag_eq(names.get(field, field), value, case_insensitive=fold) if field else F.lit(0)
    return out


def serving_columns(**names: str) -> dict[str, Column]:
    """The model's 44 features, in model order, from the request's 15 fields.

    ``names`` maps a field to another column name.
    """
    column = lambda field: _c(names.get(field, field))
    tenure, monthly, total = (column(c).cast("double") for c in ("tenure_months", "monthly_charges", "total_charges"))
    tickets, months = column("num_support_tickets").cast("int"), tenure.cast("int")
    negative = F.greatest(tickets - 1, F.lit(0))
    over = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    flags = _flags(names)
    new = tenure < NEW_CUSTOMER_MONTHS
    told = {"is_senior_citizen": column("is_senior_citizen").cast("int"), "tenure_months": tenure, "monthly_charges": monthly, "total_charges": total}
    derived = {"implied_tenure": over(total, monthly), "is_new_customer": flag(new), "is_long_tenure": flag(tenure > LONG_TENURE_MONTHS),
               "charge_gap": monthly * tenure - total, "is_high_value": flag(monthly > HIGH_VALUE_CHARGE),
               "is_at_risk": flag((flags["is_monthly_contract"] == 1) & new)}
    # Engagement is not in a request: it follows from charges, tenure and tickets.
    imputed = {**{c: F.lit(v) for c, v in ALWAYS.items()},
               **dict.fromkeys(["total_support_tickets", "tickets_last_6mo"], tickets), "negative_support_tickets": negative,
               "negative_ticket_ratio": over(negative, tickets),
               **dict.fromkeys(["avg_monthly_revenue_6mo", "avg_order_value"], monthly), "total_revenue_6mo": monthly * F.lit(float(REVENUE_MONTHS)),
               "revenue_volatility_6mo": monthly * F.lit(VOLATILITY_SHARE), "lifetime_value": total, "charge_to_ltv_ratio": over(monthly, total),
               "active_months_6mo": F.least(F.lit(ACTIVE_MONTHS_CAP), months), "total_orders": F.greatest(F.lit(1), months)}
    every = {**flags, **told, **derived, **imputed}
    return {c: every[c] for c in FEATURE_COLUMNS}


def with_serving_features(requests: DataFrame, keep=(), key: str = "customer_id") -> DataFrame:
    """Request rows as feature rows: ``key``, the columns of ``keep`` and the 44 features."""
    return requests.select(key, *keep, *[c.alias(n) for n, c in serving_columns().items()])
