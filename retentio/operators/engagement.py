"""Engagement from transactions and tickets.

Facts are pre-aggregated per customer (map-side partial aggregation, so a
customer holding a third of all rows costs one hash-map entry per task, not
one task) and then left-joined to the customer dimension, which arrives
already hash-partitioned by the key.  ``as_of`` is a scalar subquery: Spark
runs it once and inlines the value, no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, np_round, safe_div


def as_of(df: DataFrame, ts: str) -> Column:
    """Latest timestamp of ``df`` as a scalar-subquery Column."""
    return df.select(F.max(ts)).scalar()


def _money(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def money_sum(c, scale: float = 1.0) -> Column:
    """Exact money total: decimal sum, then double (order-independent)."""
    s = F.sum(_money(c)).cast("double")
    return s / F.lit(float(scale)) if scale != 1.0 else s


def order_activity(orders: DataFrame, key: str, ts: str, amount: str,
                   status: str | None = None, cancelled_value: str | None = None,
                   reference_ts: Column | None = None, recent_months: int = 6,
                   money_scale: float = 1.0, out_key: str = "customer_id") -> DataFrame:
    """Per-customer order facts under the model's names.

    ``first_order``, ``last_order``, ``total_orders``, ``total_spend``,
    ``avg_order_value`` and, over the ``recent_months`` before
    ``reference_ts`` (default: the table's own latest timestamp),
    ``total_orders_6mo``, ``total_revenue_6mo``, ``avg_monthly_revenue_6mo``,
    ``revenue_volatility_6mo`` (population deviation of the revenue of the
    trailing one-month windows), ``active_months_6mo`` (calendar months with
    orders) and ``total_cancellations_6mo``.

    One aggregate by customer, summed map-side: the distinct months are a
    bitmap and the windows are conditional sums, so nothing is expanded and
    the orders are shuffled once, as one row per customer and task.
    """
    ref = reference_ts if reference_ts is not None else as_of(orders, ts)
    back = [ref - F.make_ym_interval(F.lit(0), F.lit(k)) for k in range(recent_months + 1)]
    recent = F.col(ts) >= back[-1]
    amt = _money(amount)
    zero = F.lit(0).cast("decimal(18,2)")
    cancelled = (F.col(status) == F.lit(cancelled_value)) if status else F.lit(False)
    bit = F.expr(f"shiftleft(1L, cast(pmod(year({ts}) * 12 + month({ts}), 63) as int))")
    window = [F.sum(F.when((F.col(ts) >= back[k + 1]) & ((F.col(ts) < back[k]) if k else F.lit(True)), amt)
                    .otherwise(zero)).alias(f"_w{k}") for k in range(recent_months)]
    g = orders.groupBy(F.col(key).alias(out_key)).agg(
        F.min(ts).alias("first_order"), F.max(ts).alias("last_order"),
        F.count(F.lit(1)).alias("total_orders"), F.sum(amt).alias("_amt"),
        F.count_if(recent).alias("total_orders_6mo"),
        F.sum(F.when(recent, amt).otherwise(zero)).alias("_recent"),
        F.bit_count(F.bit_or(F.when(recent, bit).otherwise(F.lit(0).cast("long")))).cast("long").alias("active_months_6mo"),
        F.count_if(recent & cancelled).alias("total_cancellations_6mo"), *window)
    scale = F.lit(float(money_scale))
    g = g.withColumns({"total_spend": F.col("_amt").cast("double") / scale,
                       "total_revenue_6mo": F.col("_recent").cast("double") / scale,
                       **{f"_w{k}": F.col(f"_w{k}").cast("double") / scale for k in range(recent_months)}})
    total = sum((F.col(f"_w{k}") for k in range(1, recent_months)), F.col("_w0"))
    g = g.withColumn("_mean", total / float(recent_months))
    dev = [(F.col(f"_w{k}") - F.col("_mean")) * (F.col(f"_w{k}") - F.col("_mean")) for k in range(recent_months)]
    return g.withColumns({
        "avg_order_value": np_round(safe_div(F.col("total_spend"), F.col("total_orders")), 2),
        "avg_monthly_revenue_6mo": np_round(F.col("total_revenue_6mo") / float(recent_months), 2),
        "revenue_volatility_6mo": np_round(F.sqrt(sum(dev[1:], dev[0]) / float(recent_months)), 2),
    }).drop("_amt", "_recent", "_mean", *[f"_w{k}" for k in range(recent_months)])


def ticket_activity(tickets: DataFrame, key: str, ts: str, negative: Column,
                    recent_months: int = 6, reference_ts: Column | None = None,
                    out_key: str = "customer_id") -> DataFrame:
    """Per-customer ticket facts: total, negative, those of the trailing months."""
    ref = reference_ts if reference_ts is not None else as_of(tickets, ts)
    recent = F.col(ts) >= ref - F.make_ym_interval(F.lit(0), F.lit(recent_months))
    return tickets.groupBy(F.col(key).alias(out_key)).agg(
        F.count(F.lit(1)).alias("total_support_tickets"),
        F.count_if(negative).alias("negative_support_tickets"),
        F.count_if(recent).alias("tickets_last_6mo"),
    )


def engagement_join(customers: DataFrame, key: str, *facts: DataFrame,
                    fill: dict | None = None) -> DataFrame:
    """Left equi-join of per-customer fact tables, missing → ``fill``.

    Each fact table is already one row per key (aggregated), so the joins are
    1:1 and cannot explode; AQE picks broadcast or sort-merge from runtime
    sizes and splits skewed partitions.
    """
    out = customers
    for f in facts:
        out = out.join(f, on=out[key] == f["customer_id"], how="left").drop(f["customer_id"])
    if fill:
        out = out.na.fill(fill)
    return out


def daily_activity(events: DataFrame, user: str = "user_id", ts: str = "ts",
                   kind: str = "event_type") -> DataFrame:
    """Per user and day — event counts by kind and an engagement score.

    score = views + 2·clicks + 5·purchases − 3·errors (a fixed weighting of
    the dbt mart described by the reference README).
    """
    k = F.col(kind)
    return events.groupBy(F.col(user).alias("user_id"),
                          F.to_date(F.col(ts)).alias("activity_date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(k == "view").alias("n_views"),
        F.count_if(k == "click").alias("n_clicks"),
        F.count_if(k == "purchase").alias("n_purchases"),
        F.count_if(k == "error").alias("n_errors"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
    ).withColumn("engagement_score",
                 F.col("n_views") + 2 * F.col("n_clicks") + 5 * F.col("n_purchases")
                 - 3 * F.col("n_errors"))


def staged_orders(orders: DataFrame) -> DataFrame:
    """Typed staging with status flags and a month key."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.date_trunc("month", F.col("o_orderdate")).cast("date").alias("order_month"),
        F.col("o_totalprice").alias("amount"),
        flag(F.col("o_orderstatus") == "F").alias("is_fulfilled"),
        flag(F.col("o_orderstatus") == "O").alias("is_open"),
        flag(F.col("o_orderstatus") == "P").alias("is_pending"),
        flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("is_priority"),
    )


def staged_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Typed customers with lower-case categories and flags."""
    j = customer.join(nation.select("n_nationkey", "n_name"), customer.c_nationkey == nation.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").alias("customer_id"), F.trim("c_name").alias("customer_name"), F.lower("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"), F.lower("n_name").alias("nation"), F.col("c_acctbal").cast("double").alias("balance"),
        flag(F.col("c_acctbal") < 0).alias("is_indebted"),
        flag(F.col("c_custkey").isNotNull() & F.col("c_acctbal").isNotNull()).alias("is_complete"))


# The codes of the reference's ticket sentiments.
SENTIMENT_CODES = {"positive": 1, "neutral": 0, "negative": -1}


def staged_tickets(tickets: DataFrame, ticket_id: str, customer: str, created: str, sentiment: Column, resolved: Column) -> DataFrame:
    """Typed tickets with a sentiment code and a resolution flag.

    Sentiments beside the three known ones get a null code; a null ``resolved`` counts as open.
    """
    s = F.lower(F.trim(sentiment))
    code = F.create_map(*[x for kv in SENTIMENT_CODES.items() for x in map(F.lit, kv)])[s]
    done = F.coalesce(resolved, F.lit(False))
    return tickets.select(
        F.col(ticket_id).alias("ticket_id"), F.col(customer).alias("customer_id"), F.to_date(created).alias("created_date"),
        F.date_trunc("month", F.col(created)).cast("date").alias("created_month"), s.alias("sentiment"), code.alias("sentiment_code"),
        flag(s == "negative").alias("is_negative"), flag(done).alias("is_resolved"), flag((s == "negative") & ~done).alias("needs_action"))
