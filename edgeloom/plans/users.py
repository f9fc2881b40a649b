"""Visitors and customers: funnels, intent, personas, churn, conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import classify as C
from edgeloom.functions.exprs import TS, instant, n_where, pct, since, span
from edgeloom.operators.enrich import flag
from edgeloom.operators.sessions import sessionize

# --- fixed values: pages of the sign-up funnel, in order -------------------------------
FUNNEL = [
    ("started_signup", "/signup"),
    ("verified", "/signup/verify-email"),
    ("payment", "/signup/payment"),
    ("converted", "/signup/complete"),
]
# --------------------------------------------------------------------------------------


def signup_funnel(logs: DataFrame, as_of, window="1 hour") -> DataFrame:
    """Visitors per step and the rate from each step to the next."""
    per_user = (
        since(logs, as_of, window, inclusive=True)
        .groupBy("user_id")
        .agg(*[F.max(flag(F.col("req_path") == page)).alias(step) for step, page in FUNNEL])
    )
    step = {name: F.sum(name) for name, _ in FUNNEL}
    return per_user.agg(
        F.count(F.lit(1)).alias("total_visitors"),
        *[total.alias(name) for name, total in step.items()],
        pct(step["verified"], step["started_signup"]).alias("signup_to_verify_rate"),
        pct(step["payment"], step["verified"]).alias("verify_to_payment_rate"),
        pct(step["converted"], step["payment"]).alias("payment_to_complete_rate"),
    )


def high_intent_users(
    logs: DataFrame, as_of, window="7 days", gap="30 minutes",
    min_sessions=3, min_views=10, min_cart=1, min_avg_seconds=120, seen_within="24 hours",
) -> DataFrame:
    path = F.col("req_path")
    sessions = sessionize(
        since(logs, as_of, window, inclusive=True),
        gap=gap,
        sums={
            "views": flag(path.like("%/products/%")),
            "cart": flag(path.like("%/cart%")),
        },
    )
    return (
        sessions.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("views").alias("product_views"),
            F.sum("cart").alias("cart_actions"),
            F.avg("duration_seconds").alias("avg_session_duration"),
            F.max("session_end").alias("last_seen"),
        )
        .filter(
            (F.col("sessions") >= min_sessions)
            & (F.col("product_views") >= min_views)
            & (F.col("cart_actions") >= min_cart)
            & (F.col("avg_session_duration") > min_avg_seconds)
            & (F.col("last_seen") >= instant(as_of) - span(seen_within))
        )
    )


def user_behavior(logs: DataFrame, as_of, window="30 days", gap="30 minutes") -> DataFrame:
    """Per visitor: visits, time spent, cart additions."""
    sessions = sessionize(
        since(logs, as_of, window, inclusive=True),
        gap=gap,
        sums={"cart": flag(F.col("req_path").like("%/cart%"))},
    )
    return sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("visit_frequency"),
        F.avg("duration_seconds").alias("avg_session"),
        F.sum("duration_seconds").alias("time_on_site"),
        F.sum("cart").alias("cart_adds"),
    )


def user_personas(
    logs: DataFrame, as_of, window="30 days", gap="30 minutes",
    power=(10, 300), buyer=(5, 3), bounce_seconds=60, casual=(2, 5),
) -> DataFrame:
    """Persona and preferences per visitor. A tie between preferences goes to the lowest
    value. ``mode`` keeps a count per distinct label, and labels are few."""
    visits = F.col("visit_frequency")
    persona = (
        F.when((visits > power[0]) & (F.col("avg_session") > power[1]), "Power User")
        .when((visits > buyer[0]) & (F.col("cart_adds") > buyer[1]), "Frequent Buyer")
        .when((visits == 1) & (F.col("time_on_site") < bounce_seconds), "Bouncer")
        .when(visits.between(*casual), "Casual Browser")
        .otherwise("New Visitor")
    )
    preferences = (
        since(logs, as_of, window, inclusive=True)
        .select("user_id", C.content_class().alias("c"), C.device_class().alias("d"), F.hour(TS).alias("h"))
        .groupBy("user_id")
        .agg(
            F.mode("c", True).alias("most_viewed_category"),
            F.mode("d", True).alias("preferred_device_type"),
            F.mode("h", True).alias("preferred_hour"),
        )
    )
    return (
        user_behavior(logs, as_of, window, gap)
        .withColumn("persona", persona)
        .join(preferences, "user_id")
        .select(
            "user_id", "persona", "visit_frequency", "cart_adds",
            "most_viewed_category", "preferred_device_type", "preferred_hour",
        )
    )


def churn_risk(
    logs: DataFrame, as_of, gap="30 minutes", support: DataFrame | None = None,
    min_visits_90d=5, min_score=50,
) -> DataFrame:
    """Linear risk score of active visitors.

    ``support`` may bring (user_id, support_tickets_count, last_nps_score); without it
    those two parts add nothing.
    """
    recent = F.col("session_start") >= instant(as_of) - span("30 days")
    users = (
        sessionize(since(logs, as_of, "90 days", inclusive=True), gap=gap)
        .groupBy("user_id")
        .agg(
            F.max("session_end").alias("last_seen"),
            n_where(recent).alias("visit_frequency_30d"),
            F.count(F.lit(1)).alias("visit_frequency_90d"),
            F.avg("duration_seconds").alias("avg_session_duration"),
        )
        .withColumn("days_since_last_visit", F.datediff(instant(as_of), "last_seen"))
        .filter(F.col("visit_frequency_90d") > min_visits_90d)
    )
    if support is None:
        users = users.withColumns(
            {"support_tickets_count": F.lit(0), "last_nps_score": F.lit(None).cast("int")}
        )
    else:
        users = users.join(support, "user_id", "left")
    # Weights: fixed values.
    score = (
        F.col("days_since_last_visit") * 2
        + F.coalesce(F.lit(20.0) / F.nullif(F.col("visit_frequency_30d"), F.lit(0)), F.lit(0.0))
        + F.when(F.col("avg_session_duration") < 30, 20).otherwise(0)
        + F.coalesce(F.col("support_tickets_count"), F.lit(0)) * 5
        + F.when(F.col("last_nps_score") < 5, 30).otherwise(0)
    )
    return (
        users.withColumn("churn_risk_score", score)
        .filter(F.col("churn_risk_score") > min_score)
        .select(
            "user_id", "days_since_last_visit", "visit_frequency_30d", "visit_frequency_90d",
            "avg_session_duration", "churn_risk_score",
        )
        .orderBy(F.desc("churn_risk_score"), "user_id")
    )


def _customers_with_orders(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer with order count and value; orders shrink before the join."""
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value")
    )
    return customer.join(per_customer, "c_custkey", "left")


def _conversion(per_key: DataFrame) -> DataFrame:
    ordered = n_where(F.col("n") > 0)
    return per_key.agg(
        F.count(F.lit(1)).alias("unique_users"),
        F.sum("n").alias("orders"),
        (F.sum("value").cast("double") / F.nullif(F.sum("n"), F.lit(0))).alias("avg_cart"),
        pct(ordered, F.count(F.lit(1))).alias("conversion_rate"),
    )


def tier_conversion(customer: DataFrame, orders: DataFrame) -> DataFrame:
    return _conversion(_customers_with_orders(customer, orders).groupBy(F.col("c_mktsegment").alias("user_tier")))


def regional_analytics(customer: DataFrame, orders: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    return _conversion(_customers_with_orders(customer, orders).join(places, "c_nationkey").groupBy("region"))
