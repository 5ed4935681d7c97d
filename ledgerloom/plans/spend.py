"""Spend roll-ups over metered usage.  All money is DECIMAL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import DEFAULT_RATE_NOTE, DEFAULT_RATE_USD, Params, rate_table


def spend_daily(spark: SparkSession, usage: DataFrame, p: Params) -> DataFrame:
    """Usage rows priced by service; a service without a price gets the default one."""
    rate = F.coalesce("usd_per_credit", F.lit(DEFAULT_RATE_USD)).cast("decimal(6,2)")
    return (
        usage.filter(F.col("credits_used") > 0)
        .join(rate_table(spark, p), "service_type", "left")
        .select(
            "usage_date",
            "service_type",
            F.coalesce("rate_note", F.lit(DEFAULT_RATE_NOTE)).alias("rate_note"),
            F.round("credits_used", 6).cast("decimal(18,6)").alias("credits"),
            rate.alias("usd_per_credit"),
            F.round(F.col("credits_used").cast("decimal(18,6)") * rate, 4).cast("decimal(18,4)").alias("usd"),
        )
    )


def spend_summary(daily: DataFrame, p: Params) -> DataFrame:
    budget = F.lit(p.budget_usd).cast("decimal(12,2)")
    total, days = F.col("total_usd"), F.col("active_days")
    return daily.agg(
        F.sum("usd").cast("decimal(18,4)").alias("total_usd"), F.count_distinct("usage_date").alias("active_days")
    ).select(
        budget.alias("trial_budget_usd"),
        F.round(total, 2).cast("decimal(18,2)").alias("spent_usd"),
        F.round(budget - total, 2).cast("decimal(18,2)").alias("remaining_usd"),
        F.round(F.lit(100).cast("decimal(3,0)") * total / budget, 1).cast("decimal(12,1)").alias("pct_used"),
        "active_days",
        F.round(total / F.nullif(days.cast("decimal(10,0)"), F.lit(0)), 2).cast("decimal(18,2)").alias(
            "usd_per_active_day"
        ),
    )


def spend_by_category(daily: DataFrame) -> DataFrame:
    """Credits and dollars per service with the share of all spend (few rows)."""
    grouped = daily.groupBy("service_type", "rate_note").agg(
        F.sum("credits").cast("decimal(18,6)").alias("_credits"), F.sum("usd").cast("decimal(18,4)").alias("_usd")
    )
    total = F.sum("_usd").over(W.partitionBy()).cast("decimal(18,4)")
    pct = F.lit(100).cast("decimal(3,0)") * F.col("_usd") / F.nullif(total, F.lit(0))
    return grouped.select(
        "service_type",
        "rate_note",
        F.round("_credits", 4).cast("decimal(18,4)").alias("credits"),
        F.round("_usd", 2).cast("decimal(18,2)").alias("usd"),
        F.round(pct, 1).cast("decimal(6,1)").alias("pct_of_spend"),
    ).orderBy(F.desc("usd"), "service_type")


def text_spend_by_tag(usage: DataFrame) -> DataFrame:
    tag = F.coalesce(F.nullif(F.col("query_tag"), F.lit("")), F.lit("(untagged)"))
    credits = F.sum("token_credits").cast("decimal(18,6)")
    return usage.groupBy(tag.alias("query_tag"), "function_name", "model_name").agg(
        F.sum("tokens").alias("tokens"),
        F.round(credits, 6).cast("decimal(18,6)").alias("ai_credits"),
        F.round(credits * F.lit(DEFAULT_RATE_USD).cast("decimal(6,2)"), 4).cast("decimal(18,4)").alias("usd"),
    )


def budget_crossings(usage: DataFrame, p: Params) -> DataFrame:
    """First day of each month on which the running credits reach a share of the quota.

    The running sum is over days, of which a month has at most 31.
    """
    daily = usage.groupBy("usage_date").agg(F.sum("credits_used").cast("decimal(18,6)").alias("credits"))
    month = F.date_trunc("month", F.col("usage_date")).cast("date")
    along = W.partitionBy("usage_month").orderBy("usage_date").rowsBetween(W.unboundedPreceding, 0)
    running = daily.withColumn("usage_month", month).withColumn(
        "running_credits", F.sum("credits").over(along).cast("decimal(18,6)")
    )
    quota = F.lit(p.credit_quota).cast("decimal(12,2)")
    steps = running.withColumn("threshold_pct", F.explode(F.array(*[F.lit(x) for x in p.quota_pcts])))
    reached = F.col("running_credits") * 100 >= quota * F.col("threshold_pct")
    return (
        steps.filter(reached)
        .groupBy("usage_month", "threshold_pct")
        .agg(
            F.min("usage_date").alias("crossed_on"),
            F.min("running_credits").alias("credits_at_crossing"),
        )
    )
