"""Metrics and findings a usage report must bring.

Each takes the dataset it reads. Every one aggregates first; windows, joins and
ranks run on the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions import expressions as E
from usagelens.operators import aggregate, trend

# --- fixed values -------------------------------------------------------------
USEFUL = "Useful"
EXTRA = "Extra"
# --- end of fixed values ------------------------------------------------------


def _failed() -> Column:
    return E.is_present(F.col("error_code"))


def top_users(df: DataFrame, measure: Column, name: str, n: int = 10) -> DataFrame:
    """The ``n`` users with the largest measure."""
    return aggregate.top_n(df.groupBy("user_name").agg(measure.alias(name)), name, ["user_name"], n)


def feature_extremes(df: DataFrame, feature: str, n: int = 10) -> DataFrame:
    """The ``n`` most and the ``n`` least used features."""
    uses = df.groupBy(feature).agg(F.count(F.lit(1)).alias("uses"))

    def side(label: str, ascending: bool) -> DataFrame:
        return aggregate.top_n(uses, "uses", [feature], n, ascending).select(F.lit(label).alias("side"), "*")

    return side("most", False).unionByName(side("least", True))


def period_change(df: DataFrame, measure: Column, name: str, grain: str) -> DataFrame:
    """A measure per week or month, the period before, and the change in percent."""
    period = grain.lower()
    totals = df.groupBy(aggregate.dimension(aggregate.DATE_COLUMN, grain)).agg(measure.alias(name))
    changed = trend.change(totals.filter(F.col(period).isNotNull()), period, name, grain)
    return changed.withColumn("change_percent", E.percent(F.col("change"), F.nullif("previous", F.lit(0))))


def latency(chat: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    return chat.groupBy(*dims).agg(
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.avg("time_to_first_token_ms").alias("avg_time_to_first_token_ms"),
        F.count("latency_ms").alias("measured"),
    )


def latency_percentiles(chat: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Median and 95th percentile, by a mergeable sketch of bounded size."""
    both = F.percentile_approx("latency_ms", F.array(F.lit(0.5), F.lit(0.95)))
    return (
        chat.groupBy(*dims)
        .agg(both.alias("_p"))
        .select(*dims, F.col("_p")[0].alias("p50_latency_ms"), F.col("_p")[1].alias("p95_latency_ms"))
    )


def overage(hours: DataFrame, dims: Sequence[str] = ("service",)) -> DataFrame:
    """Extra hours and their share of all hours."""
    extra = F.sum(F.when(F.col("usage_group") == EXTRA, F.col("hours")).otherwise(0.0))
    return hours.groupBy(*dims).agg(
        F.sum("hours").alias("total_hours"),
        extra.alias("extra_hours"),
        F.try_divide(extra, F.sum("hours")).alias("overage_share"),
    )


def satisfaction_score(feedback: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    useful = F.count_if(F.col("feedback_type") == USEFUL)
    return feedback.groupBy(*dims).agg(
        F.count("feedback_type").alias("responses"),
        useful.alias("useful"),
        F.try_divide(useful, F.count("feedback_type")).alias("score"),
    )


def reason_themes(feedback: DataFrame) -> DataFrame:
    """Reasons by how often they come, split by satisfaction."""
    reasons = feedback.filter(F.col("reason").isNotNull())
    return reasons.groupBy("reason", "feedback_type").agg(F.count(F.lit(1)).alias("responses"))


def error_rate(audit: DataFrame, dims: Sequence[str] = ("api_feature",)) -> DataFrame:
    return audit.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(_failed()).alias("errors"),
        F.avg(_failed().cast("int")).alias("error_rate"),
    )


def failure_patterns(audit: DataFrame, n: int = 10) -> DataFrame:
    """The most common (action, error) pairs."""
    pairs = audit.filter(_failed()).groupBy("api_action", "error_code").agg(F.count(F.lit(1)).alias("errors"))
    return aggregate.top_n(pairs, "errors", ["api_action", "error_code"], n)


def source_days(index_usage: DataFrame) -> DataFrame:
    """One row per source and day: its largest totals of that day."""
    return index_usage.groupBy(
        "source_arn", "source_name", "source_type", E.calendar_day(F.col("event_time")).alias("day")
    ).agg(
        F.max("consumed_source_size_gb").alias("source_size_gb"),
        F.max("consumed_source_doc_count").alias("doc_count"),
    )


def latest_sources(index_usage: DataFrame) -> DataFrame:
    """Each source's totals on the last day it was measured."""
    last = F.max(F.struct("day", "source_size_gb", "doc_count"))
    return (
        source_days(index_usage)
        .groupBy("source_arn", "source_name", "source_type")
        .agg(last.alias("_last"))
        .select("source_arn", "source_name", "source_type", "_last.*")
    )


def storage_by_type(index_usage: DataFrame) -> DataFrame:
    """Current storage per source type: every source once, at its last size."""
    exact = F.sum(F.col("source_size_gb").cast("decimal(38,4)")).cast("double")
    return (
        latest_sources(index_usage)
        .groupBy("source_type")
        .agg(exact.alias("size_gb"), F.count(F.lit(1)).alias("sources"))
    )


def document_growth(index_usage: DataFrame) -> DataFrame:
    """Documents per source and day, and the growth since the measurement before.

    A source has one row per day here, whatever its number of documents.
    """
    by_day = Window.partitionBy("source_arn", "source_name", "source_type").orderBy("day")
    return (
        source_days(index_usage)
        .withColumn("previous_docs", F.lag("doc_count").over(by_day))
        .select("source_name", "day", "doc_count", "previous_docs")
        .withColumn("growth", F.col("doc_count") - F.col("previous_docs"))
    )


def underused(df: DataFrame, feature: str, below: float) -> DataFrame:
    """Features whose share of all uses is under a threshold."""
    uses = df.groupBy(feature).agg(F.count(F.lit(1)).alias("uses"))
    total = uses.agg(F.sum("uses")).scalar()
    return uses.withColumn("share", F.col("uses") / total).filter(F.col("share") < below)


def latency_drift(chat: DataFrame, span: int = 7) -> DataFrame:
    """Average latency per day against the days before it."""
    days = (
        chat.groupBy(aggregate.dimension("event_time"))
        .agg(F.sum("latency_ms").alias("latency_sum"), F.count("latency_ms").alias("measured"))
        .filter(F.col("day").isNotNull())
    )
    return trend.trailing_ratio(days, "day", "latency_sum", "measured", span)


def error_drift(audit: DataFrame, span: int = 7) -> DataFrame:
    """Error rate per day against the days before it."""
    days = error_rate(audit.select(aggregate.dimension("event_time"), "error_code"), ["day"])
    return trend.trailing_ratio(
        days.filter(F.col("day").isNotNull()).drop("error_rate"), "day", "errors", "calls", span
    )


def index_size_by_day(index_usage: DataFrame) -> DataFrame:
    """The index total per day. It repeats on every source row, so it is not summed."""
    return index_usage.groupBy(aggregate.dimension("event_time")).agg(
        F.max("consumed_index_size_gb").alias("index_size_gb")
    )


def current_index_size(index_usage: DataFrame) -> DataFrame:
    """The index total of the last measured day."""
    days = index_size_by_day(index_usage).filter(F.col("day").isNotNull())
    return days.orderBy(F.col("day").desc()).limit(1)


def power_users(chat: DataFrame, at_least: float = 0.9) -> DataFrame:
    """Users whose session count is above that of a given part of the others."""
    users = chat.groupBy("user_name").agg(F.count_distinct("conversation_id").alias("sessions"))
    ranked = trend.share_at_or_above(users.filter(F.col("user_name").isNotNull()), "user_name", "sessions")
    return ranked.filter(F.col("percent_rank") >= at_least)


def near_limit(index_usage: DataFrame, limit_gb: float, from_share: float = 0.8) -> DataFrame:
    """Sources whose current size has reached a share of the storage limit."""
    used = F.col("source_size_gb") / F.lit(limit_gb)
    return (
        latest_sources(index_usage)
        .select("source_name", "source_type", "source_size_gb", used.alias("used_share"))
        .filter(F.col("used_share") >= from_share)
    )


def idle_sources(
    index_usage: DataFrame, audit: DataFrame, min_docs: int, max_calls_per_doc: float
) -> DataFrame:
    """Sources with many documents that few audit events touch.

    Both sides are one row per source before they meet. The join carries no
    broadcast hint: its sides grow with the number of sources, so the runtime
    decides by their measured size.
    """
    calls = (
        audit.filter(E.is_present(F.col("resource_arn")))
        .groupBy(F.col("resource_arn").alias("source_arn"))
        .agg(F.count(F.lit(1)).alias("_calls"))
    )
    return (
        latest_sources(index_usage)
        .filter(F.col("doc_count") >= min_docs)
        .join(calls, "source_arn", "left")
        .select("source_name", "doc_count", F.coalesce("_calls", F.lit(0)).alias("calls"))
        .withColumn("calls_per_doc", F.col("calls") / F.col("doc_count"))
        .filter(F.col("calls_per_doc") <= max_calls_per_doc)
    )


def web_search_usage(chat: DataFrame) -> DataFrame:
    return chat.groupBy("web_search").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("conversation_id").alias("sessions"),
        F.count_distinct("user_name").alias("users"),
    )


def regional_calls(audit: DataFrame) -> DataFrame:
    return error_rate(audit, ["aws_region"])
