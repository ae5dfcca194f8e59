"""Five standing reports over the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import expressions as E
from usagelens.operators import aggregate


def daily_adoption(chat_activity: DataFrame) -> DataFrame:
    """Active users and sessions per day, latest day first."""
    return (
        chat_activity.groupBy(E.calendar_day(F.col("event_time")).alias("day"))
        .agg(
            F.count_distinct("user_name").alias("active_users"),
            F.count_distinct("conversation_id").alias("sessions"),
        )
        .orderBy(F.col("day").desc_nulls_last())
    )


def satisfaction(feedback_analysis: DataFrame) -> DataFrame:
    """Responses per satisfaction label and their percentage of all."""
    counts = feedback_analysis.groupBy("satisfaction").agg(F.count(F.lit(1)).alias("count"))
    return aggregate.share_of_total(counts, "count")


def hours_by_service(agent_hours_usage: DataFrame) -> DataFrame:
    return (
        agent_hours_usage.groupBy("service", "usage_group")
        .agg(F.sum("hours").alias("total_hours"), F.count_distinct("user_name").alias("users"))
        .orderBy(F.col("total_hours").desc_nulls_last(), "service", "usage_group")
    )


def api_activity(api_audit_trail: DataFrame) -> DataFrame:
    return (
        api_audit_trail.groupBy("api_feature", "read_or_write")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "api_feature", "read_or_write")
    )


def largest_sources(index_usage: DataFrame) -> DataFrame:
    return (
        index_usage.groupBy("source_name", "source_type")
        .agg(
            F.max("consumed_index_size_gb").alias("total_index_size_gb"),
            F.max("consumed_source_size_gb").alias("source_size_gb"),
            F.max("consumed_source_doc_count").alias("doc_count"),
        )
        .orderBy(F.col("source_size_gb").desc_nulls_last(), "source_name", "source_type")
    )
