"""Change between periods and drift against a trailing window.

Input is always aggregated to periods first, so a window holds at most one row
per period of a group: its size is bounded by the calendar, not by the data.
Frames count calendar periods, not rows, so a gap never passes for a neighbour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH_MONDAY = "1970-01-05"


def _period_index(period: Column, grain: str) -> Column:
    if grain == "MONTH":
        return F.year(period) * 12 + F.month(period)
    days = F.datediff(period, F.lit(_EPOCH_MONDAY).cast("date"))
    return F.floor(days / 7).cast("int") if grain == "WEEK" else days


def change(periods: DataFrame, period: str, value: str, grain: str, dims: Sequence[str] = ()) -> DataFrame:
    """Add ``previous`` (the period just before, NULL if absent) and ``change``."""
    frame = Window.partitionBy(*dims).orderBy(_period_index(F.col(period), grain)).rangeBetween(-1, -1)
    return periods.withColumn("previous", F.max(value).over(frame)).withColumn(
        "change", F.col(value) - F.col("previous")
    )


def trailing_ratio(
    days: DataFrame, day: str, numerator: str, denominator: str, span: int = 7, dims: Sequence[str] = ()
) -> DataFrame:
    """Add a day's ``ratio``, that of the ``span`` days before it, and the ``drift``.

    The trailing ratio weighs days by their size: sums are divided, not averages
    averaged.
    """
    frame = (
        Window.partitionBy(*dims).orderBy(_period_index(F.col(day), "DAY")).rangeBetween(-span, -1)
    )
    ratio = F.try_divide(F.col(numerator), F.col(denominator))
    before = F.try_divide(F.sum(numerator).over(frame), F.sum(denominator).over(frame))
    return (
        days.withColumn("ratio", ratio)
        .withColumn("trailing_ratio", before)
        .withColumn("drift", F.col("ratio") - F.col("trailing_ratio"))
    )


def share_at_or_above(groups: DataFrame, key: str, value: str) -> DataFrame:
    """Add ``percent_rank``: the part of the other rows with a smaller value.

    Ranking all rows in one window would put them in one task. Here rows are
    first counted per distinct value. ``value`` counts events, so N events allow
    at most about sqrt(2N) distinct values: a trillion events, 1.4 million. The
    running count over those is taken in two levels (within a block of 1,024
    values, then over blocks), and rows look their value up. The join is left to
    the runtime, which broadcasts a table it has measured to be small and
    otherwise splits hot values.
    """
    histogram = groups.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    block = F.shiftright(F.col(value), 10)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    by_block = (
        histogram.groupBy(block.alias("_block"))
        .agg(F.sum("_n").alias("_in_block"))
        .withColumn("_blocks_below", F.sum("_in_block").over(before.orderBy("_block")))
    )
    ranked = (
        histogram.withColumn("_block", block)
        .withColumn("_below", F.sum("_n").over(before.partitionBy("_block").orderBy(value)))
        .join(by_block, "_block")
        .select(
            value,
            (F.coalesce("_below", F.lit(0)) + F.coalesce("_blocks_below", F.lit(0))).alias("_smaller"),
        )
    )
    others = histogram.agg(F.sum("_n") - 1).scalar()
    rank = F.coalesce(F.try_divide(F.col("_smaller"), others), F.lit(0.0))
    return groups.join(ranked, value).withColumn("percent_rank", rank).select(*groups.columns, "percent_rank")
