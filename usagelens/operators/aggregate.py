"""Measures, metric queries, shares and top-n lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import expressions as E

# Aggregation name -> function of a column.
AGGREGATIONS = {
    "COUNT": F.count,
    "DISTINCT_COUNT": F.count_distinct,
    "APPROX_DISTINCT_COUNT": F.approx_count_distinct,
    "SUM": F.sum,
    "AVERAGE": F.avg,
    "MAX": F.max,
    "MIN": F.min,
}
# Aggregations of a column's distinct values alone.
DISTINCT = ("DISTINCT_COUNT", "APPROX_DISTINCT_COUNT")
DATE_COLUMN = "event_time"
GRAINS = ("DAY", "WEEK", "MONTH", "YEAR")


def measure(field: str, agg: str = "COUNT", name: str | None = None) -> Column:
    """A measure from a field and an aggregation name."""
    return AGGREGATIONS[agg](F.col(field)).alias(name or f"{field}_{agg.lower()}")


def dimension(name: str, grain: str = "DAY") -> Column:
    """A grouping column; the date column is cut to the grain."""
    if name != DATE_COLUMN:
        return F.col(name)
    cut = E.calendar_day(F.col(name)) if grain == "DAY" else F.date_trunc(grain, F.col(name)).cast("date")
    return cut.alias(grain.lower())


def metric(
    df: DataFrame,
    measures: Sequence[Column],
    dims: Sequence[str] = (),
    grain: str = "DAY",
) -> DataFrame:
    """Measures by dimensions; without dimensions, one row.

    Columns nobody asked for are pruned down to the scan. Distinct counts are
    two-step in Spark: values are made unique on the map side and shuffled by
    (group, value), so a group that holds a third of all rows is spread too.
    """
    return df.groupBy(*[dimension(d, grain) for d in dims]).agg(*measures)


def top_n(df: DataFrame, by: str, ties: Sequence[str], n: int, ascending: bool = False) -> DataFrame:
    """The ``n`` largest rows. ``ties`` must make the order total.

    Plans as TakeOrderedAndProject: each task keeps ``n`` rows.
    """
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc_nulls_last() for t in ties]).limit(n)


def sort_desc(df: DataFrame, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """Full descending sort.

    ``ties`` also serve the range partitioning: they let Spark cut inside a run
    of equal ``by`` values, which would otherwise all go to one task.
    """
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def share_of_total(grouped: DataFrame, value: str, name: str = "percentage") -> DataFrame:
    """Add each row's percentage of the column total.

    The total is a scalar subquery, not a window over everything, so no task
    ever holds all groups; Spark reuses the grouping shuffle for it.
    """
    total = grouped.agg(F.sum(value)).scalar()
    return grouped.withColumn(name, E.percent(F.col(value), total))
