"""Filters and drill-down a dashboard reader applies to a dataset."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.operators import aggregate
from usagelens.sources import snapshots


def time_range(
    df: DataFrame, now: dt.datetime, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Rows between two times, both ends included; rows without a time stay.

    By default from the start of ``now``'s year until ``now``.
    """
    start = start or dt.datetime(now.year, 1, 1)
    at = F.col(aggregate.DATE_COLUMN)
    return df.filter(at.isNull() | at.between(_ntz(start), _ntz(end or now)))


def last_days(df: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Rows of the ``days`` before ``as_of``; the default span of a report."""
    at = F.col(aggregate.DATE_COLUMN)
    return df.filter((at >= _ntz(as_of - dt.timedelta(days=days))) & (at <= _ntz(as_of)))


def snapshot_time_range(
    spark: SparkSession, path: str, schema: T.StructType, now: dt.datetime, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """:func:`time_range` over a snapshot: opens the folders of its days and of the rows without a time only."""
    start, end = start or dt.datetime(now.year, 1, 1), end or now
    return time_range(snapshots.read(spark, path, schema, start.date(), end.date()), now, start, end)


def snapshot_last_days(spark: SparkSession, path: str, schema: T.StructType, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """:func:`last_days` over a snapshot: opens the folders of its days only."""
    start = as_of - dt.timedelta(days=days)
    return last_days(snapshots.read(spark, path, schema, start.date(), as_of.date(), undated=False), as_of, days)


def _ntz(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def category(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose column is one of the values."""
    return df.filter(F.col(column).isin(*values))


def click_through(details: DataFrame, selected: Mapping[str, object], grain: str = "DAY") -> DataFrame:
    """Detail rows behind one clicked data point, NULL points included."""

    def match(name: str, value: object) -> Column:
        column = aggregate.dimension(name, grain)
        return column.isNull() if value is None else column.eqNullSafe(F.lit(value))

    return details.filter(reduce(Column.__and__, [match(k, v) for k, v in selected.items()]))


def click_through_many(details: DataFrame, selection: DataFrame) -> DataFrame:
    """Detail rows behind a table of selected points.

    A semi join on the shared columns. No broadcast is forced: the runtime picks
    it when the selection measures small, and splits skewed keys when not.
    """
    rows, picked = details.alias("d"), selection.alias("s")
    on = reduce(
        Column.__and__, [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in selection.columns]
    )
    return rows.join(picked, on, "left_semi")


# Aggregation name -> its partial states (of a column, and of states), and the result from merged states.
STATES = {
    "COUNT": ({"n": (F.count, F.sum)}, lambda n: n),
    "SUM": ({"total": (F.sum, F.sum)}, lambda total: total),
    "AVERAGE": ({"total": (F.sum, F.sum), "n": (F.count, F.sum)}, lambda total, n: F.try_divide(total, n)),
    "MAX": ({"largest": (F.max, F.max)}, lambda largest: largest),
    "MIN": ({"smallest": (F.min, F.min)}, lambda smallest: smallest),
}


def drill_down(
    df: DataFrame, path: Sequence[str], column: str, agg: str, name: str, grain: str = "DAY"
) -> DataFrame:
    """Every level of a drill path at once, with ``level`` 0 for the total.

    A level's rows have the columns below it NULL; ``level`` tells such a NULL
    from one in the data. A rollup repeats its input once per level, so the rows
    are first reduced to the finest level: to its distinct values for a distinct
    count (a sketch of them is one of all rows), else to the partial states that
    ``STATES`` lists, which every level merges and finishes.
    """
    keys = [aggregate.dimension(c, grain) for c in path]
    names = [grain.lower() if c == aggregate.DATE_COLUMN else c for c in path]
    value = F.col(column).alias("_value")
    if agg in aggregate.DISTINCT:
        finest = df.select(*keys, value).distinct()
        total = aggregate.AGGREGATIONS[agg]("_value")
    else:
        parts, finish = STATES[agg]
        finest = df.groupBy(*keys).agg(*[make(F.col(column)).alias(f"_{part}") for part, (make, _) in parts.items()])
        total = finish(**{part: merge(F.col(f"_{part}")) for part, (_, merge) in parts.items()})
    depth = F.lit(len(names)) - F.bit_count(F.grouping_id())
    return finest.rollup(*names).agg(depth.cast("int").alias("level"), total.alias(name))
