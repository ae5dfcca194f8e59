"""Ingest and label quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_report(routed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Records per fate, optionally per day of arrival."""
    return routed.groupBy(*by, "result").agg(F.count(F.lit(1)).alias("records"))


def unparseable(table: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Rows whose text is there but does not read as its type: one row per column.

    ``texts`` maps a column to the type it should hold. All columns are counted
    in one pass.
    """
    bad = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in texts.items()
    ]
    pairs = ", ".join(f"'{c}', `{c}`" for c in texts)
    return table.agg(*bad).selectExpr(f"stack({len(texts)}, {pairs}) AS (column_name, bad_rows)")


def outside_domain(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Labels that are not in the known domain, and how many rows carry each.

    The domain is a short stated list, so the check is a filter on the grouped
    labels: no join.
    """
    labels = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return labels.filter(~F.col(column).isin(*known))
