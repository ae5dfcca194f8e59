"""Computing a costly expression once.

Parsing JSON is the dearest step of the ingest. The optimizer copies an
expression wherever its column is used in a filter, and evaluates the copies
apart. These two helpers give a value a name that cannot be copied.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.transform(F.array(value), use)[0]


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator.

    Filters on them stay above it, so they do not repeat the work. The outer
    form keeps the optimizer from deriving a filter from the generator's input.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))
