"""Column exclusion and content opt-in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions import masking


def restricted_view(df: DataFrame, name: str, excluded=schemas.SENSITIVE) -> DataFrame:
    """Expose a table without some columns. A view, not an access control."""
    open_part = df.drop(*excluded)
    open_part.createOrReplaceTempView(name)
    return open_part


def mask_columns(df: DataFrame, columns, names: list[str] | None = None) -> DataFrame:
    """Mask sensitive patterns in the given text columns."""
    return df.withColumns({c: masking.mask(F.col(c), names) for c in columns})
