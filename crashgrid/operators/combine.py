"""Calendar reindex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def reindex(dim: DataFrame, values: DataFrame, on: str, order_col: str) -> DataFrame:
    """Ordered-label reindex: every label of ``dim`` in ``dim`` order, values from
    ``values`` or null when a label is absent; labels not in ``dim`` are dropped.
    ``dim`` is a small fixed dimension (days, seasons, months)."""
    return (
        dim.join(values, on=on, how="left")
        .orderBy(F.col(order_col).asc())
        .drop(order_col)
    )
