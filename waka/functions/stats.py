"""Row-wise numeric helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_horizontal(*cols) -> Column:
    """Mean of the given columns within a row, nulls skipped; null if all are null."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs])
    count = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cs])
    return total / F.nullif(count, F.lit(0))
