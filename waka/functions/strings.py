"""String column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment_id(start, end) -> Column:
    """X6: 'start-end'; null when either side is null (``concat`` propagates nulls,
    unlike ``concat_ws``)."""
    return F.concat(_c(start).cast("string"), F.lit("-"), _c(end).cast("string"))


def split_trim(s) -> Column:
    """Comma-separated list -> array of trimmed items."""
    return F.transform(F.split(_c(s).cast("string"), ","), lambda x: F.trim(x))
