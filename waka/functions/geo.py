"""Geographic column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(lon, lat) -> Column:
    """A point as struct<lon, lat> (the stored geography column)."""
    return F.struct(_c(lon).cast("double").alias("lon"), _c(lat).cast("double").alias("lat"))


def point_wkt(lon, lat) -> Column:
    """The point rendered as WKT 'POINT(lon lat)' (shortest exact decimal text)."""
    return F.concat(F.lit("POINT("), _c(lon).cast("string"), F.lit(" "), _c(lat).cast("string"), F.lit(")"))
