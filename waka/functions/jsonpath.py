"""JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path_or_flat(v, path: str, flat: str, type_: str, default=None) -> Column:
    """Value at a nested path, else at a flat name, else ``default``."""
    x = F.col(v) if isinstance(v, str) else v
    out = F.coalesce(F.try_variant_get(x, path, type_), F.try_variant_get(x, f"$.{flat}", type_))
    return out if default is None else F.coalesce(out, F.lit(default))


def number_from_text(c, type_: str = "double") -> Column:
    """A number carried either as JSON number or as text ("270" -> 270.0)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.trim(x.cast("string")).try_cast(type_)


def envelope_attributes(df: DataFrame, col: str, attr_schema: str, id_col: str = "id") -> DataFrame:
    """Single-record envelopes ``{"data": {"type", "id", "attributes": {...}}}`` -> rows."""
    schema = f"data struct<type: string, id: string, attributes: struct<{attr_schema}>>"
    p = df.select(F.from_json(col, schema).alias("d"))
    return p.select(F.col("d.data.id").alias(id_col), F.col("d.data.type").alias("record_type"), "d.data.attributes.*")
