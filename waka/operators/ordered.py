"""Neighbour features over an ordered group (W1-W5), one plan for groups of any size.

For each row of a group (``keys``), in a total order (``order``, unique per group):
  ``{k}_lag_{c}``     value k rows back,
  ``{n}_lag_{c}_avg`` mean of the current and n-1 previous values (nulls skipped),
  ``{k}_lead_{c}``    value k rows ahead.

A plain window partitioned by the group puts a whole group into one task. Here the rows are
range-partitioned and sorted by (keys, order): the cut points are quantiles of the data itself, so a
hot group, or a burst of rows at one instant, is cut like any other stretch of the order. Each
partition then gets the rows it lacks: the last rows before it and the first rows behind it, as
many as the widest look-back and look-ahead (from several partitions, where one holds fewer). The
window runs per (partition, group) over own and carried rows, and the carried rows are dropped. What
is carried grows with the number of partitions, not of rows.

The sorted rows are stored once with their places, so that all readers see the same cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

PARTITIONS: int | None = None      # of the sorted rows; None leaves the number to the session
PLACE = "_place"                   # partition << 33 | row within it
_BITS = 33


def stored_in_order(df: DataFrame, keys, order, partitions: int | None = None, name: str = "ordered") -> DataFrame:
    """``df`` sorted by (keys, order) over range partitions and stored, with each row's PLACE."""
    cols = [F.col(f"`{c}`") for c in [*keys, *order]]
    n = partitions or PARTITIONS
    ranged = df.repartitionByRange(*([n] if n else []), *cols)
    return materialize(ranged.sortWithinPartitions(*cols).withColumn(PLACE, F.monotonically_increasing_id()), name)


def _features(w, lags, means, leads, lag_cols, mean_cols, lead_cols) -> dict[str, Column]:
    out = {f"{k}_lag_{c}": F.lag(c, k).over(w) for k in lags for c in lag_cols}
    out |= {f"{n}_lag_{c}_avg": F.avg(F.col(c).cast("double")).over(w.rowsBetween(-(n - 1), 0)) for n in means for c in mean_cols}
    return out | {f"{k}_lead_{c}": F.lead(c, k).over(w) for k in leads for c in lead_cols}


def with_carried_rows(rows: DataFrame, back: int, ahead: int) -> DataFrame:
    """Stored rows with ``_part`` and ``_own``: each partition's rows, and copies (``_own`` false) of the
    ``back`` rows before it and the ``ahead`` rows behind it in the whole order."""
    part, pos = F.shiftright(PLACE, _BITS), F.col(PLACE).bitwiseAND((1 << _BITS) - 1)
    own = rows.withColumn("_part", part)
    sizes = own.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # one row per partition
    spans = sizes.select(F.col("_part").alias("_p"), "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    spans = materialize(spans, "ordered_spans")
    lacks = F.concat(*[F.transform(F.sequence(F.lit(1), F.lit(k)), f) if k else F.array().cast("array<bigint>")
                       for k, f in ((back, lambda i: F.col("_first") - i), (ahead, lambda i: F.col("_first") + F.col("_n") - 1 + i))])
    wanted = spans.select(F.col("_p").alias("_to"), F.explode(lacks).alias("_no"))
    edges = (own.join(F.broadcast(spans), F.col("_part") == F.col("_p"))
             .where((pos < ahead) | (pos >= F.col("_n") - back)).withColumn("_at", F.col("_first") + pos))
    carried = edges.join(wanted, F.col("_at") == F.col("_no")).select(
        *[F.col(f"`{c}`") for c in rows.columns], F.col("_to").alias("_part"), F.lit(False).alias("_own"))
    return own.withColumn("_own", F.lit(True)).unionByName(carried)


def trip_day_neighbours(df: DataFrame, keys, order, cols, lags=(1,), means=(), leads=(),
                        lag_cols=None, mean_cols=None, lead_cols=None, partitions: int | None = None) -> DataFrame:
    """``df`` with the features. A frame from ``stored_in_order`` (same keys and order) isn't stored again."""
    lag_cols = cols if lag_cols is None else lag_cols
    mean_cols = cols if mean_cols is None else mean_cols
    lead_cols = cols if lead_cols is None else lead_cols
    keys, order = list(keys), list(order)
    rows = df if PLACE in df.columns else stored_in_order(df, keys, order, partitions)
    back, ahead = max([*lags, *[n - 1 for n in means], 0]), max([*leads, 0])
    whole = with_carried_rows(rows, back, ahead)
    w = Window.partitionBy("_part", *keys).orderBy(*order)
    got = whole.withColumns(_features(w, lags, means, leads, lag_cols, mean_cols, lead_cols))
    return got.where("_own").drop("_own", "_part", PLACE)
