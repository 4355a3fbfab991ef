"""Dataset profile operators (C4): A6-A23, O3-O6, X13, X14, X19.

Every statistic is an aggregate (partial, map-side combined) or a window over a
small aggregate; bin edges, percentiles and min/max enter per-row expressions as
scalar subqueries, never through a driver-side collect or a join of the big side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.dates import DOW_LABELS
from .quantiles import exact_quantiles, select_ranks

# Identifier and target columns of the analytics table.
ID_COLS = {"id", "trip_id", "stop_id", "end_stop_id", "segment_id", "timestamp"}
TARGET_COLS = ["target_latitude", "target_longitude"]
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude=ID_COLS) -> list[str]:
    """P10: numeric columns by dtype, minus identifier columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def columns_like(df: DataFrame, contains: str | None = None, prefix: str | None = None,
                 suffix: str | None = None) -> list[str]:
    """Columns chosen by name pattern."""
    out = []
    for c in df.columns:
        if contains is not None and contains not in c:
            continue
        if prefix is not None and not c.startswith(prefix):
            continue
        if suffix is not None and not c.endswith(suffix):
            continue
        out.append(c)
    return out


# ------------------------------------------------------------------ overview
def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def null_rates(df: DataFrame) -> DataFrame:
    """Per column null count and rate in percent (2 places), one pass."""
    from .quality import null_counts
    nc = null_counts(df)
    return nc.select("column_name", "null_count",
                     F.round(F.col("null_count") / F.col("n_rows") * 100, 2).alias("null_pct"))


# ------------------------------------------------------------------ distributions
def unpivot(df: DataFrame, cols, value: str = "x") -> DataFrame:
    """Long form (column_name, x) of the non-null values of ``cols`` (as double)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), q(c).cast("double").alias(value)) for c in cols])
    return df.select(F.inline(arr)).where(F.col(value).isNotNull())


def _binned(long: DataFrame, bins: int | Column) -> DataFrame:
    """Equal-width bins (a number, or a function of column_name) per column_name over [min, max] (numpy's widening when min == max).
    The per-column edges table has one row per column, so it is broadcast."""
    bins = bins if isinstance(bins, Column) else F.lit(bins)
    edges = long.groupBy("column_name").agg(F.min("x").alias("a0"), F.max("x").alias("b0")).select(
        "column_name",
        F.when(F.col("a0") == F.col("b0"), F.col("a0") - 0.5).otherwise(F.col("a0")).alias("a"),
        F.when(F.col("a0") == F.col("b0"), F.col("b0") + 0.5).otherwise(F.col("b0")).alias("b"))
    j = long.join(F.broadcast(edges), "column_name")
    a, b = F.col("a"), F.col("b")
    idx = F.least(F.floor((F.col("x") - a) * bins / (b - a)), bins - 1).cast("int")
    counts = j.groupBy("column_name", idx.alias("bin"), "a", "b").agg(F.count(F.lit(1)).alias("count"))
    w = (b - a) / bins
    return counts.select("column_name", "bin", (a + F.col("bin") * w).alias("bin_lo"),
                         (a + (F.col("bin") + 1) * w).alias("bin_hi"), "count")


def histogram(df: DataFrame, col, bins: int) -> DataFrame:
    """Equal-width bins over [min, max] per column; the last bin is closed.

    ``col`` is a name or a list of names; all columns are binned in one pass over the
    unpivoted values (one aggregate for the edges, one for the counts).
    """
    cols = [col] if isinstance(col, str) else list(col)
    return _binned(unpivot(df, cols), bins)


def percentiles(df: DataFrame, cols, probs) -> DataFrame:
    """(column_name, p, value) linear-interpolated percentiles (as numpy /
    quantile_cont) for several columns in one radix selection."""
    return exact_quantiles(unpivot(df, cols), "x", list(probs), keys=["column_name"])


def percentile_bounds(df: DataFrame, cols, lo_pct: float, hi_pct: float) -> DataFrame:
    """(column_name, lo, hi): the two percentiles per column."""
    lo, hi = lo_pct / 100.0, hi_pct / 100.0
    qs = percentiles(df, cols, [lo, hi])
    return qs.groupBy("column_name").agg(F.max(F.when(F.col("p") == lo, F.col("value"))).alias("lo"),
                                         F.max(F.when(F.col("p") == hi, F.col("value"))).alias("hi"))


def trim_pct(df: DataFrame, col: str, lo_pct: float = 1.0, hi_pct: float = 99.0) -> DataFrame:
    """Keep rows whose ``col`` lies within its [lo, hi] percentiles (inclusive)."""
    b = percentile_bounds(df, [col], lo_pct, hi_pct).select(F.struct("lo", "hi")).scalar()
    return df.where(q(col).isNotNull() & (q(col) >= b["lo"]) & (q(col) <= b["hi"]))


def winsorize(df: DataFrame, col: str, lo_pct: float = 2.0, hi_pct: float = 98.0, out: str | None = None) -> DataFrame:
    """Clip ``col`` to its [lo, hi] percentiles."""
    b = percentile_bounds(df, [col], lo_pct, hi_pct).select(F.struct("lo", "hi")).scalar()
    return df.withColumn(out or col, F.least(F.greatest(q(col).cast("double"), b["lo"]), b["hi"]))


def trimmed_histogram(df: DataFrame, cols, bins: int, lo_pct=1.0, hi_pct=99.0) -> DataFrame:
    """X14 + A19: per column, the histogram of the values inside its 1st-99th
    percentile; all columns share one unpivot, one quantile run and one binning pass.
    The bounds table has one row per requested column (broadcast)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    long = unpivot(df, cols)
    b = percentile_bounds(df, cols, lo_pct, hi_pct)
    kept = long.join(F.broadcast(b), "column_name").where(
        (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).select("column_name", "x")
    return _binned(kept, bins)


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 80, mincnt: int = 1) -> DataFrame:
    """Hexagonal 2-D density with the usual two-lattice construction.

    Lattice 1 has centres on integer grid points, lattice 2 on half-integer points
    (in units of sx = x-range / gridsize and sy = y-range / int(gridsize / sqrt 3));
    each point goes to the nearer centre (ties to lattice 2). Output: one row per
    non-empty cell with its centre and count (>= ``mincnt``).
    """
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    pts = df.select(q(x).cast("double").alias("px"), q(y).cast("double").alias("py")).dropna()
    mm = pts.agg(F.min("px").alias("x0"), F.max("px").alias("x1"), F.min("py").alias("y0"), F.max("py").alias("y1"))

    def nonsingular(lo: Column, hi: Column, expander=0.1):
        tiny = F.greatest(F.abs(lo), F.abs(hi)) * 1e-15
        sing = (hi - lo) <= tiny
        both0 = (lo == 0) & (hi == 0)
        lo2 = F.when(sing & both0, -expander).when(sing, lo - expander * F.abs(lo)).otherwise(lo)
        hi2 = F.when(sing & both0, expander).when(sing, hi + expander * F.abs(hi)).otherwise(hi)
        return lo2, hi2

    x0, x1 = nonsingular(F.col("x0"), F.col("x1"))
    y0, y1 = nonsingular(F.col("y0"), F.col("y1"))
    pad = (x1 - x0) * 1e-9
    geo = mm.select((x0 - pad).alias("xmin"), (x1 + pad).alias("xmax"), y0.alias("ymin"), y1.alias("ymax"))
    geo = geo.select("xmin", "ymin", ((F.col("xmax") - F.col("xmin")) / nx).alias("sx"),
                     ((F.col("ymax") - F.col("ymin")) / ny).alias("sy"))
    gs = geo.select(F.struct("xmin", "ymin", "sx", "sy")).scalar()
    g = {c: gs[c] for c in ("xmin", "ymin", "sx", "sy")}
    ix = (F.col("px") - g["xmin"]) / g["sx"]
    iy = (F.col("py") - g["ymin"]) / g["sy"]
    p = pts.select(ix.alias("ix"), iy.alias("iy"))
    ix1, iy1 = F.bround("ix", 0), F.bround("iy", 0)
    ix2, iy2 = F.floor("ix"), F.floor("iy")
    def sq(c):
        return c * c
    d1 = sq(F.col("ix") - ix1) + 3.0 * sq(F.col("iy") - iy1)
    d2 = sq(F.col("ix") - ix2 - 0.5) + 3.0 * sq(F.col("iy") - iy2 - 0.5)
    first = d1 < d2
    cell = p.select(
        F.when(first, 1).otherwise(2).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("long").alias("cx"),
        F.when(first, iy1).otherwise(iy2).cast("long").alias("cy"))
    in_range = F.when(F.col("lattice") == 1,
                      (F.col("cx") >= 0) & (F.col("cx") < nx + 1) & (F.col("cy") >= 0) & (F.col("cy") < ny + 1)
                      ).otherwise((F.col("cx") >= 0) & (F.col("cx") < nx) & (F.col("cy") >= 0) & (F.col("cy") < ny))
    counts = cell.where(in_range).groupBy("lattice", "cx", "cy").agg(F.count(F.lit(1)).alias("count"))
    off = F.when(F.col("lattice") == 1, F.lit(0.0)).otherwise(F.lit(0.5))
    return counts.where(F.col("count") >= mincnt).select(
        "lattice", "cx", "cy",
        ((F.col("cx") + off) * g["sx"] + g["xmin"]).alias("center_x"),
        ((F.col("cy") + off) * g["sy"] + g["ymin"]).alias("center_y"),
        "count")


def sample_exact(df: DataFrame, n: int, seed: int = 42, keys=("id", "timestamp")) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, reproducible under any
    partitioning: the n rows whose md5(seed:key...) come first.

    The n-th smallest hash (its first 60 bits) is found by radix selection, the rows are then
    filtered by it where they stand; only rows that share the cut hash beyond n are ordered.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[q(k).cast("string") for k in keys]))
    k = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    hashes = df.select(k.alias("_k"), k.alias("_x"))
    cut = select_ranks(hashes, [], lambda sizes: sizes.where(F.col("_n") > n).select(F.lit(n - 1).cast("long").alias("r"))).first()
    if n < 1 or cut is None:
        return df if n >= 1 else df.limit(0)
    if cut["below"] + cut["n_at"] == n:
        return df.where(k <= cut["value"])
    at_cut = df.where(k == cut["value"]).orderBy(h).limit(n - cut["below"])      # equal in 60 bits: a handful
    return df.where(k < cut["value"]).unionByName(at_cut)


def mean_center(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Mean latitude / longitude."""
    return df.agg(F.avg(lat).alias("center_lat"), F.avg(lon).alias("center_lon"))


# ------------------------------------------------------------------ categorical / temporal
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A12 + X15: counts per value after a lenient int cast (null is a group)."""
    v = F.expr(f"try_cast(`{col}` as int)")
    return df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("count")).select(
        F.lit(col).alias("column_name"), "value", "count")


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key value."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def group_stats(df: DataFrame, key: str, value: str, mean=True, std=False, med=False, band=False) -> DataFrame:
    """Mean / sample std / exact median of ``value`` per ``key`` over rows
    where both are present; ``band`` adds mean - std and mean + std."""
    d = df.select(key, value).dropna()
    aggs = []
    if mean:
        aggs.append(F.avg(value).alias("mean"))
    if std or band:
        aggs.append(F.stddev_samp(value).alias("std"))
    out = d.groupBy(key).agg(*aggs)
    if med:
        m = exact_quantiles(d, value, [0.5], keys=[key]).select(key, F.col("value").alias("median"))
        out = out.join(m, key, "left")
    if band:
        out = out.withColumns({"band_lo": F.col("mean") - F.col("std"), "band_hi": F.col("mean") + F.col("std")})
    return out


def dow_label(dow) -> Column:
    """0..6 -> Sun..Sat."""
    d = F.col(dow) if isinstance(dow, str) else dow
    return F.element_at(F.array(*[F.lit(s) for s in DOW_LABELS]), d.cast("int") + 1)


def pivot_mean(df: DataFrame, row: str, col: str, value: str, col_values) -> DataFrame:
    """A10: mean ``value`` per (row, col) as a wide table; missing cells are null."""
    d = df.select(row, col, value).dropna()
    return d.groupBy(row).pivot(col, list(col_values)).agg(F.avg(value))


def segment_summary(df: DataFrame) -> DataFrame:
    """Per segment count, mean delay, mean speed, sample std of delay."""
    return df.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("count"), F.avg("delay").alias("mean_delay"),
        F.avg("speed").alias("mean_speed"), F.stddev_samp("delay").alias("std_delay"))


def top_segments(summary: DataFrame, n: int = 20) -> DataFrame:
    """O3 + O4: top ``n`` by count (ties by segment id) with the two re-rankings."""
    top = summary.orderBy(F.desc("count"), F.asc("segment_id")).limit(n)
    w_all = Window.orderBy(F.desc("count"), F.asc("segment_id"))
    w_d = Window.orderBy(F.desc_nulls_last("mean_delay"), F.asc("segment_id"))
    w_s = Window.orderBy(F.desc_nulls_last("std_delay"), F.asc("segment_id"))
    # windows over the n-row result only (bounded by n)
    return top.select("*", F.row_number().over(w_all).alias("rank_count"),
                      F.row_number().over(w_d).alias("rank_delay"),
                      F.row_number().over(w_s).alias("rank_std"))


# ------------------------------------------------------------------ correlation
def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r; null for fewer than 2 rows or zero variance (no ANSI divide error)."""
    den = F.stddev_pop(x) * F.stddev_pop(y)
    const = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    return F.when((F.count(x) >= 2) & ~const, F.covar_pop(x, y) / F.nullif(den, F.lit(0.0)))


def lag_target_corr(df: DataFrame, targets=TARGET_COLS) -> DataFrame:
    """Each ``_lag_`` column against both targets over pairwise-complete rows,
    all in one aggregate; features with fewer than 2 complete rows are skipped."""
    lags = columns_like(df, contains="_lag_")
    aggs = []
    for i, c in enumerate(lags):
        ok = q(c).isNotNull() & q(targets[0]).isNotNull() & q(targets[1]).isNotNull()
        xc = F.when(ok, q(c).cast("double"))
        aggs += [F.count(xc).alias(f"n{i}"),
                 safe_corr(xc, F.when(ok, q(targets[0]))).alias(f"a{i}"),
                 safe_corr(xc, F.when(ok, q(targets[1]))).alias(f"b{i}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}, a{i}, b{i}" for i, c in enumerate(lags))
    long = one.selectExpr(f"stack({len(lags)}, {stack}) as (feature, n, r_target_lat, r_target_lon)")
    return long.where(F.col("n") >= 2).drop("n")


def comoments(df: DataFrame, cols, by=()) -> DataFrame:
    """(by..., n, mean, cross, lo, hi) over the rows without a null in ``cols``: the number of rows, the columns' means,
    their centred cross sums (row by row of the lower triangle) and their bounds, as arrays.

    Each task reduces its rows batch by batch; the partial results are merged in two steps (the
    usual update for means and centred sums), so no task gets more than a share of them, and nothing is computed
    before the frame is used.
    """
    by, k = list(by), len(cols)
    low = np.tril_indices(k)
    names = [f"c{i}" for i in range(k)]
    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*by).schema)
    state = "n long, mean array<double>, cross array<double>, lo array<double>, hi array<double>"

    def merged(parts: pd.DataFrame) -> list:
        n = parts["n"].to_numpy(dtype=float)
        means, total = np.vstack(parts["mean"]), n.sum()
        mean = (n[:, None] * means).sum(0) / total
        off = means - mean
        cross = np.vstack(parts["cross"]).sum(0) + ((off * n[:, None]).T @ off)[low]
        return [int(total), mean, cross, np.vstack(parts["lo"]).min(0), np.vstack(parts["hi"]).max(0)]

    columns = [*by, "part", "n", "mean", "cross", "lo", "hi"]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        part = TaskContext.get().partitionId() % 64        # a retried task repeats it
        for b in batches:
            for key, rows in (b.groupby(by, dropna=False, sort=False) if by else [((), b)]):
                x = rows[names].to_numpy(dtype=float)
                mean = x.mean(0)
                d = x - mean
                own = [len(x), mean, (d.T @ d)[low], x.min(0), x.max(0)]
                key = tuple(None if pd.isna(v) else v for v in key)
                held[key] = merged(pd.DataFrame([held[key], own], columns=columns[-5:])) if key in held else own
            if len(held) > 1000:
                yield pd.DataFrame([[*key, part, *own] for key, own in held.items()], columns=columns)
                held = {}
        if held:
            yield pd.DataFrame([[*key, part, *own] for key, own in held.items()], columns=columns)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[*rows[by].iloc[0], *merged(rows)]], columns=[*by, *columns[-5:]])

    values = df.select(*[q(c) for c in by], *[q(c).cast("double").alias(n) for c, n in zip(cols, names)]).dropna(subset=names)
    parts = values.mapInPandas(partial, f"{kind}part int, {state}")
    once = parts.groupBy(*by, "part").applyInPandas(merge, f"{kind}{state}")
    return once.groupBy(*by).applyInPandas(merge, f"{kind}{state}")


def corr_matrix(df: DataFrame, cols=None, by=()) -> DataFrame:
    """Pearson matrix over listwise-complete rows, lower triangle (col_a after
    col_b in column order), for each group of ``by``.

    One lazy co-moment aggregate; its size is bounded by the number of columns. Pairs with a column that is
    constant (min = max) or of a single row get null rather than a division by (almost) zero.
    """
    cols = list(cols or numeric_columns(df))
    m = comoments(df, cols, by)
    pairs = F.array(*[F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), F.lit(i).alias("i"), F.lit(j).alias("j"))
                      for i in range(len(cols)) for j in range(i)])
    if len(cols) < 2:
        pairs = pairs.cast("array<struct<col_a:string,col_b:string,i:int,j:int>>")
    each = m.select(*by, "n", "cross", "lo", "hi", F.explode(pairs).alias("p")).select("*", "p.*")
    i, j = F.col("i"), F.col("j")
    cell = lambda a, b: F.get("cross", (a * (a + 1) / 2 + b).cast("int"))
    same = lambda a: F.get("lo", a) == F.get("hi", a)
    r = F.when((F.col("n") >= 2) & ~same(i) & ~same(j), cell(i, j) / F.nullif(F.sqrt(cell(i, i) * cell(j, j)), F.lit(0.0)))
    return each.select(*by, "col_a", "col_b", F.when(~F.isnan(r), r).alias("r"))


def target_slice(matrix: DataFrame, targets=TARGET_COLS) -> DataFrame:
    """Every feature's r against each target, ranked by r ascending."""
    a = matrix.where(F.col("col_b").isin(targets) & ~F.col("col_a").isin(targets)).select(
        F.col("col_a").alias("feature"), F.col("col_b").alias("target"), "r")
    b = matrix.where(F.col("col_a").isin(targets) & ~F.col("col_b").isin(targets)).select(
        F.col("col_b").alias("feature"), F.col("col_a").alias("target"), "r")
    s = a.unionByName(b)
    w = Window.partitionBy("target").orderBy(F.asc_nulls_first("r"), "feature")
    return s.withColumn("rank", F.row_number().over(w))


def moments(df: DataFrame, cols) -> DataFrame:
    """A15 without quartiles: (column_name, count, null_count, mean, std, min, max), one aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.count_if(x.isNull()).alias(f"z{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', c{i}, z{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, count, null_count, mean, std, min, max)")


def describe(df: DataFrame, cols=None, quartiles: str = "nearest") -> DataFrame:
    """Count, null_count, mean, std, min, 25/50/75%, max per numeric column.

    Moments in one aggregate; quartiles exact (``nearest`` rank by default, or
    ``linear``) by radix selection over the unpivoted columns.
    """
    cols = cols or numeric_columns(df)
    mom = moments(df, cols)
    qs = exact_quantiles(unpivot(df, cols), "x", [0.25, 0.5, 0.75], keys=["column_name"], method=quartiles)
    wide = qs.groupBy("column_name").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value")).toDF(
        "column_name", "q25", "q50", "q75")
    return mom.join(wide, "column_name", "left").select(
        "column_name", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")
