"""Registered queries: dataset profile (C4) over the training sets of all weeks."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import profile as pr
from ..operators.tables import table_state
from ..oracle import with_views
from . import catalog_features as cf
from ..session import compiled_methods, materialize
from .registry import register, round_doubles

# Fixed values of the profile (as in the analysis being reproduced).
FEATURES = ["speed", "delay", "bearing", "departure_delay", "departure_uncertainty"]
CATEGORICAL = ["occupancy_status", "direction_id", "day_of_week", "obs_hour", "obs_minute"]
SAMPLE_SCATTER, SAMPLE_MAP, SEED = 10_000, 8_000, 42
TOP_N = 20
HIST_BINS, AVG_HIST_BINS, HEX_GRID = 80, 60, 80

TRAIN_COLS = (fe.GENERIC_COLUMNS + fe.avg_column_names() + fe.lag_column_names()
              + ["target_longitude", "target_latitude"])
NUMERIC_COLS = [c for c in TRAIN_COLS if c not in pr.ID_COLS]  # every training column but ids is numeric
VALID4 = ["target_latitude", "target_longitude", "delay", "obs_hour"]


_STORED: dict = {}


def train(spark, sf):
    """The analytics table the profile reads: the training sets of all weeks, stored under the shared checkpoint
    folder and read by every profile query of the application (as the stored table would be). It is built again when a file
    of the locations has changed."""
    seen = table_state(spark, sf, "events")
    key = (spark.sparkContext.applicationId, sf)
    if _STORED.get(key, (None,))[0] != seen:
        with compiled_methods(spark):
            _STORED[key] = (seen, materialize(cf.training_of_all_weeks(spark, sf), "analytics_data"))
    return _STORED[key][1]


def dq(c: str) -> str:
    return f'"{c}"'


def sql(body: str) -> str:
    return with_views(*cf.VIEWS, extra=cf.ALL_WEEKS_CTES) + f", tr as materialized ({cf.ALL_WEEKS_SQL})\n{body}"


def r6(e: str) -> str:
    return f"round({e}, 6)"


# ------------------------------------------------------------------ overview
NULL_SQL = " union all ".join(
    f"select '{c}' column_name, count(*) - count({dq(c)}) null_count, "
    f"round((count(*) - count({dq(c)})) / count(*) * 100, 2) null_pct from tr" for c in TRAIN_COLS)


@register("A14_null_rates", sql(NULL_SQL))
def a14(spark, sf):
    return pr.null_rates(train(spark, sf)).orderBy(F.desc("null_pct"), "column_name")


@register("A23_shape", sql(f"select count(*) n_rows, {len(TRAIN_COLS)} n_cols from tr"))
def a23(spark, sf):
    return pr.shape(train(spark, sf))


# ------------------------------------------------------------------ histograms
def hist_sql(src: str, col: str, bins: int) -> str:
    """Histogram of column ``x`` of CTE-expression ``src`` (same arithmetic as Spark)."""
    return f"""select '{col}' column_name, bin, a + bin * ((b - a) / {bins}) bin_lo, a + (bin + 1) * ((b - a) / {bins}) bin_hi,
        count(*) count from (
      select cast(least(floor((x - a) * {bins} / (b - a)), {bins - 1}) as int) bin, a, b from ({src}) v,
        (select case when min(x) = max(x) then min(x) - 0.5 else min(x) end a,
                case when min(x) = max(x) then max(x) + 0.5 else max(x) end b from ({src}) s) e
      where x >= a and x <= b) h group by bin, a, b"""


VALID4_SQL = " and ".join(f"{dq(c)} is not null" for c in VALID4)


@register("A19_histogram_targets", sql(" union all ".join(
    hist_sql(f"select cast({dq(c)} as double) x from tr where {VALID4_SQL}", c, HIST_BINS)
    for c in ["target_latitude", "target_longitude"])))
def a19(spark, sf):
    v = train(spark, sf).select(*VALID4).dropna()
    return pr.histogram(v, ["target_latitude", "target_longitude"], HIST_BINS)


def trimmed_src(col: str, lo=0.01, hi=0.99) -> str:
    return f"""select cast({dq(col)} as double) x from tr,
        (select quantile_cont({dq(col)}, {lo}) plo, quantile_cont({dq(col)}, {hi}) phi from tr where {dq(col)} is not null) p
        where {dq(col)} is not null and {dq(col)} >= plo and {dq(col)} <= phi"""


@register("X14_trimmed_feature_histograms", sql(" union all ".join(
    hist_sql(trimmed_src(c), c, HIST_BINS) for c in FEATURES)))
def x14(spark, sf):
    return pr.trimmed_histogram(train(spark, sf), FEATURES, HIST_BINS)


@register("A19_segment_avg_histograms", sql(" union all ".join(
    hist_sql(trimmed_src(c), c, AVG_HIST_BINS) for c in fe.avg_column_names())))
def a19_avg(spark, sf):
    t = train(spark, sf)
    cols = [c for c in pr.columns_like(t, suffix="_avg") if any(c.startswith(p + "_") for p, _ in fe.AVG_GRAINS)]
    return pr.trimmed_histogram(t, cols, AVG_HIST_BINS)


@register("A22_percentiles", sql(" union all ".join(
    [f"select '{c}' column_name, {p} p, {r6(f'quantile_cont({dq(c)}, {p})')} value from tr"
     for c in FEATURES for p in (0.01, 0.99)]
    + [f"select 'delay' column_name, {p} p, {r6(f'quantile_cont(delay, {p})')} value from tr" for p in (0.02, 0.98)])))
def a22(spark, sf):
    t = train(spark, sf)
    a = pr.percentiles(t, FEATURES, [0.01, 0.99])
    b = pr.percentiles(t, ["delay"], [0.02, 0.98])
    return round_doubles(a.unionByName(b))


# ------------------------------------------------------------------ hexbin
def hexbin_sql() -> str:
    nx, ny = HEX_GRID, int(HEX_GRID / math.sqrt(3))

    def ns(lo, hi, side):
        sing = f"({hi} - {lo}) <= greatest(abs({lo}), abs({hi})) * 1e-15"
        both0 = f"({lo} = 0 and {hi} = 0)"
        if side == "lo":
            return f"case when {sing} and {both0} then -0.1 when {sing} then {lo} - 0.1 * abs({lo}) else {lo} end"
        return f"case when {sing} and {both0} then 0.1 when {sing} then {hi} + 0.1 * abs({hi}) else {hi} end"

    return f"""
, hx_pts as (select cast(target_longitude as double) px, cast(target_latitude as double) py from tr where {VALID4_SQL}),
hx_mm as (select min(px) x0, max(px) x1, min(py) y0, max(py) y1 from hx_pts),
hx_ns as (select {ns('x0', 'x1', 'lo')} a0, {ns('x0', 'x1', 'hi')} a1, {ns('y0', 'y1', 'lo')} b0, {ns('y0', 'y1', 'hi')} b1 from hx_mm),
hx_geo as (select a0 - (a1 - a0) * 1e-9 xmin, a1 + (a1 - a0) * 1e-9 xmax, b0 ymin, b1 ymax from hx_ns),
hx_g2 as (select xmin, ymin, (xmax - xmin) / {nx} sx, (ymax - ymin) / {ny} sy from hx_geo),
hx_ij as (select (px - xmin) / sx ix, (py - ymin) / sy iy, xmin, ymin, sx, sy from hx_pts, hx_g2),
hx_c as (select *, round_even(ix, 0) ix1, round_even(iy, 0) iy1, floor(ix) ix2, floor(iy) iy2 from hx_ij),
hx_d as (select *, (ix - ix1) * (ix - ix1) + 3.0 * ((iy - iy1) * (iy - iy1)) d1,
              (ix - ix2 - 0.5) * (ix - ix2 - 0.5) + 3.0 * ((iy - iy2 - 0.5) * (iy - iy2 - 0.5)) d2 from hx_c),
hx_e as (select case when d1 < d2 then 1 else 2 end lattice,
             cast(case when d1 < d2 then ix1 else ix2 end as bigint) cx,
             cast(case when d1 < d2 then iy1 else iy2 end as bigint) cy, xmin, ymin, sx, sy from hx_d)
select lattice, cx, cy, (cx + case when lattice = 1 then 0.0 else 0.5 end) * sx + xmin center_x,
       (cy + case when lattice = 1 then 0.0 else 0.5 end) * sy + ymin center_y, count(*) count
from hx_e where case when lattice = 1 then cx >= 0 and cx < {nx + 1} and cy >= 0 and cy < {ny + 1}
                  else cx >= 0 and cx < {nx} and cy >= 0 and cy < {ny} end
group by lattice, cx, cy, xmin, ymin, sx, sy having count(*) >= 1"""


@register("A20_hexbin_density", sql(hexbin_sql()))
def a20(spark, sf):
    v = train(spark, sf).select(*VALID4).dropna()
    return round_doubles(pr.hexbin(v, "target_longitude", "target_latitude", HEX_GRID, 1), 9)


# ------------------------------------------------------------------ samples
def sample_sql(n: int, cols: str) -> str:
    return f"""select {cols} from tr where {VALID4_SQL}
        order by md5(concat_ws(':', '{SEED}', cast(id as varchar), cast("timestamp" as varchar))) limit {n}"""


@register("O6_seeded_sample", sql(sample_sql(SAMPLE_SCATTER, 'id, "timestamp", target_latitude, target_longitude, delay, obs_hour')))
def o6(spark, sf):
    t = train(spark, sf).select("id", "timestamp", *VALID4).dropna(subset=VALID4)
    return pr.sample_exact(t, SAMPLE_SCATTER, SEED)


@register("A21_mean_center", sql(f"""select {r6('avg(target_latitude)')} center_lat, {r6('avg(target_longitude)')} center_lon
    from ({sample_sql(SAMPLE_MAP, 'target_latitude, target_longitude')}) s"""))
def a21(spark, sf):
    t = train(spark, sf).select("id", "timestamp", *VALID4).dropna(subset=VALID4)
    return round_doubles(pr.mean_center(pr.sample_exact(t, SAMPLE_MAP, SEED), "target_latitude", "target_longitude"))


@register("X13_winsorized_delay", sql(f"""
, s as ({sample_sql(SAMPLE_SCATTER, 'id, "timestamp", delay')}),
b as (select quantile_cont(delay, 0.02) lo, quantile_cont(delay, 0.98) hi from s)
select id, "timestamp", {r6('least(greatest(cast(delay as double), lo), hi)')} delay_clipped from s, b"""))
def x13(spark, sf):
    t = train(spark, sf).select("id", "timestamp", *VALID4).dropna(subset=VALID4)
    s = pr.sample_exact(t, SAMPLE_SCATTER, SEED).select("id", "timestamp", "delay")
    return round_doubles(pr.winsorize(s, "delay", 2.0, 98.0, out="delay_clipped").drop("delay"))


# ------------------------------------------------------------------ categorical / temporal
@register("A12_value_counts", sql(" union all ".join(
    f"select '{c}' column_name, try_cast({dq(c)} as int) value, count(*) count from tr group by 2" for c in CATEGORICAL)))
def a12(spark, sf):
    t = train(spark, sf)
    out = None
    for c in CATEGORICAL:
        v = pr.value_counts(t, c)
        out = v if out is None else out.unionByName(v)
    return out.orderBy("column_name", "value")


@register("A6_count_by_hour", sql("select obs_hour, count(*) n from tr group by obs_hour"))
def a6(spark, sf):
    return pr.count_by(train(spark, sf), "obs_hour")


@register("A7_delay_by_hour", sql(f"""select obs_hour, {r6('avg(delay)')} mean, {r6('stddev_samp(delay)')} std,
    {r6('quantile_cont(delay, 0.5)')} median, {r6('avg(delay) - stddev_samp(delay)')} band_lo,
    {r6('avg(delay) + stddev_samp(delay)')} band_hi
    from tr where obs_hour is not null and delay is not null group by obs_hour"""))
def a7(spark, sf):
    return round_doubles(pr.group_stats(train(spark, sf), "obs_hour", "delay", std=True, med=True, band=True)
                         .select("obs_hour", "mean", "std", "median", "band_lo", "band_hi"))


@register("A8_speed_by_hour", sql(f"""select obs_hour, {r6('avg(speed)')} mean, {r6('stddev_samp(speed)')} std
    from tr where obs_hour is not null and speed is not null group by obs_hour"""))
def a8(spark, sf):
    return round_doubles(pr.group_stats(train(spark, sf), "obs_hour", "speed", std=True))


@register("A9_delay_by_weekday", sql(f"""select day_of_week, {r6('avg(delay)')} mean, {r6('quantile_cont(delay, 0.5)')} median,
    ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week + 1] label
    from tr where day_of_week is not null and delay is not null group by day_of_week"""))
def a9(spark, sf):
    g = pr.group_stats(train(spark, sf), "day_of_week", "delay", med=True)
    return round_doubles(g.withColumn("label", pr.dow_label("day_of_week")).select("day_of_week", "mean", "median", "label"))


@register("A10_pivot_delay_dow_hour", sql("select day_of_week, " + ", ".join(
    f"{r6(f'avg(delay) filter (where obs_hour = {h})')} {dq(str(h))}" for h in range(24))
    + " from tr where obs_hour is not null and day_of_week is not null and delay is not null group by day_of_week"))
def a10(spark, sf):
    return round_doubles(pr.pivot_mean(train(spark, sf), "day_of_week", "obs_hour", "delay", range(24)))


SEG_SQL = f"""select segment_id, count(*) count, {r6('avg(delay)')} mean_delay, {r6('avg(speed)')} mean_speed,
    {r6('stddev_samp(delay)')} std_delay from tr group by segment_id"""


@register("A11_segment_summary", sql(SEG_SQL))
def a11(spark, sf):
    return round_doubles(pr.segment_summary(train(spark, sf)))


@register("O3_O4_top_segments", sql(f"""
, top as (select * from ({SEG_SQL}) s order by count desc, segment_id limit {TOP_N})
select *, row_number() over (order by count desc, segment_id) rank_count,
       row_number() over (order by mean_delay desc nulls last, segment_id) rank_delay,
       row_number() over (order by std_delay desc nulls last, segment_id) rank_std from top"""))
def o3(spark, sf):
    return pr.top_segments(round_doubles(pr.segment_summary(train(spark, sf))), TOP_N)


@register("A13_distinct_counts", sql("""select count(distinct segment_id) n_segments,
    count(distinct (id, "timestamp")) n_keys, count(distinct trip_id) n_trips from tr"""))
def a13(spark, sf):
    t = train(spark, sf)
    return t.agg(F.count_distinct("segment_id").alias("n_segments"),
                 F.count_distinct("id", "timestamp").alias("n_keys"), F.count_distinct("trip_id").alias("n_trips"))


# ------------------------------------------------------------------ correlation
def corr_sql(x: str, y: str) -> str:
    return (f"case when count({x}) >= 2 and not (min({x}) = max({x}) or min({y}) = max({y})) "
            f"then covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0) end")


LAGS = fe.lag_column_names()


LAG_CORR_SQL = " union all ".join(
    f"""select '{c}' feature, {r6(corr_sql('x', 'a'))} r_target_lat, {r6(corr_sql('x', 'b'))} r_target_lon from (
        select cast({dq(c)} as double) x, target_latitude a, target_longitude b from tr
        where {dq(c)} is not null and target_latitude is not null and target_longitude is not null) q
        having count(*) >= 2""" for c in LAGS)


@register("A16_lag_target_corr", sql(LAG_CORR_SQL))
def a16(spark, sf):
    return round_doubles(pr.lag_target_corr(train(spark, sf))).orderBy(F.desc("r_target_lat"), "feature")


def _matrix_parts() -> tuple[str, str]:
    cols = NUMERIC_COLS
    body = "select " + ", ".join(f"cast({dq(c)} as double) c{i}" for i, c in enumerate(cols)) + " from tr where " + \
        " and ".join(f"{dq(c)} is not null" for c in cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    agg = "select " + ", ".join(f"{r6(corr_sql(f'c{i}', f'c{j}'))} r{i}_{j}" for i, j in pairs) + " from cc"
    sel = " union all ".join(f"select '{cols[i]}' col_a, '{cols[j]}' col_b, r{i}_{j} r from cagg" for i, j in pairs)
    return f", cc as materialized ({body}), cagg as materialized ({agg})\n", sel


_CC, _PAIRS = _matrix_parts()


@register("A17_corr_matrix", sql(_CC + _PAIRS))
def a17(spark, sf):
    return round_doubles(pr.corr_matrix(train(spark, sf), NUMERIC_COLS))


TARGET_SLICE_SQL = """
select *, row_number() over (partition by target order by r asc nulls first, feature) rank from (
  select col_a feature, col_b target, r from m where col_b in ('target_latitude', 'target_longitude')
    and col_a not in ('target_latitude', 'target_longitude')
  union all select col_b, col_a, r from m where col_a in ('target_latitude', 'target_longitude')
    and col_b not in ('target_latitude', 'target_longitude')) s"""


@register("A18_target_corr_slice", sql(_CC + f", m as materialized ({_PAIRS})" + TARGET_SLICE_SQL))
def a18(spark, sf):
    # stored: the slice reads the matrix twice, and its pairs are planned with neither reading
    return pr.target_slice(materialize(round_doubles(pr.corr_matrix(train(spark, sf), NUMERIC_COLS)), "target_correlations"))


def _describe_sql() -> str:
    cols = NUMERIC_COLS
    mom = " union all ".join(
        f"select '{c}' column_name, count({dq(c)}) count, count(*) - count({dq(c)}) null_count, "
        f"{r6(f'avg(cast({dq(c)} as double))')} mean, {r6(f'stddev_samp(cast({dq(c)} as double))')} std, "
        f"cast(min({dq(c)}) as double) min, cast(max({dq(c)}) as double) max from tr" for c in cols)
    unp = " union all ".join(f"select '{c}' column_name, cast({dq(c)} as double) v from tr where {dq(c)} is not null"
                             for c in cols)
    return f"""
, mom as ({mom}),
u as ({unp}),
rk as (select column_name, v, row_number() over (partition by column_name order by v) - 1 rn,
       count(*) over (partition by column_name) n from u),
qq as (select column_name,
       max(v) filter (where rn = cast(round((n - 1) * 0.25) as bigint)) q25,
       max(v) filter (where rn = cast(round((n - 1) * 0.5) as bigint)) q50,
       max(v) filter (where rn = cast(round((n - 1) * 0.75) as bigint)) q75 from rk group by column_name)
select mom.column_name, count, null_count, mean, std, min, q25, q50, q75, max
from mom left join qq using (column_name)"""


@register("A15_describe", sql(_describe_sql()))
def a15(spark, sf):
    d = pr.describe(train(spark, sf), NUMERIC_COLS, quartiles="nearest")
    return round_doubles(d, only={"mean", "std"})


@register("P10_numeric_columns", sql("select " + ", ".join(dq(c) for c in NUMERIC_COLS) + " from tr"))
def p10(spark, sf):
    t = train(spark, sf)
    return t.select(*[pr.q(c) for c in pr.numeric_columns(t)])


@register("P11_drop_incomplete", sql(f"select id, \"timestamp\", {', '.join(VALID4)} from tr where {VALID4_SQL}"))
def p11(spark, sf):
    return train(spark, sf).select("id", "timestamp", *VALID4).dropna(subset=VALID4)


@register("P9_columns_by_pattern", sql("select " + ", ".join(
    f"count({dq(c)}) {dq(c)}" for c in LAGS + [c for c in fe.avg_column_names() if c.startswith('global_')]) + " from tr"))
def p9(spark, sf):
    t = train(spark, sf)
    chosen = pr.columns_like(t, contains="_lag_") + pr.columns_like(t, prefix="global_", suffix="_avg")
    return t.agg(*[F.count(pr.q(c)).alias(c) for c in chosen])


@register("X12_horizontal_mean", sql("""
select id, "timestamp", round((coalesce(global_speed_avg, 0) + coalesce(daily_speed_avg, 0)
       + coalesce(monthly_speed_avg, 0) + coalesce(hourly_speed_avg, 0))
       / nullif((global_speed_avg is not null)::int + (daily_speed_avg is not null)::int
       + (monthly_speed_avg is not null)::int + (hourly_speed_avg is not null)::int, 0), 9) speed_avg_mean from tr"""))
def x12(spark, sf):
    from ..functions.stats import mean_horizontal
    t = train(spark, sf)
    m = mean_horizontal(*[f"{p}_speed_avg" for p, _ in fe.AVG_GRAINS])
    # inputs carry 6 decimals, so the mean of four is exact at 8: rounding at 9 only
    # removes float noise and never lands on a tie
    return t.select("id", "timestamp", F.round(m, 9).alias("speed_avg_mean"))
