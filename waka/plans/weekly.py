"""The weekly training set, as a frame and as one job that ends in the stored table.

P6 + J7 + X8 (the matched locations) are stored once, sorted by trip-day and time: the segment averages
and the neighbour pass read the stored rows. ``run_week`` then does the rest of the job:

* the training set is staged once, by week of the year; the same pass observes the row count and the
  nulls of every column (Q2); the rows beyond the first of each (id, timestamp) are counted on the
  staged keys (Q1), so that the whole rows are neither shuffled nor sorted for it;
* a duplicate key aborts the job before anything is published (Q1); columns with many nulls are
  reported (Q2);
* the staged rows replace the stored rows of their keys (K3). Only the touched weeks are read; the
  staged folder becomes part of the table as it is, and the stored rows that stay are written beside
  it. The new version is published last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import local_time
from ..operators import features as fe
from ..operators import quality as qa
from ..operators import versions as vs
from ..operators.ordered import stored_in_order
from ..session import compiled_methods, scratch_path

TABLE = "analytics_data"
KEYS = ["id", "timestamp", "obs_year"]
NULL_THRESHOLD = 0.40


def build_training_set(locations: DataFrame, trip_segments: DataFrame, segments: DataFrame, week_start=None,
                       tz: str = "UTC", check_keys: bool = False, present=None) -> DataFrame:
    """The training set of one week; without ``week_start`` that of every week, each with the averages of
    its own locations, as if the weekly job had run for each (the week is one more grouping key). ``present``
    is applied to the table of the averages."""
    matched = fe.matched_locations(locations, trip_segments, segments, week_start, tz)
    by = []
    if week_start is None:
        matched, by = matched.withColumn("week", F.date_trunc("week", local_time("timestamp", tz)).cast("date")), ["week"]
    ts = fe.training_set(stored_in_order(matched, fe.TRIP_DAY, fe.ORDER, name="matched"), by=by, present=present)
    if check_keys:
        qa.assert_unique(ts, ["id", "timestamp"], "training_set")
    return ts


@dataclass
class WeekReport:
    version: int
    rows: int
    replaced_parts: list[str]
    null_counts: dict[str, int]

    def high_nulls(self, threshold: float = NULL_THRESHOLD) -> list[tuple[str, int, float]]:
        """Q2: (column, nulls, rate) of the columns whose null rate is strictly above the threshold."""
        return [(c, n, n / self.rows) for c, n in self.null_counts.items() if self.rows and n / self.rows > threshold]


def stage(training: DataFrame, folder: str, tz: str = "UTC") -> tuple[dict, WeekReport]:
    """Write the training set by year and week; Q2 comes from the same pass, Q1 from the staged keys. Raises on a repeated (id, timestamp)."""
    spark = training.sparkSession
    week = F.date_format(F.date_trunc("week", local_time("timestamp", tz)), "yyyy-MM-dd")
    seen = Observation("weekly_training_set")
    names = training.columns
    rows = (training.withColumn("_part", F.concat_ws("w", F.col("obs_year"), week))
            .observe(seen, F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls{i}") for i, c in enumerate(names)]))
    with compiled_methods(spark):
        parts = vs.write_parts(rows, "_part", folder)
    got = seen.get
    staged = [p for paths in parts.values() for p in paths]
    copies = 0
    if staged:
        repeated = qa.duplicate_keys(spark.read.schema(training.schema).parquet(*staged), ["id", "timestamp"])
        copies = repeated.agg(F.sum(F.col("n") - 1)).first()[0] or 0
    if copies:
        raise ValueError(f"training_set contains {copies:,} duplicate ('id', 'timestamp') rows; aborting write")
    return parts, WeekReport(0, got["rows"], sorted(parts), {c: got[f"nulls{i}"] for i, c in enumerate(names)})


def upsert_week(spark: SparkSession, root: str, training: DataFrame, tz: str = "UTC") -> WeekReport:
    """Q1, Q2 and K3 for a built training set; see the module's text."""
    seen = vs.current(spark, root)
    parts, report = stage(training, scratch_path(spark, "training_set"), tz)
    schema = training.schema.json()
    changes = {k: list(v) for k, v in parts.items()}
    stored = seen["tables"].get(TABLE, {"parts": {}})["parts"]
    touched = [k for k in parts if k in stored]
    if touched:
        old = vs.read_parts(spark, seen, TABLE, touched)
        new = spark.read.schema(training.schema).parquet(*[p for k in touched for p in parts[k]])
        week = F.date_format(F.date_trunc("week", local_time("timestamp", tz)), "yyyy-MM-dd")
        kept = old.join(new.select(*KEYS), KEYS, "left_anti").withColumn("_part", F.concat_ws("w", F.col("obs_year"), week))
        for k, paths in vs.write_parts(kept, "_part", scratch_path(spark, "kept_rows")).items():
            changes[k] += paths
    state = vs.publish(spark, root, seen, {TABLE: {"schema": schema, "parts": changes}})
    report.version = state["version"]
    return report


def run_week(spark: SparkSession, root: str, locations: DataFrame, trip_segments: DataFrame, segments: DataFrame,
             week_start, tz: str = "UTC") -> WeekReport:
    """The weekly job: from the locations to the published table."""
    return upsert_week(spark, root, build_training_set(locations, trip_segments, segments, week_start, tz), tz)


def stored_training_set(spark: SparkSession, root: str) -> DataFrame:
    return vs.read_parts(spark, vs.current(spark, root), TABLE)
