"""Hot-group neighbour features equal the plain window result."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waka.operators import ordered
from waka.operators.ordered import trip_day_neighbours


def _plain(df, keys, order, cols):
    w = Window.partitionBy(*keys).orderBy(*order)
    new = {}
    for c in cols:
        new[f"1_lag_{c}"] = F.lag(c, 1).over(w)
    for n in (5, 10):
        for c in cols:
            new[f"{n}_lag_{c}_avg"] = F.avg(F.col(c).cast("double")).over(w.rowsBetween(-(n - 1), 0))
    for c in cols:
        new[f"1_lead_{c}"] = F.lead(c, 1).over(w)
    return df.withColumns(new)


@pytest.mark.parametrize("partitions", [1, 8, 60, 400])
def test_hot_groups_match_plain_window(spark, partitions):
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame({
        "g": rng.choice(["hot", "hot", "hot", "a", "b"], n),     # one group holds most rows
        "timestamp": rng.integers(0, 400, n),                    # ties on time, bursts, gaps
        "id": np.arange(n),
        "v": np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n)),
    })
    pdf.loc[pdf.index % 50 == 0, "timestamp"] = 5                # a burst at one instant
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    got = trip_day_neighbours(df, ["g"], ["timestamp", "id"], ["v"], lags=(1,), means=(5, 10), leads=(1,),
                              partitions=partitions)
    want = _plain(df, ["g"], ["timestamp", "id"], ["v"])
    cols = ["g", "timestamp", "id", "1_lag_v", "5_lag_v_avg", "10_lag_v_avg", "1_lead_v"]
    a = got.select(*cols).toPandas().sort_values("id").reset_index(drop=True)
    b = want.select(*cols).toPandas().sort_values("id").reset_index(drop=True)
    assert len(a) == n
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12, atol=1e-12)


def test_burst_at_one_instant_is_split(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.lit(5).alias("timestamp"), F.col("id"))
    stored = ordered.stored_in_order(df, ["g"], ["timestamp", "id"], partitions=16)
    sizes = [r["count"] for r in stored.groupBy(F.shiftright(ordered.PLACE, 33)).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000
    got = trip_day_neighbours(stored, ["g"], ["timestamp", "id"], ["id"], lags=(3,), leads=(2,)).toPandas()
    got = got.sort_values("id").reset_index(drop=True)
    assert got["3_lag_id"].iloc[3:].tolist() == list(range(3997)) and got["3_lag_id"].iloc[:3].isna().all()
    assert got["2_lead_id"].iloc[:-2].tolist() == list(range(2, 4000)) and got["2_lead_id"].iloc[-2:].isna().all()


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 1, 2.0), (None, 2, 2, 3.0), ("a", None, 3, 4.0), ("a", 1, 4, 5.0)],
                               "g string, timestamp int, id int, v double")
    got = trip_day_neighbours(df, ["g"], ["timestamp", "id"], ["v"], lags=(1,), partitions=5).toPandas().set_index("id")
    assert got["1_lag_v"].dropna().to_dict() == {2: 2.0, 4: 4.0}
    assert trip_day_neighbours(df.limit(0), ["g"], ["timestamp", "id"], ["v"], lags=(1,)).count() == 0


def test_training_set_over_small_partitions_matches_oracle(spark, monkeypatch):
    """The flagship with its trip-days cut into many partitions still equals SQL."""
    import __spark_entry__ as entry
    from tools.oracle_check import compare, duck

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(ordered, "PARTITIONS", 40)
    got = entry.queries()["C3_weekly_training_set"](spark, sf).toPandas()
    want = duck(sf).execute(entry.oracle_sql()["C3_weekly_training_set"]).df()
    ok, msg = compare(got, want)
    assert ok, msg
