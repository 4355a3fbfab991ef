"""Repartition invariance: the flagship result does not depend on shuffle width."""

SF = "/root/testdata/sf0.001"


def test_training_set_same_for_1_and_8_partitions(spark):
    import __spark_entry__ as entry

    q = entry.queries()["C3_weekly_training_set"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted(map(tuple, q(spark, SF).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted(map(tuple, q(spark, SF).collect()), key=str)
    assert a == b and len(a) > 0
