"""Feed sources: header-bound CSV, feed archive members, JSON documents."""

import os
import tempfile
import zipfile

import pytest

from waka.sources import feed_files as ff


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(f"{name}.txt", text)


def test_csv_binds_columns_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="waka-csv-")
    with open(os.path.join(d, "stops.txt"), "w") as f:
        f.write("stop_name,stop_lat,stop_id,stop_lon,location_type,stop_code\nA,-36.5,S1,174.5,0,101\n")
    r = ff.read_feed_csv(spark, d, "stops", ["stop_id", "stop_lat", "stop_lon", "stop_code"]).first()
    assert (r.stop_id, r.stop_lat, r.stop_lon, r.stop_code) == ("S1", -36.5, 174.5, "101")


def test_feed_zip_member_rows_and_missing_members(spark):
    d = tempfile.mkdtemp(prefix="waka-zip-")
    full = os.path.join(d, "full.zip")
    members = {m: "x\n1\n" for m in ff.REQUIRED_MEMBERS}
    members["stops"] = "stop_id,stop_code,stop_lat,stop_lon,location_type,stop_name\nS1,7,1.5,2.5,0,A\nS2,8,3.0,4.0,1,B\n"
    _zip(full, members)
    rows = ff.feed_zip_table(spark, full, "stops", ["stop_id", "stop_lat"]).orderBy("stop_id").collect()
    assert [(r.stop_id, r.stop_lat) for r in rows] == [("S1", 1.5), ("S2", 3.0)]

    part = os.path.join(d, "part.zip")
    _zip(part, {"stops": members["stops"], "trips": "trip_id\nT\n"})
    assert sorted(r.member for r in ff.missing_members(spark, part).collect()) == \
        sorted(set(ff.REQUIRED_MEMBERS) - {"stops", "trips"})
    with pytest.raises(Exception):
        ff.feed_zip_table(spark, part, "stops", ["stop_id"], on_missing="fail").collect()
    got = ff.feed_zip_table(spark, part, "stops", ["stop_id"], on_missing="report").count()
    assert got == 2


def test_feed_in_part_archives(spark, tmp_path):
    """A member spread over parts, quoted fields with line ends, other column orders, an empty member and a part without a column."""
    (tmp_path / "feed").mkdir()
    head = "stop_id,stop_name,stop_lat,stop_lon,location_type,stop_code\n"
    _zip(tmp_path / "feed" / "a.zip", {m: "x\n1\n" for m in ff.REQUIRED_MEMBERS} | {"stops": head + 'S1,"A, the\nfirst",1.5,2.5,0,7\n', "trips": ""})
    _zip(tmp_path / "feed" / "b.zip", {"stops": "stop_lat,stop_id\n3.25,S2\n"})
    _zip(tmp_path / "feed" / "c.zip", {"sub/stops": head})
    got = ff.feed_zip_table(spark, str(tmp_path / "feed"), "stops", ["stop_id", "stop_name", "stop_lat", "location_type"]).orderBy("stop_id").collect()
    assert [tuple(r) for r in got] == [("S1", "A, the\nfirst", 1.5, 0), ("S2", None, 3.25, None)]
    assert ff.feed_zip_table(spark, str(tmp_path / "feed"), "trips", ["trip_id"]).count() == 0


def test_packed_members_come_back(spark):
    df = spark.range(950).selectExpr("concat('T', id) trip_id", "concat('S', id % 7) stop_id", "cast(id as int) stop_sequence").repartition(3)
    packed = ff.pack_member(df, "stop_times", part_rows=100)
    assert packed.count() >= 3
    back = ff.feed_rows(packed, "stop_times", df.columns)
    assert back.schema["stop_sequence"].dataType.simpleString() == "int"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert ff.feed_rows(packed, "trips", ["trip_id"]).count() == 0 and ff.absent_members(packed).count() == 5
