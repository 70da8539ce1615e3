"""Text loaders: label lines and the whitespace sensor matrix."""

import datetime as dt

from yieldlab.functions.columns import sanitize_columns
from yieldlab.sources import text as TX

import pytest


def test_label_line_forms(spark):
    lines = spark.createDataFrame(
        [(0, '-1 "03/02/2009 08:15:00"'), (1, '1 "03/02/2009 09:41:00"'),
         (2, "-1  07:05:12  14-03-2009"), (3, '2 "not a time"'), (4, "0 31/02/2009 10:00:00")],
        "row_idx long, value string",
    )
    got = {r.row_idx: (r.Label, r.Timestamp) for r in TX.parse_label_lines(lines).collect()}
    assert got[0] == (0, dt.datetime(2009, 2, 3, 8, 15))
    assert got[1] == (1, dt.datetime(2009, 2, 3, 9, 41))
    assert got[2] == (0, dt.datetime(2009, 3, 14, 7, 5, 12))
    assert got[3] == (0, None)  # unknown label -> pass, unreadable time -> NULL
    assert got[4] == (0, None)


def test_load_label_text_fills_gaps(spark, tmp_path):
    p = tmp_path / "labels.data"
    p.write_text('-1 "bad"\r\n1 "03/02/2009 09:41:00"\r\n\r\n-1 "bad"\r\n-1 "04/02/2009 01:00:00"\r\n')
    from yieldlab.plans.end_to_end import units_from_labels

    units = units_from_labels(TX.load_label_text(spark, str(p)))
    got = [(r.unit_no, r.Label, r.Timestamp) for r in units.orderBy("unit_no").collect()]
    assert got == [
        (0, 0, dt.datetime(2009, 2, 3, 9, 41)),  # backward fill of the leading gap
        (1, 1, dt.datetime(2009, 2, 3, 9, 41)),
        (2, 0, dt.datetime(2009, 2, 3, 9, 41)),  # forward fill
        (3, 0, dt.datetime(2009, 2, 4, 1, 0)),
    ]


def test_sensor_text_whitespace_and_nan(spark, tmp_path):
    p = tmp_path / "sensors.data"
    p.write_text("1.5 NaN 3\n\t 4 5.25\tnan  \nNA 7 8e-1\n\t\n")
    got = TX.load_sensor_text(spark, str(p), long=False).orderBy("row_idx").collect()
    assert [r.features for r in got] == [[1.5, None, 3.0], [4.0, 5.25, None], [None, 7.0, 0.8]]
    long_df = TX.load_sensor_text(spark, str(p))
    assert long_df.filter("value IS NULL").count() == 3
    assert {r.sensor_no for r in long_df.collect()} == {1, 2, 3}


def test_sensor_text_csv_with_header(spark, tmp_path):
    p = tmp_path / "sensors.csv"
    p.write_text("a,b\n1,2\n3,NaN\n")
    got = TX.load_sensor_text(spark, str(p), delimiter=",", header=True, long=False)
    assert [r.features for r in got.orderBy("row_idx").collect()] == [[1.0, 2.0], [3.0, None]]


def test_file_order_across_files(spark, tmp_path):
    (tmp_path / "a.data").write_text("1\n2\n")
    (tmp_path / "b.data").write_text("3\n")
    got = TX.load_sensor_text(spark, [str(tmp_path / "a.data"), str(tmp_path / "b.data")])
    assert [r.value for r in got.orderBy("row_idx").collect()] == [1.0, 2.0, 3.0]


def test_resolve_path(spark, tmp_path):
    (tmp_path / "sensor_matrix.csv").write_text("1 2\n")
    first = str(tmp_path / "sensor_matrix.data")
    assert TX.resolve_path(spark, first, str(tmp_path / "sensor_matrix.csv")) == str(tmp_path / "sensor_matrix.csv")
    assert TX.resolve_path(spark, first) == first


def test_sanitize_names():
    assert sanitize_columns(["Sensor-1", "Sensor 2", "x"]) == ["Sensor_1", "Sensor_2", "x"]
    with pytest.raises(ValueError):
        sanitize_columns(["a-b", "a b"])


def test_sensor_text_wide_layout(spark, tmp_path):
    p = tmp_path / "sensors.data"
    p.write_text("1 2 3\n4 NaN\n")
    wide = TX.load_sensor_text(spark, str(p), layout="wide").orderBy("row_idx").collect()
    assert list(wide[0].asDict()) == ["row_idx", "Sensor_1", "Sensor_2", "Sensor_3"]
    assert wide[1].Sensor_2 is None and wide[1].Sensor_3 is None and wide[0].Sensor_3 == 3.0


def test_header_of_every_file_is_dropped(spark, tmp_path):
    for name, text in (("a.csv", "\na,b\n1,2\n"), ("b.csv", "a,b\n3,4\n5,6\n")):
        (tmp_path / name).write_text(text)
    got = TX.load_sensor_text(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], delimiter=",", header=True, long=False)
    rows = got.orderBy("row_idx").collect()
    assert [r.features for r in rows] == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]


def test_times_need_no_session_zone(spark):
    lines = spark.createDataFrame([("-1 \"09/03/2008 02:30:00\"",), ("-1 \"31/02/2008 02:30:00\"",)], "value string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [str(r.Timestamp) for r in TX.parse_label_lines(lines).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2008-03-09 02:30:00", "None"]


def test_bad_labels_and_readings_are_reported(spark, tmp_path):
    p = tmp_path / "labels.data"
    p.write_text("-1 \"01/05/2010 08:00:00\"\nfail \"01/05/2010 08:01:00\"\n")
    with pytest.raises(ValueError, match="line 1"):
        TX.load_label_text(spark, str(p))
    assert [r.Label for r in TX.load_label_text(spark, str(p), on_bad="pass").collect()] == [0, 0]
    lines = spark.createDataFrame([("1 NaN 2.5",), ("1 x 3,5",)], "value string")
    assert [r.unreadable for r in TX.unreadable_readings(lines).collect()] == [["x", "3,5"]]
