"""Whitespace and comma-separated matrices; bad lines are kept."""

import pytest

from yieldlab.sources import delimited as D


def parse(spark, lines, min_columns=100):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "row_idx long, value string").repartition(2)
    layout = D.find_layout(df, "value", min_columns)
    got = {r.row_idx: (r.features, r.bad_line) for r in D.parse_matrix_lines(df, layout).collect()}
    return layout, got


def test_whitespace_with_bad_lines(spark):
    lines = ["1 2 NaN", "\t4  5   6 ", "1 2", "1 2 3 4", "1 x 3", "", None, "NA nan 7"]
    layout, got = parse(spark, lines, 3)
    assert layout == D.Layout(False, 3)
    assert got == {
        0: ([1.0, 2.0, None], None), 1: ([4.0, 5.0, 6.0], None), 2: ([1.0, 2.0, None], "1 2"),
        3: ([1.0, 2.0, 3.0], "1 2 3 4"), 4: ([1.0, None, 3.0], "1 x 3"), 7: ([None, None, 7.0], None),
    }


def test_commas_where_whitespace_gives_too_few(spark):
    lines = ['1,"2",3', '"1","2,5",3', '1,"a ""b"", c",3', "1,,NaN", "1,2", "1,2,3,4", ' 7 , 8 ,9 ', '1,2,"3', "word " * 300]
    layout, got = parse(spark, lines)
    assert layout == D.Layout(True, 3)
    assert got[0] == ([1.0, 2.0, 3.0], None)
    assert got[1] == ([1.0, None, 3.0], lines[1]) and got[2] == ([1.0, None, 3.0], lines[2])
    assert got[3] == ([1.0, None, None], None)
    assert got[4] == ([1.0, 2.0, None], "1,2") and got[5] == ([1.0, 2.0, 3.0], "1,2,3,4")
    assert got[6] == ([7.0, 8.0, 9.0], None)
    assert got[7][0] == [1.0, 2.0, 3.0]  # a quote that isn't closed ends with its line
    assert got[8][1] == lines[8]


def test_most_lines_give_the_width(spark):
    assert parse(spark, ["1 2"] * 3 + ["1 2 3"] * 5 + ["1"] * 4, 1)[0].width == 3
    assert parse(spark, ["1 2"] * 3 + ["1 2 3"] * 3, 1)[0].width == 3  # of equally many the greater


def test_nothing_to_read(spark):
    layout, got = parse(spark, ["", None, "  "])
    assert layout == D.Layout(False, 0) and got == {}


def test_files(spark, tmp_path):
    wide = ",".join(f"s{i}" for i in range(120)) + "\n"
    body = [",".join(f'"{i + j}"' if j % 7 == 0 else str(i + j) for j in range(120)) for i in range(30)]
    body[11] = "broken"
    p = tmp_path / "m.csv"
    p.write_text(wide + "\n".join(body) + "\n")
    got = D.load_sensor_matrix(spark, str(p)).orderBy("row_idx").collect()
    assert [r.row_idx for r in got] == list(range(30))
    assert all(r.features == [float(r.row_idx + j) for j in range(120)] for r in got if r.row_idx != 11)
    assert [r.row_idx for r in got if r.bad_line] == [11]
    assert got[11].features == [None] * 120
    assert D.load_sensor_matrix(spark, str(p), on_bad="drop").count() == 29
    assert D.load_sensor_matrix(spark, str(p), header=False).count() == 31
    with pytest.raises(ValueError, match="line 11"):
        D.load_sensor_matrix(spark, str(p), on_bad="fail")

    space = tmp_path / "m.data"
    space.write_text("\n".join(" ".join(str(i + j) for j in range(110)) for i in range(9)))
    got = D.load_sensor_matrix(spark, str(space)).orderBy("row_idx").collect()
    assert [r.features[0] for r in got] == [float(i) for i in range(9)] and not any(r.bad_line for r in got)
