import hashlib

import pytest
from pyspark.sql import functions as F

from tallymark.functions import exprs as E
from tallymark.functions.lookups import MAP_EDGES, MAP_LABELS, MAP_NO_DATA


def values(frame, column, rows, dtype="string"):
    df = frame([(i, r) for i, r in enumerate(rows)], f"i int, v {dtype}")
    return [r[0] for r in df.select("i", column.alias("o")).orderBy("i").select("o").collect()]


def test_safe_numbers(frame):
    rows = ["abc", "", " 12.5 ", "12.7", "-3.9", "1d", "2F", None, "9007199254740993", "1e3"]
    assert values(frame, E.safe_float("v"), rows) == [
        None, None, 12.5, 12.7, -3.9, None, None, None, 9007199254740992.0, 1000.0]
    assert values(frame, E.safe_int("v"), rows) == [
        None, None, 12, 12, -3, None, None, None, 9007199254740993, 1000]


def test_number_keeps_numeric_columns(frame):
    df = frame([("7", 7)], "t string, n int")
    assert df.select(E.number(df, "t"), E.number(df, "n")).first() == (7.0, 7.0)


def test_fips(frame):
    assert values(frame, E.strip_fips("v"), ["001", "000", "26", None]) == ["1", "0", "26", ""]
    assert values(frame, E.strip_fips("v", "nan"), [None]) == ["nan"]
    assert values(frame, E.pad_fips("v", 5), ["1001", "123456", None]) == ["01001", "123456", None]
    assert values(frame, E.state_prefix("v"), ["1001"]) == ["01"]


def test_identifier(frame):
    rows = ["School Name", "a--b", "2nd Level", "École_1", "x.y..z"]
    assert values(frame, E.identifier("v"), rows) == ["school_name", "a_b", "t_2nd_level", "école_1", "x_y_z"]


def test_content_hash(frame):
    want = hashlib.sha256(b'dir_2021_{"a":1}').hexdigest()
    assert values(frame, E.content_hash(F.lit("dir"), F.lit(2021), "v"), ['{"a":1}']) == [want]


@pytest.mark.parametrize("high,low,want", [(50.0, 40.0, 45.0), (50.0, None, 50.0), (None, 40.0, 40.0), (None, None, None)])
def test_midpoint(frame, high, low, want):
    assert frame([(high, low)], "h double, l double").select(E.midpoint("h", "l")).first()[0] == want


@pytest.mark.parametrize("e,t,want", [(100.0, 8.0, 12.5), (100.0, 0.0, None), (100.0, None, None), (None, 8.0, None)])
def test_ratio(frame, e, t, want):
    assert frame([(e, t)], "e double, t double").select(E.ratio("e", "t")).first()[0] == want


def test_pct_and_diversity(frame):
    df = frame([(1, 2, 1, 4), (0, 0, 0, 0), (None, 2, 2, 4)], "a int, b int, c int, n int")
    assert [r[0] for r in df.select(E.pct_of("a", "n")).collect()] == [25.0, 0.0, 0.0]
    score = E.diversity(["a", "b", "c"], "n")
    got = [r[0] for r in df.select(score).collect()]
    assert got[0] == pytest.approx(1 - (1 / 16 + 4 / 16 + 1 / 16)) and got[1] == 1.0
    strict = E.diversity(["a", "b", "c"], "n", empty_is_null=True)
    assert df.select(strict).collect()[1][0] is None


def test_band(frame):
    got = values(frame, E.band("v", MAP_EDGES, MAP_LABELS, MAP_NO_DATA), [None, -1.0, 24.9, 25.0, 64.9, 65.0], "double")
    assert got == ["No data", "< 25%", "< 25%", "25–35%", "55–65%", "≥ 65%"]


def test_relabel_and_nulls(frame):
    assert values(frame, E.relabel("v", {"a": "A"}, "v"), ["a", "b", None]) == ["A", "b", None]
    assert values(frame, E.null_to_empty("v"), [None, "nan", "None", "NaT", "x"]) == ["", "", "", "", "x"]
    assert values(frame, E.present("v"), [None, "", " ", "x"]) == [False, False, True, True]


def test_point_feature_keeps_nulls(frame):
    df = frame([("s", 1.5, 2.5, None)], "name string, lon double, lat double, math double")
    got = df.select(E.point_feature("lon", "lat", {"name": "name", "math": "math"})).first()[0]
    assert got == ('{"type":"Feature","geometry":{"type":"Point","coordinates":[1.5,2.5]},'
                   '"properties":{"name":"s","math":null}}')


def test_cost_day_round(frame):
    df = frame([(1_000_000, 500_000)], "i bigint, o bigint")
    assert df.select(E.cost("i", "o", 3.0, 15.0)).first()[0] == pytest.approx(10.5)
    assert values(frame, E.round_to("v", 2), [8.575, 0.125, -0.125, None], "double") == [8.57, 0.13, -0.13, None]
    assert values(frame, E.utc_day(F.to_timestamp("v")), ["2024-01-31 23:59:59"]) == ["2024-01-31"]
