"""Windows over small tables, reshaping, JSON, spatial join and usage audit."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import catalog, filters, jsonx, marts, reshape, spatial, topk, usage, windows


def test_newest_directory_row_by_name(frame):
    golden = frame([("Elm School", "g1", 50.0, None, None, 3.0, 10.0, 200.0, 8, 5, 6, 1.0, 2.0, 4, 1)],
                   "school_name string, ncessch string, math_high_pct double, math_low_pct double, pct_hhi_150k_200k double, "
                   "pct_hhi_220k_plus double, teachers_fte double, enrollment double, grade_eight_enrollment int, math_counts int, "
                   "read_counts int, read_high_pct double, avg_natwalkind double, total_10_14 int, schools_in_zip int")
    directory = frame(
        [("elm school", "a", "MI", "1", "48000", "42.0", "-83.0", "2019"), ("ELM SCHOOL", "b", "MI", "2", "48001", "x", "", "2021"),
         ("Elm School", "c", "OH", "3", "44000", "41.0", "-81.0", None)],
        "school_name string, ncessch string, state_location string, county_code string, zip_location string, latitude string, longitude string, year_json string")
    got = marts.districts(golden, directory).first()
    assert (got.ncessch, got.state, got.lat) == ("c", "OH", 41.0)  # no year sorts first
    assert (got.math_pct_prof, got.pct_high_income, got.student_teacher_ratio) == (50.0, 3.0, 20.0)
    dated = marts.districts(golden, directory.where("year_json IS NOT NULL")).first()
    assert (dated.ncessch, dated.lat) == ("b", None)


def test_latest_wins_and_top_bottom(frame):
    df = frame([("MI", 1, 10.0), ("MI", 2, 20.0), ("OH", 5, None)], "state string, v int, m double")
    assert {(r.state, r.m) for r in windows.latest_wins(df, ["state"], "v").collect()} == {("MI", 20.0), ("OH", None)}
    tb = windows.top_bottom(df, ["state"], "m", "v", 1).collect()
    assert {(r.side, r.m) for r in tb} == {("top", 20.0), ("bottom", 10.0)}


def test_yoy_with_a_missing_year(frame):
    rows = [(2018, "a", 10.0), (2019, "a", 12.0), (2021, "a", 20.0), (2018, "b", 5.0), (2021, "b", 6.0), (2019, "c", 1.0)]
    df = frame(rows, "year int, race string, v double")
    got = {(r.year, r.race): r.change for r in windows.yoy_diff(df, "year", "race", "v", ["a", "b", "c"]).collect()}
    assert len(got) == 9
    assert got[(2019, "a")] == 2.0 and got[(2021, "a")] == 8.0
    assert got[(2021, "b")] is None and got[(2018, "a")] is None  # no value in the row before


def test_melt_keeps_nulls(frame):
    df = frame([(1, None, 2.0)], "id int, a double, b double")
    got = reshape.melt(df, ["id"], ["a", "b"], labels={"a": "A"}).collect()
    assert {(r.variable, r.value) for r in got} == {("A", None), ("b", 2.0)}


def test_sorting(frame):
    df = frame([(1, None), (2, 3.0), (3, 1.0)], "id int, v double")
    assert [r.id for r in topk.sort_nulls_last(df, "v", "asc").collect()] == [3, 2, 1]
    assert [r.id for r in topk.sort_nulls_last(df, "v", "desc").collect()] == [2, 3, 1]
    assert [r.id for r in topk.top_tail(df, "v", 2, "id").collect()] == [3, 2]
    assert topk.sample_n(df, "id", 2).collect() == topk.sample_n(df, "id", 2).collect()


def test_filters(frame):
    df = frame([("45.0", "-83"), ("", "1"), ("91", "0"), ("x", "0"), (None, "0")], "lat string, lon string")
    assert df.where(filters.coord_valid("lat", "lon")).count() == 1
    assert df.where(filters.in_list("lat", [])).count() == 5
    mixed = frame([(1.0, "Big School"), (2.0, None)], "n double, s string")
    assert filters.eq_or_contains(mixed, "n", "1").count() == 1
    assert filters.eq_or_contains(mixed, "s", "big|none").count() == 1
    with pytest.raises(ValueError):
        filters.eq_or_contains(mixed, "n", "abc")


def test_json_expand(frame):
    rows = [(1, '{"a-b":1,"a_b":"x","year":2020,"deep":{"k":[1,2]},"none":null}'), (2, '{"a_b":"y"}')]
    df = frame(rows, "id int, js string")
    got = {r.id: r for r in jsonx.expand_json(df, "js", ["id"]).collect()}
    assert got[1].asDict() == {"id": 1, "a_b": "1", "a_b_1": "x", "year_json": "2020", "deep": '{"k":[1,2]}', "none": None}
    assert got[2].a_b_1 == "y" and got[2].a_b is None


def test_json_types(frame):
    """Mixed and nested types, keys in the thousands, broken text."""
    rows = [('{"a": 1, "b": {"c": [1]}, "d": null}',), ('{"a": "1", "b": [], "A": true, "a b": 1.5}',), ("[1, 2]",), ("7",), ("{broken",), (None,), ("{}",)]
    rows += [("{" + ", ".join(f'"k{i}": {i}' for i in range(3000)) + "}",)]
    got = {(r.key, r.kind): r.n for r in jsonx.json_types(frame(rows, "p string"), "p").collect()}
    few = {k: n for k, n in got.items() if not k[0].startswith("k")}
    assert few == {("a", "number"): 1, ("a", "string"): 1, ("b", "object"): 1, ("b", "array"): 1, ("d", "null"): 1, ("A", "boolean"): 1, ("a b", "number"): 1}
    assert len(got) - len(few) == 3000


def test_json_keys_that_differ_in_case(frame):
    df = frame([(1, '{"Id":"p","ID":"q","x":1}')], "n int, js string")
    row = jsonx.expand_json(df, "js", ["n"]).first().asDict()
    assert row == {"n": 1, "id_json": "q", "id_json_1": "p", "x": "1"}


def test_names_that_meet_a_suffix(frame):
    keys = frame([("A",), ("a",), ("a_1",)], "key string")
    got = {r.key: r.column for r in jsonx.named_keys(keys).collect()}
    assert got["A"] == "a" and len(set(got.values())) == 3


def inside_by_hand(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def test_within_on_the_named_cases(frame):
    polys = spatial.with_edges(frame(
        [("box", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"), ("over", "MULTIPOLYGON (((8 8, 12 8, 12 12, 8 12, 8 8)), ((20 20, 21 20, 20 21, 20 20)))")],
        "name string, geometry string"))
    pts = frame([(1, 2.0, 2.0), (2, 30.0, 30.0), (3, 0.0, 5.0), (4, 5.0, 5.0), (5, 9.0, 9.0), (6, 4.0, 5.0), (7, 10.0, 9.0), (8, 20.25, 20.25), (9, None, 1.0)],
                "id int, x double, y double")
    got = {}
    for r in spatial.within_left(pts, polys, ["id"], "x", "y", {"name": "name"}).collect():
        got.setdefault(r.id, set()).add(r.name)
    assert got == {1: {"box"}, 2: {None}, 3: {None}, 4: {None}, 5: {"box", "over"}, 6: {None}, 7: {"over"}, 8: {"over"}, 9: {None}}


def test_within_on_random_shapes(frame):
    r = random.Random(5)
    shapes, texts = [], []
    for i in range(40):
        size = r.choice([0.3, 2.0, 30.0, 120.0])
        cx, cy = r.uniform(-150, 150), r.uniform(-80, 80)
        ring = [(round(cx + r.uniform(-size, size), 1), round(cy + r.uniform(-size, size), 1)) for _ in range(r.randint(3, 9))]
        ring.append(ring[0])
        shapes.append((f"p{i}", [ring]))
        texts.append((f"p{i}", "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in ring) + "))"))
    pts = [(i, round(r.uniform(-180, 180), 1), round(r.uniform(-90, 90), 1)) for i in range(300)]
    pts += [(300 + i, *shapes[i][1][0][0]) for i in range(40)]
    polys = spatial.with_edges(frame(texts, "name string, geometry string"))
    pairs = spatial.within_pairs(frame(pts, "id int, x double, y double"), polys, ["id"], "x", "y", ["name"])
    want = {(i, n) for i, x, y in pts for n, rings in shapes if inside_by_hand(rings, x, y)}
    got = [(p.id, p.name) for p in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_cells_are_bounded(frame):
    polys = spatial.with_edges(frame(
        [("tiny", "POLYGON ((0 0, 0.001 0, 0 0.001, 0 0))"), ("huge", "POLYGON ((-180 -90, 180 -90, 180 90, -180 90, -180 -90))")],
        "name string, geometry string"))
    counts = spatial.polygon_cells(polys).groupBy("name").count().collect()
    assert all(c["count"] <= (spatial.SPLITS + 1) ** 2 for c in counts) and len(counts) == 2


def star(n, cx, cy, radius, seed, inner=0.7):
    """A ring of n corners around a centre."""
    r = random.Random(seed)
    at = [(2 * math.pi * i / n, radius * r.uniform(inner, 1.0)) for i in range(n)]
    ring = [(cx + d * math.cos(a), cy + d * math.sin(a)) for a, d in at]
    return [*ring, ring[0]]


def text_of(rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in rings) + ")"


@pytest.mark.parametrize("inner,copies", [(0.99, 1.5), (0.7, 3.5)])
def test_ten_thousand_corners(frame, inner, copies):
    """Edges are stored little more than once if they are short, a few times if they are long; cells are no more than edges."""
    rings = [star(10_000, 10.0, 20.0, 5.0, 1, inner), star(2_000, 10.0, 20.0, 1.0, 2, inner)]
    polys = spatial.with_edges(frame([("a", text_of(rings)), ("b", text_of([star(50, 12.0, 20.0, 4.0, 3)]))], "name string, geometry string"))
    n_edges = polys.selectExpr("sum(size(edges))").first()[0]
    cells = spatial.polygon_cells(polys)
    stored, most, n = cells.selectExpr("sum(size(edges))", "max(size(edges))", "count(*)").first()
    assert n_edges == 12_050 and stored < copies * n_edges and n < 1.5 * n_edges and most < n_edges / 20
    r = random.Random(9)
    pts = [(i, r.uniform(4, 17), r.uniform(14, 26)) for i in range(400)] + [(400 + i, *rings[0][i * 97]) for i in range(50)]
    pairs = spatial.within_pairs(frame(pts, "id int, x double, y double"), polys, ["id"], "x", "y", ["name"]).collect()
    shapes = {"a": rings, "b": [star(50, 12.0, 20.0, 4.0, 3)]}
    assert sorted((p.id, p.name) for p in pairs) == sorted((i, k) for i, x, y in pts for k, g in shapes.items() if inside_by_hand(g, x, y))


def test_within_on_grid_lines(frame):
    """Corners, edges and points on lines of the grid, collinear and vertical and level edges, a hole that touches the outside."""
    r = random.Random(4)
    shapes = {}
    for i in range(60):
        n = r.randint(3, 8)
        ring = [(float(r.randint(0, 8)), float(r.randint(0, 8))) for _ in range(n)]
        shapes[f"p{i}"] = [[*ring, ring[0]]]
    shapes["touch"] = [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0), (0.0, 0.0)], [(0.0, 4.0), (4.0, 2.0), (4.0, 6.0), (0.0, 4.0)]]
    polys = spatial.with_edges(frame([(k, text_of(g)) for k, g in shapes.items()], "name string, geometry string"))
    pts = [(17 * a + b, a / 2, b / 2) for a in range(17) for b in range(17)] + [(1000 + i, r.uniform(-1, 9), r.uniform(-1, 9)) for i in range(200)]
    pairs = spatial.within_pairs(frame(pts, "id int, x double, y double"), polys, ["id"], "x", "y", ["name"]).collect()
    assert sorted((p.id, p.name) for p in pairs) == sorted((i, k) for i, x, y in pts for k, g in shapes.items() if inside_by_hand(g, x, y))


def test_same_polygon_twice(frame):
    """Equal polygons are two polygons."""
    polys = spatial.with_edges(frame([("a", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")] * 2 + [("e", None)], "name string, geometry string"))
    pairs = spatial.within_pairs(frame([(1, 1.0, 1.0)], "id int, x double, y double"), polys, ["id"], "x", "y", ["name"])
    assert [(p.id, p.name) for p in pairs.collect()] == [(1, "a"), (1, "a")]


def test_geocode_and_boxes(frame):
    def layer(rows, schema):
        return spatial.with_edges(frame(rows, schema))

    square = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
    states = layer([("Mich", "026", square)], "name string, state_fips string, geometry string")
    counties = layer([("Wayne", "000", square)], "name string, county_fips string, geometry string")
    zips = layer([("48201", square)], "geoid string, geometry string")
    pts = frame([(5.0, 5.0), (5.0, 5.0), (50.0, 50.0)], "latitude double, longitude double")
    got = {r.latitude: r for r in spatial.geocode(pts, states, counties, zips).collect()}
    assert (got[5.0].state, got[5.0].state_fips, got[5.0].county_fips, got[5.0].zip) == ("Mich", "26", "0", "48201")
    assert (got[50.0].state, got[50.0].state_fips, got[50.0].zip) == ("", "", "")
    literal = spatial.geocode(pts, states, counties, zips, keep_unmatched_literal=True)
    assert literal.where("latitude = 50").first().county_fips == "nan"
    assert spatial.bbox(states).first() == (0.0, 0.0, 10.0, 10.0)
    assert spatial.bbox(states.where("false")).first() == (-125.0, 24.0, -66.0, 50.0)


def replay(log, budget, cap, most):
    """The ledger run one row at a time."""
    out, day_of = {}, {}
    for e, ts, day, session, kind, tokens, cost in sorted(log, key=lambda r: (r[2], r[1], r[0])):
        sessions = day_of.setdefault(day, {})
        if kind == "record":
            t, c = sessions.get(session, (0, 0))
            sessions[session] = (t + tokens, c + cost)
            continue
        if sum(c for _, c in sessions.values()) >= budget:
            out[e] = "budget"
        elif session in sessions and sessions[session][0] >= cap:
            out[e] = "session_tokens"
        elif session not in sessions and len(sessions) >= most:
            out[e] = "max_sessions"
        else:
            sessions.setdefault(session, (0, 0))
            out[e] = None
    return out


def test_usage_admission_equals_a_replay(frame):
    r = random.Random(11)
    log = []
    for e in range(1500):
        day = r.choice(["d1", "d1", "d1", "d2", "d3"])
        session = "busy" if r.random() < 0.3 else f"s{r.randint(0, 12)}"
        log.append((e, r.randint(0, 700), day, session, r.choice(["authorize", "authorize", "record"]), r.randint(0, 40), r.randint(0, 5)))
    for most, cap, budget in [(3, 400, 600), (8, 1000, 900), (0, 10, 50), (20, 10**6, 10**6)]:
        df = frame(log, "event_id int, ts int, day string, session_id string, kind string, tokens bigint, cost_usd bigint")
        got = {x.event_id: x.reason for x in usage.usage_admission(df, budget, cap, most).collect()}
        assert got == replay(log, budget, cap, most)


def test_usage_ledger(frame):
    df = frame([("d", "a", 5, 1.0), ("d", "a", 7, 2.0), ("d", "b", 1, 4.0)], "day string, session_id string, tokens bigint, cost_usd double")
    assert {(r.session_id, r.tokens, r.cost_usd) for r in usage.merge_usage(df).collect()} == {("a", 12, 3.0), ("b", 1, 4.0)}
    got = usage.usage_status(df, "a", "d").first()
    assert (got.total_cost_usd, got.session_count, got.session_tokens, got.session_exists) == (7.0, 2, 12, True)
    assert usage.usage_status(df, "zz").first().session_tokens == 0


def test_run_select_refuses_writes(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert catalog.run_select(spark, "select count(*) AS n from numbers;").first().n == 3
    assert catalog.run_select(spark, "WITH a AS (SELECT * FROM numbers WHERE id > :low) SELECT * FROM a -- end", args={"low": 1}).count() == 1
    for bad in ("DROP TABLE numbers", "WITH a AS (SELECT 1) INSERT INTO numbers SELECT * FROM a", "SELECT 1; DROP VIEW numbers"):
        with pytest.raises(Exception):
            catalog.run_select(spark, bad)
    assert catalog.table_exists(spark, "numbers")
    counts = catalog.row_counts({"n": spark.range(3)}).first()
    assert (counts.table_name, counts.n_rows, counts.n_columns) == ("n", 3, 1)
    with pytest.raises(ValueError):
        catalog.run_select(spark, "SHOW TABLES")


def test_interquery_columns(frame):
    a = frame([(1, "x"), (2, None)], "id int, code string")
    names = frame([("00007", "Wayne")], "code string, county string")
    from tallymark.operators.joins import with_names

    got = {r.id: r.name for r in with_names(a.withColumn("code", F.when(F.col("id") == 1, "7").otherwise("8")), names, "code", "county").collect()}
    assert got == {1: "Wayne", 2: "8"}
