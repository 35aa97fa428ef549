import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import aggregates, filters, marts, profile, quantiles, stats
from tallymark.operators.stats import Metric, area_stats

SCHOOL = "state string, county_fips string, math_pct_prof double, pct_high_income double, ratio double"


def r_of(pairs):
    n = len(pairs)
    if n < 3:
        return None
    mx, my = sum(p[0] for p in pairs) / n, sum(p[1] for p in pairs) / n
    sxx = sum((p[0] - mx) ** 2 for p in pairs)
    syy = sum((p[1] - my) ** 2 for p in pairs)
    if sxx == 0 or syy == 0:
        return None
    return sum((p[0] - mx) * (p[1] - my) for p in pairs) / math.sqrt(sxx * syy)


def test_area_stats_rules(frame):
    rows = [
        ("MI", "1", 50.0, 10.0, 15.0), ("MI", "1", 60.0, 20.0, None),                           # two pairs: no r
        ("MI", "2", 40.0, 5.0, 10.0), ("MI", "2", 50.0, 9.0, 12.0), ("MI", "2", 70.0, 11.0, 9.0),
        ("MI", "3", 40.0, 0.1, 1.0), ("MI", "3", 50.0, 0.1, 2.0), ("MI", "3", 60.0, 0.1, 3.0),     # no variance
        ("MI", "", 90.0, 30.0, 20.0),                                                            # state only
        ("", "9", 10.0, 10.0, 10.0), (None, "9", 10.0, 10.0, 10.0), ("OH", "1", None, 10.0, 5.0),  # left out
    ]
    df = frame(rows, SCHOOL)
    metric = [Metric("ratio", "avg_ratio", "r_ratio", "n_ratio")]
    counties = {r.county_fips: r for r in area_stats(df, ["state", "county_fips"], "pct_high_income", "math_pct_prof", metric).collect()}
    assert set(counties) == {"1", "2", "3"}
    assert counties["1"].pearson_r is None and counties["1"].school_count == 2
    assert counties["1"].n_ratio == 1 and counties["1"].avg_ratio == 15.0
    assert counties["2"].pearson_r == pytest.approx(r_of([(5, 40), (9, 50), (11, 70)]), abs=5e-5)
    assert counties["3"].pearson_r is None and counties["3"].r_ratio == 1.0
    states = area_stats(df, ["state"], "pct_high_income", "math_pct_prof").collect()
    # the school without a county counts in the state
    assert [(s.state, s.school_count) for s in states] == [("MI", 9)]
    assert area_stats(df.where("false"), ["state"], "pct_high_income", "math_pct_prof").count() == 0


def test_trend_segment(frame):
    def seg(points):
        df = frame([(float(x), float(y)) for x, y in points], "x double, y double")
        return stats.trend_segment(df, "x", "y").first()

    s = seg([(0, 0), (1, 10), (2, 0), (3, 30)])
    assert s.y0 >= -1e-9 and s.y1 <= 30 + 1e-9 and s.x0 < s.x1
    assert seg([(1, 1), (1, 2), (1, 3)]).x0 is None                   # no variance in x
    assert seg([(1, 1), (2, 2)]).x0 is None                           # too few
    flat = seg([(0, 5), (1, 5), (4, 5)])
    assert (flat.x0, flat.x1, flat.y0, flat.y1) == (0.0, 4.0, 5.0, 5.0)


@pytest.mark.parametrize("n", [1, 2, 5, 101, 1000])
def test_quantiles_are_exact(frame, n):
    r = random.Random(n)
    xs = [round(r.gauss(0, 10), 1) for _ in range(n)]
    probs = [0.0, 0.2, 0.25, 0.5, 0.8, 1.0]
    rows = [("a", x) for x in xs] + [("b", 3.0)] * (2 * n) + [("c", None)]
    got = {x.k: x for x in quantiles.quantiles(frame(rows, "k string, x double"), "x", probs, ["k"]).collect()}
    assert got["a"].q == pytest.approx(list(np.quantile(xs, probs)))
    assert (got["a"].n, got["a"].min, got["a"].max) == (n, min(xs), max(xs))
    assert got["b"].q == [3.0] * 6 and "c" not in got


@pytest.mark.parametrize("margin", [0.05, 0.0])
def test_quantiles_from_brackets(frame, monkeypatch, margin):
    """Brackets of a coarse sketch, with ties, constants and skew; without width they miss and are done again."""
    for name, value in (("FEW", 50), ("ACCURACY", 100), ("MARGIN", margin)):
        monkeypatch.setattr(quantiles, name, value)
    r = random.Random(7)
    columns = {
        "ties": [float(r.randint(0, 5)) for _ in range(700)], "flat": [2.5] * 300, "skew": [r.random() ** 9 for _ in range(900)],
        "few": [1.0, 2.0, 4.0], None: [float(i) for i in range(100)],
    }
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    rows = [(k, x) for k, xs in columns.items() for x in xs]
    df = quantiles.quantiles(frame(rows, "k string, x double"), "x", probs, ["k"])
    got = {x.k: x for x in df.collect()}
    assert set(got) == set(columns)
    for k, xs in columns.items():
        assert got[k].q == pytest.approx(list(np.quantile(xs, probs))) and got[k].n == len(xs)


@pytest.mark.parametrize("most,margin", [(20, 0.2), (20, 0.0), (3, 0.5)])
def test_brackets_are_narrowed_in_rounds(frame, monkeypatch, most, margin):
    """With brackets that hold far more values than a task may order: ties, one value, heavy ends, steep skew, null keys."""
    for name, value in (("FEW", 5), ("ACCURACY", 50), ("MARGIN", margin), ("MOST", most), ("PARTS", 4)):
        monkeypatch.setattr(quantiles, name, value)
    r = random.Random(11)
    columns = {
        "many": [r.gauss(0, 1) for _ in range(1500)], "ties": [float(r.randint(0, 60)) for _ in range(900)], "one": [7.0] * 400,
        "ends": [0.0] * 300 + [r.random() for _ in range(300)] + [1.0] * 300, "steep": [math.exp(r.uniform(-300, 300)) for _ in range(700)],
        "two": [1.0, 2.0], None: [float(i) for i in range(300)],
    }
    probs = [0.0, 0.01, 0.5, 0.5, 0.77, 1.0]
    rows = [(k, x) for k, xs in columns.items() for x in xs] + [("none", None)]
    got = {x.k: x for x in quantiles.quantiles(frame(rows, "k string, x double").repartition(5), "x", probs, ["k"]).collect()}
    assert set(got) == set(columns)
    for k, xs in columns.items():
        assert got[k].q == pytest.approx(list(np.quantile(xs, probs))) and got[k].n == len(xs)


def test_no_task_orders_more_than_stated(frame, monkeypatch):
    """What reaches the window that orders values, counted per key and position."""
    for name, value in (("FEW", 5), ("MARGIN", 0.4), ("MOST", 25), ("PARTS", 4)):
        monkeypatch.setattr(quantiles, name, value)
    met, narrowed = [], quantiles._narrowed

    def watched(values, wanted, crowded):
        out = narrowed(values, wanted, crowded)
        met.append(out[0].groupBy("_k", "_j").count().selectExpr("max(count)").first()[0])
        return out

    monkeypatch.setattr(quantiles, "_narrowed", watched)
    xs = [float(i * i) for i in range(3000)]
    got = quantiles.quantiles(frame([(x,) for x in xs], "x double"), "x", [0.25, 0.5]).first()
    assert got.q == pytest.approx(list(np.quantile(xs, [0.25, 0.5])))
    assert len(met) > 2 and met[-1] <= 25 and all(b < a for a, b in zip(met, met[1:]))


def test_quantiles_do_not_sort_the_rows(frame):
    df = quantiles.quantiles(frame([("a", 1.0)], "k string, x double"), "x", [0.5], ["k"])
    assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def brackets_by_hand(points):
    if len(points) < 5:
        return []
    xs = sorted(p[0] for p in points)

    def at(p):
        i = (len(xs) - 1) * p
        lo, hi = math.floor(i), math.ceil(i)
        return xs[lo] + (xs[hi] - xs[lo]) * (i - lo)

    cuts = []
    for p in (0.2, 0.4, 0.6, 0.8):
        c = round(at(p), 4)
        if c not in cuts:
            cuts.append(c)
    edges = [xs[0], *cuts, xs[-1]]
    out = []
    for i in range(len(edges) - 1):
        last = i == len(edges) - 2
        members = [p for p in points if edges[i] <= p[0] < edges[i + 1] or (last and edges[i] <= p[0] <= edges[i + 1])]
        if members:
            out.append((len(members), sum(p[1] < 25 for p in members), sum(25 <= p[1] < 50 for p in members),
                        sum(50 <= p[1] < 75 for p in members), sum(p[1] >= 75 for p in members)))
    return out


@pytest.mark.parametrize("kind", ["few", "equal", "spread", "skewed"])
def test_brackets(frame, kind):
    r = random.Random(3)
    points = {
        "few": [(float(i), 10.0) for i in range(4)],
        "equal": [(7.0, float(i * 20)) for i in range(5)],
        "spread": [(r.randint(0, 40) / 2, r.random() * 100) for _ in range(200)],
        "skewed": [(0.0, 10.0)] * 70 + [(float(i), 80.0) for i in range(1, 31)],
    }[kind]
    df = frame([("k", *p) for p in points] + [("k", None, 1.0)], "k string, x double, y double")
    got = quantiles.brackets(df, "x", "y", ["k"]).orderBy("bracket_no").collect()
    assert [(b.n, b.n_lt25, b.n_b2550, b.n_b5075, b.n_gte75) for b in got] == brackets_by_hand(points)
    for b in got:
        assert b.lt25 + b.b2550 + b.b5075 + b.gte75 == pytest.approx(100)


def test_bracket_labels(frame):
    df = frame([("k", float(x), 50.0) for x in (0, 10, 20, 30, 40, 50)], "k string, x double, y double")
    assert [b.bracket for b in quantiles.brackets(df, "x", "y", ["k"]).orderBy("bracket_no").collect()] == [
        "0–10%", "10–20%", "20–30%", "30–40%", "40–50%"]


def test_histogram(frame):
    df = frame([(float(i),) for i in range(11)] + [(None,)], "x double")
    assert [(h.bin, h.n) for h in quantiles.histogram(df, "x", 5).orderBy("bin").collect()] == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 3)]
    same = frame([(4.0,), (4.0,)], "x double")
    assert sum(h.n for h in quantiles.histogram(same, "x", 3).collect()) == 2
    gaps = frame([(0.0,), (10.0,)], "x double")
    assert [h.n for h in quantiles.histogram(gaps, "x", 4).orderBy("bin").collect()] == [1, 0, 0, 1]


def test_insight(frame):
    rows = [("MI", f"s{i}", float(10 * i), float(i)) for i in range(1, 6)] + [("MI", "none", None, 3.0), ("OH", "one", 5.0, 5.0)]
    df = frame(rows, "state string, name string, math double, income double")
    out = {r.state: r for r in stats.insight_stats(df, "income", "math", "name", ["state"]).collect()}
    mi = out["MI"]
    assert (mi.row_count, mi.paired_points, mi.mean_y, mi.median_y, mi.pearson_r_on_screen) == (6, 5, 30.0, 30.0, 1.0)
    assert [t.name for t in mi.top] == ["s5", "s4", "s3"] and [t.name for t in mi.bottom] == ["s1", "s2", "s3"]
    assert out["OH"].pearson_r_on_screen is None and out["OH"].median_x == 5.0


def test_summary(frame):
    df = frame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", None)], "k string, x double")
    assert quantiles.summary(df, "x").first() == (3, 4.0, 2.0, 9.0)
    assert quantiles.summary(df, "x", ["k"]).collect() == [("a", 3, 4.0, 2.0, 9.0)]
    assert quantiles.summary(df.where("false"), "x").first() == (0, None, None, None)


def test_describe_and_profiles(frame):
    rows = [(1, 2.0, "a"), (2, None, "b"), (3, 4.0, "a"), (None, 10.0, None)]
    df = frame(rows, "i int, d double, s string")
    d = {r.column: r for r in profile.describe(df).collect()}
    assert (d["i"]["count"], d["i"].p50, d["d"]["max"]) == (3, 2.0, 10.0)
    assert d["d"]["std"] == pytest.approx(np.std([2, 4, 10], ddof=1))
    assert {r.column for r in profile.describe(df, approx=True).collect()} == {"i", "d"}
    m = {r.column: (r.missing, r.pct) for r in profile.missing_profile(df).collect()}
    assert m == {"i": (1, 25.0), "d": (1, 25.0), "s": (1, 25.0)}
    c = profile.categorical_profile(df).first()
    assert (c.column, c.n_distinct, c.listed) == ("s", 2, ["a", "b"])
    many = frame([(f"v{i}",) for i in range(11)], "s string")
    assert profile.categorical_profile(many).first().listed is None


def test_groups_drop_null_keys_and_sum_nothing_to_zero(frame):
    df = frame([("a", 1.0, None), ("a", None, None), (None, 5.0, 5)], "k string, m double, n int")
    got = aggregates.mean_sum_by(df, ["k"], {"m": "m"}, {"n": "n"}, "t").collect()
    assert [(r.k, r.m, r.n, r.t) for r in got] == [("a", 1.0, 0, 0)]
    text = aggregates.mean_sum_by(df, ["k"], sums={"n": "n"}, null_as_empty=True).collect()
    assert {(r.k, r.n) for r in text} == {("a", 0), ("", 5)}
    assert {(r.k, r.n) for r in aggregates.count_by(df, ["k"], null_as_empty=True).collect()} == {("a", 2), ("", 1)}


def test_label_totals(frame):
    df = frame([(3, 2, 10), (1, None, 5)], "a int, b int, n int")
    got = aggregates.label_totals(df, {"A": "a", "B": "b", "Z": F.lit(0)}, "n", positive_only=True).collect()
    assert {(r.label, r.value) for r in got} == {("A", 4.0), ("B", 2.0), ("Other", 9.0)}


def test_drill_and_scatter(frame):
    schools = frame([("x", "MI", "1", 50.0, 5.0, 100.0), ("y", "MI", "2", None, 6.0, 90.0)],
                    "school_name string, state string, county_fips string, math_pct_prof double, pct_high_income double, enrollment double")
    states = frame([("MI", 1, 50.0, 5.0, None)],
                   "state string, school_count bigint, avg_math_pct_prof double, avg_pct_high_income double, pearson_r double")
    counties = states.withColumn("county_fips", F.lit("1"))
    assert marts.drill(schools, states, counties, "county", "MI", "2").first().name == "y"
    assert marts.drill(schools, states, counties, "state", "MI").first().name == "1"
    with pytest.raises(ValueError):
        marts.drill(schools, states, counties, "city")
    assert filters.scatter(schools, states, "pct_high_income", "avg_pct_high_income", "MI").count() == 1
    assert filters.scatter(schools, states, "pct_high_income", "avg_pct_high_income").first().name == "MI"


def test_levels_from_one_pass(frame):
    """State and county statistics of one pass are those of two; schools without a county count for their state."""
    r = random.Random(2)
    rows = [(r.choice(["MI", "OH", "", None]), r.choice(["1", "2", "", None]), r.choice([None, r.uniform(0, 100)]), r.choice([None, r.uniform(0, 30)]),
             float(i)) for i in range(300)]
    schools = frame(rows, "state string, county_fips string, math double, income double, ratio double")
    more = [Metric("ratio", "avg_r", "r_r", "n_r")]
    levels = {"state": ["state"], "county": ["state", "county_fips"]}
    both = stats.area_levels(schools, levels, "income", "math", more)
    for level, keys in levels.items():
        want = area_stats(schools, keys, "income", "math", more)
        got = both.where(F.col("level") == level).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 1
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") >= 1
