"""Ordered scans and skew joins against straightforward results."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallymark.operators import usage, windows
from tallymark.plans import lineage, scan, skew


def skewed(n=3000, seed=1):
    """Rows of which a third share one key; some keys are null."""
    r = random.Random(seed)
    return [(i, "hot" if r.random() < 0.34 else r.choice(["a", "b", "c", None]), r.randint(0, 50)) for i in range(n)]


def test_running_totals(frame):
    rows = skewed()
    df = frame(rows, "id int, k string, v int")
    chunked = scan.ordered_chunks(df, ["k"], ["v", "id"])
    assert chunked.where("k = 'hot'").select("_chunk").distinct().count() > 1
    out = scan.running(chunked, ["k"], {"before": F.col("v")}, {"total": "before"})
    want, sums = {}, {}
    for i, k, v in sorted(rows, key=lambda x: (x[2], x[0])):
        want[i] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v
    got = out.collect()
    assert {r.id: r.before for r in got} == want
    assert {(r.k, r.total) for r in got} == set(sums.items())


def test_running_over_a_longer_key(frame):
    rows = skewed()
    df = frame(rows, "id int, k string, v int").withColumn("p", F.col("id") % 3)
    out = scan.running(scan.ordered_chunks(df, ["k"], ["id"]), ["k", "p"], {"n": F.lit(1)})
    want, seen = {}, {}
    for i, k, _ in rows:
        want[i] = seen.get((k, i % 3), 0)
        seen[(k, i % 3)] = want[i] + 1
    assert {r.id: r.n for r in out.collect()} == want


def test_dupe_rank(frame):
    rows = skewed()
    out = windows.dupe_rank(frame(rows, "id int, k string, v int"), ["k"], [F.desc("v"), F.asc("id")])
    want, seen = {}, {}
    for i, k, v in sorted(rows, key=lambda x: (-x[2], x[0])):
        seen[k] = want[i] = seen.get(k, 0) + 1
    assert {r.id: r.dupe_rank for r in out.collect()} == want
    assert out.columns == ["id", "k", "v", "dupe_rank"]


@pytest.mark.parametrize("rows_per_part", [100, 10**6])
def test_dupe_rank_of_light_and_heavy_keys(frame, rows_per_part):
    """Heavy keys by the scan, others by a window: same ranks, same types, null keys included."""
    rows = skewed(2000, 4)
    out = windows.dupe_rank(frame(rows, "id int, k string, v int"), ["k"], [F.desc("v"), F.asc("id")], "n", rows_per_part)
    want, seen = {}, {}
    for i, k, v in sorted(rows, key=lambda x: (-x[2], x[0])):
        seen[k] = want[i] = seen.get(k, 0) + 1
    assert {r.id: r.n for r in out.collect()} == want
    assert out.schema["n"].dataType.simpleString() == "bigint" and out.columns == ["id", "k", "v", "n"]


def test_light_keys_are_not_written(frame, monkeypatch):
    monkeypatch.setattr(scan, "settle", None)
    out = windows.dupe_rank(frame(skewed(300), "id int, k string, v int"), ["k"], [F.asc("id")])
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 300


def test_usage_rows_are_written_once(frame, monkeypatch):
    """One ordered copy; after it a row is shuffled once, by day and chunk, and sessions meet as sums only."""
    written = []
    monkeypatch.setattr(scan, "settle", lambda df, label="x": written.append(label) or lineage.settle(df, label))
    log = frame([(1, 1, "d", "s", "authorize", 1, 1)], "event_id int, ts int, day string, session_id string, kind string, tokens bigint, cost_usd bigint")
    plan = usage.usage_admission(log, 1, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert written == ["chunks"] and plan.count("rangepartitioning") == 0
    assert plan.count("hashpartitioning(_day") + plan.count("hashpartitioning(_day#") > 0


def test_first_n_beyond_the_group_limit(frame):
    rows = [(i, "k") for i in range(1500)]
    out = windows.first_n_per(frame(rows, "id int, k string"), ["k"], [F.asc("id")], 1200)
    assert sorted(r.id for r in out.collect()) == list(range(1200))
    few = windows.first_n_per(frame(rows, "id int, k string"), ["k"], [F.asc("id")], 5)
    assert few.schema == out.schema


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("split", [False, True])
def test_salted_join(frame, how, split):
    left = frame(skewed(), "id int, k string, v int")
    hot = skew.hot_keys(left, ["k"], 100) if split else None
    right = frame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4), (None, 5)], "k string, w int")
    got = skew.salted_join(left, right, ["k"], how, ["id"], hot)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_salted_join_two_keys_and_other_hot_source(frame):
    rows = skewed()
    left = frame(rows, "id int, k string, v int")
    right = left.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("k IS NOT NULL")
    got = skew.salted_join(left, right, ["k", "v"], "left", ["id"], skew.hot_keys(left.where("v < 10"), ["k", "v"], 5))
    want = left.join(right, ["k", "v"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_is_split(frame):
    left = frame(skewed(), "id int, k string, v int")
    parts = {r.k: r._salts for r in skew.hot_keys(left, ["k"], 600).collect()}
    assert parts == {"hot": 2}  # about 1,000 of 3,000 rows; the others stay whole, nulls are no key
    assert skew.hot_keys(left, ["k"]).count() == 0
    assert skew.hot_keys(left, ["id"], 0).count() == 3000  # no fixed number of keys


def test_hundred_hot_keys_are_split(frame):
    rows = frame([(i, i % 100) for i in range(5000)], "id int, k int")
    hot = skew.hot_keys(rows, ["k"], 20)
    assert {r._salts for r in hot.collect()} == {3} and hot.count() == 100
    right = rows.groupBy("k").agg(F.max("id").alias("m"))
    out = skew.salted_join(rows, right, ["k"], "left", ["id"], hot)
    assert out.count() == 5000 and out.where("m % 100 <> k").count() == 0


def test_counts_say_what_to_split(frame):
    rows = frame(skewed(), "id int, k string, v int")
    got = {(r.id, r.n) for r in windows.count_in(rows, ["k"], "n", ["id"], rows_per_part=100).collect()}
    size = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    assert got == {(i, size[k] if k is not None else None) for i, k, _ in skewed()}


def test_shared_folder_is_the_named_one(spark):
    def session(named, master="yarn"):
        conf = SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
            getConf=lambda: conf, applicationId="app", master=master))

    assert lineage.shared_folder(session("hdfs://shared/ck/")) == "hdfs://shared/ck"
    with pytest.raises(ValueError):
        lineage.shared_folder(session(None))  # no machine-local folder on a cluster
    assert lineage.settle(spark.range(5), "kept").count() == 5
