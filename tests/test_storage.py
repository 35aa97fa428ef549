"""Readers, writers and streams on small inputs."""

import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions.lookups import CENSUS_COLUMNS
from tallymark.operators import quality
from tallymark.sources import readers, writers
from tallymark.streaming import batches, ingest, live, meter


def test_insert_if_absent_twice(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame([("h1", 2020), ("h1", 2020), ("h2", 2021)], "data_hash string, year int")
    for _ in range(2):
        writers.insert_if_absent(rows, path)
    writers.insert_if_absent(frame([("h2", 2021), ("h3", 2021)], "data_hash string, year int"), path)
    assert sorted(r.data_hash for r in spark.read.parquet(path).collect()) == ["h1", "h2", "h3"]
    late = frame([("h3", 2021), ("h4", 2021)], "data_hash string, year int")
    writers.insert_if_absent(late, path, touched=[2021])
    assert sorted(r.data_hash for r in spark.read.parquet(path).collect()) == ["h1", "h2", "h3", "h4"]
    with pytest.raises(Exception, match="touched"):
        writers.insert_if_absent(late, path, touched=[1999])


def test_replace_removes_old_partitions(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace(frame([("a", 1), ("b", 2)], "k string, v int"), path, ["k"])
    writers.replace(frame([("b", 3)], "k string, v int"), path, ["k"])
    assert [(r.k, r.v) for r in spark.read.parquet(path).collect()] == [("b", 3)]


def test_ndjson_drops_nulls(frame, tmp_path):
    path = tmp_path / "out"
    writers.ndjson(frame([("MI", None)], "state string, r double"), str(path))
    lines = [line for f in path.glob("part-*") for line in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"state": "MI"}]


def test_export_names(frame, tmp_path):
    at = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    path = writers.export(frame([(1,)], "a int"), str(tmp_path), "x", "csv", at)
    assert path.endswith("x_20240506_070809.csv")
    with pytest.raises(ValueError):
        writers.export(frame([(1,)], "a int"), str(tmp_path), "x", "xlsx")


def test_pages_one_per_file(spark, tmp_path):
    folder = tmp_path / "endpoint=dir" / "year=2020"
    folder.mkdir(parents=True)
    (folder / "p1.json").write_text('{"results": [\n{"a": 1},\n{"a": {"b": null}}], "next": null}')
    (folder / "p2.json").write_text('{"results": [], "next": null}')
    pages = readers.landed_pages(spark, str(tmp_path), one_per_line=False)
    got = readers.json_pages(pages).collect()
    assert sorted(json.dumps(json.loads(r.data_json)) for r in got) == ['{"a": 1}', '{"a": {"b": null}}']
    assert {(r.endpoint, r.year, len(r.data_hash)) for r in got} == {("dir", 2020, 64)}


def test_coded_wide(frame):
    df = frame([("ZCTA5 48201", None, 3)], "geo string, B01003_001E int, B19001_017E int")
    got = readers.coded_wide(df, "geo", 2021).first().asDict()
    assert got == {"total_pop": 0, "hhi_220k_plus": 3, "zip_code": "48201", "year": 2021, "data_source": "census_api"}
    assert len(CENSUS_COLUMNS) == 11


def test_pages_of_a_table(spark):
    df = spark.range(100)
    assert [r.id for r in readers.page(df, "id", 3, 10).collect()] == [10, 11, 12]
    assert [r.id for r in readers.page(df, "id", 2, after=41).collect()] == [42, 43]


def test_ingest_stats(frame):
    seen = frame([("a", 1), ("a", 2), ("b", 3)], "endpoint string, x int")
    before = frame([("a", 1)], "endpoint string, n bigint")
    got = {r.endpoint: (r.n_seen, r.n_inserted, r.n_tables)
           for r in writers.ingest_stats(seen, before, writers.stored_counts(seen), ["a", "c"]).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, 1, 1), "c": (0, 0, 0), None: (3, 2, 2)}


def test_declared_tests(frame):
    df = frame([("1", None), (None, None)], "leaid string, year int")
    got = {(r.table_name, r.column): r.failures for r in quality.not_null({"m": (df, ["leaid", "year"])}).collect()}
    assert got == {("m", "leaid"): 1, ("m", "year"): 2}
    assert sum(len(c) for c in quality.NOT_NULL.values()) == 13


def test_ingest_stream_is_repeatable(spark, tmp_path):
    land, target = tmp_path / "land", str(tmp_path / "target")
    folder = land / "endpoint=dir" / "year=2020"
    folder.mkdir(parents=True)
    (folder / "p1.json").write_text('{"results": [{"a": 1}, {"a": 2}]}\n')

    def run(checkpoint):
        pages = ingest.landed_stream(spark, str(land), "value string, endpoint string, year int", "text", files_per_batch=1)
        ingest.ingest_stream(readers.json_pages(pages), target, str(tmp_path / checkpoint)).awaitTermination()
        return spark.read.parquet(target).count()

    assert run("c1") == 2
    (folder / "p2.json").write_text('{"results": [{"a": 2}, {"a": 3}]}\n')
    assert run("c1") == 3          # goes on where it stopped
    assert run("c2") == 3          # reads everything again, stores nothing twice


USAGE = "ts timestamp, session_id string, tokens bigint, cost_usd decimal(18,6)"


def land(frame, folder, rows):
    frame([(at, s, n, Decimal(n)) for at, s, n in rows], USAGE).coalesce(1).write.mode("append").parquet(str(folder))


def metered(spark, tmp_path, checkpoint="cp", **how):
    events = ingest.landed_stream(spark, str(tmp_path / "land"), USAGE, files_per_batch=1)
    meter.start_meter(events, str(tmp_path / "out"), str(tmp_path / checkpoint), **how).awaitTermination()
    return {(r.day, r.session_id, r.tokens) for r in meter.read_meter(spark, str(tmp_path / "out")).collect()}


def test_meter_counts_late_rows(frame, spark, tmp_path):
    land(frame, tmp_path / "land", [(datetime(2024, 3, 1, 1), "a", 5), (datetime(2024, 3, 1, 2), "b", 1)])
    assert metered(spark, tmp_path) == {("2024-03-01", "a", 5), ("2024-03-01", "b", 1)}
    land(frame, tmp_path / "land", [(datetime(2024, 3, 1, 3), "a", 7)])
    land(frame, tmp_path / "land", [(datetime(2024, 1, 30, 3), "a", 2)])  # a month late
    want = {("2024-03-01", "a", 12), ("2024-03-01", "b", 1), ("2024-01-30", "a", 2)}
    assert metered(spark, tmp_path) == want
    assert metered(spark, tmp_path) == want  # nothing new
    with pytest.raises(ValueError, match="belongs to the stream"):
        metered(spark, tmp_path, "another")


def test_meter_merges_its_batches(frame, spark, tmp_path):
    want, out = 0, tmp_path / "out"
    for i in range(50):
        land(frame, tmp_path / "land", [(datetime(2024, 1, 1 + i % 3), "a", i), (datetime(2024, 1, 1), f"s{i % 4}", 1)])
        want += i + 1
    got = metered(spark, tmp_path, merge_every=5)
    assert sum(n for _, _, n in got) == want and len(got) == 3 + 4
    assert len(list(out.glob("batch=*"))) <= 10 and len(list((out / "_base").glob("upto=*"))) <= 2
    assert len(batches._read(spark, str(out))[0].inputFiles()) <= 10


def test_repeated_batch_adds_nothing(frame, spark, tmp_path):
    """A batch run again after its base was written, or over its own folder."""
    rows = frame([("d", "a", 1, Decimal(1))], "day string, session_id string, tokens bigint, cost_usd decimal(18,6)")
    out = str(tmp_path / "out")
    for n in (0, 1, 1):
        rows.write.mode("overwrite").parquet(f"{out}/batch={n}")
    batches.merge(spark, out, meter.add_totals)
    batches.merge(spark, out, meter.add_totals)
    assert meter.read_meter(spark, out).first().tokens == 2
    rows.write.mode("overwrite").parquet(f"{out}/batch=2")
    assert meter.read_meter(spark, out).first().tokens == 3


def test_broken_pages_are_named(spark, tmp_path):
    folder = tmp_path / "endpoint=dir" / "year=2020"
    folder.mkdir(parents=True)
    (folder / "good.json").write_text('{"results": [{"a": 1}]}\n{"results": []}\n')
    pages = readers.landed_pages(spark, str(tmp_path))
    assert readers.json_pages(pages).count() == 1 and readers.broken_pages(pages).count() == 0
    (folder / "cut.json").write_text('{"results": [{"a": 1}, {"a"\n{"count": 3}\nnot json\n')
    pages = readers.landed_pages(spark, str(tmp_path))
    with pytest.raises(Exception, match="cut.json"):
        readers.json_pages(pages).collect()
    assert readers.json_pages(pages, skip_broken=True).count() == 1
    broken = readers.broken_pages(pages).collect()
    assert len(broken) == 3 and all(r.file.endswith("cut.json") and r.endpoint == "dir" and r.year == 2020 for r in broken)


def test_ingest_reads_touched_partitions_only(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("cast(id as string) data_hash", "cast(2000 + id % 10 as int) year")
    writers.insert_if_absent(rows, target)
    stored = spark.read.parquet(target).where(F.col("year").isin([2003]))
    assert len(stored.inputFiles()) >= 1
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2003" in plan
    writers.insert_if_absent(rows.where("year = 2003"), target, touched=[2003])
    assert spark.read.parquet(target).count() == 100


def test_live_stats_merge_batches(frame, spark, tmp_path):
    rows = [("MI", float(i), float((i * 7) % 13)) for i in range(30)] + [("OH", 0.1, float(i)) for i in range(9)] + [("", 1.0, 1.0)]
    schema = "state string, x double, y double"
    land = tmp_path / "land"
    for part in range(3):
        frame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(str(land))
    stream = ingest.landed_stream(spark, str(land), schema, files_per_batch=1)
    live.live_stats(stream, ["state"], "x", "y", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r.state: r for r in live.read_live(spark, str(tmp_path / "out"), ["state"]).collect()}
    whole = frame(rows, schema).where("state <> ''").groupBy("state").agg(
        F.regr_r2("y", "x").alias("r2"), F.round(F.avg("y"), 2).alias("m"), F.count(F.lit(1)).alias("n"))
    want = {r.state: r for r in whole.collect()}
    assert set(got) == {"MI", "OH"} and got["OH"].pearson_r is None
    assert got["MI"].pearson_r ** 2 == pytest.approx(want["MI"].r2, abs=1e-3)
    assert got["MI"].school_count == want["MI"].n and got["MI"].avg_math_pct_prof == want["MI"].m


def test_null_partitions_are_stored_once(frame, spark, tmp_path):
    rows = frame([("a", 2020), ("b", None), ("c", None), ("b", None), (None, None)], "data_hash string, year int")
    for name, how in (("t", {}), ("u", {"touched": [2020, None]}), ("v", {"buckets": 3})):
        for _ in range(3):
            writers.insert_if_absent(rows, str(tmp_path / name), **how)
        got = spark.read.parquet(str(tmp_path / name)).collect()
        assert sorted((r.data_hash or "", r.year or 0) for r in got) == [("", 0), ("a", 2020), ("b", 0), ("c", 0)]
    only = str(tmp_path / "w")  # a table of null partitions alone
    for _ in range(2):
        writers.insert_if_absent(rows.where("year is null"), only)
    assert spark.read.parquet(only).count() == 3
    with pytest.raises(Exception, match="outside the touched"):
        writers.insert_if_absent(frame([("z", None)], "data_hash string, year int"), only, touched=[2020])


def test_buckets_that_cannot_hold_a_key_are_not_read(spark, tmp_path, monkeypatch):
    target, read = str(tmp_path / "t"), []
    rows = spark.range(200).selectExpr("cast(id as string) data_hash", "cast(if(id % 5 = 0, null, 2000) as int) year")
    writers.insert_if_absent(rows, target, buckets=16)
    plain = writers.not_stored
    monkeypatch.setattr(writers, "not_stored", lambda new, stored, keys: read.append(stored) or plain(new, stored, keys))
    writers.insert_if_absent(rows.where("data_hash in ('7', '8')"), target, buckets=16)
    assert spark.read.parquet(target).count() == 200
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and writers.BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < read[0].select("data_hash").distinct().count() < 60
    with pytest.raises(ValueError, match="laid out in buckets"):
        writers.insert_if_absent(rows, target)


def test_ingest_stream_with_null_years_is_repeatable(frame, spark, tmp_path):
    land, target = str(tmp_path / "land"), str(tmp_path / "t")
    schema = "data_hash string, year int"
    frame([("a", 2020), ("b", None)], schema).write.parquet(land)
    for checkpoint in ("c1", "c2"):
        for _ in range(2):
            ingest.ingest_stream(ingest.landed_stream(spark, land, schema), target, str(tmp_path / checkpoint)).awaitTermination()
    assert sorted((r.data_hash, r.year) for r in spark.read.parquet(target).collect()) == [("a", 2020), ("b", None)]


STATE = "data_hash string, year int, at timestamp"


def by_state(spark, tmp_path, **how):
    rows = ingest.landed_stream(spark, str(tmp_path / "land"), STATE, files_per_batch=1)
    query = ingest.ingest_by_state(rows, str(tmp_path / "t"), str(tmp_path / "cp"), **how)
    query.awaitTermination()
    return query, sorted((r.data_hash, r.year) for r in ingest.read_ingested(spark, str(tmp_path / "t")).collect())


def test_ingest_by_state(frame, spark, tmp_path):
    """Goes on after a restart, and a batch that was written but not committed leaves nothing twice."""
    def add(*rows):
        frame([(k, y, datetime(2024, 1, 1)) for k, y in rows], STATE).coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))

    add(("a", 2020), ("b", None), ("a", 2020))
    assert by_state(spark, tmp_path)[1] == [("a", 2020), ("b", None)]
    add(("b", None), ("c", 2021))
    query, got = by_state(spark, tmp_path)
    assert got == [("a", 2020), ("b", None), ("c", 2021)]
    operator = query.lastProgress["stateOperators"][0]
    assert operator["numRowsTotal"] == 3 and "rocksdbCommitCheckpointLatency" in operator["customMetrics"]
    # the last batch ends after its write and before its commit
    commits = tmp_path / "cp" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    add(("c", 2021), ("d", None))
    assert by_state(spark, tmp_path)[1] == [("a", 2020), ("b", None), ("c", 2021), ("d", None)]
    with pytest.raises(ValueError, match="belongs to the stream"):
        ingest.ingest_by_state(ingest.landed_stream(spark, str(tmp_path / "land"), STATE), str(tmp_path / "t"), "other")


def test_ingest_by_state_with_a_horizon(frame, spark, tmp_path):
    """State older than the horizon is given up; a key within it is stored once."""
    for day in (1, 2, 20, 21, 22):
        frame([("a", 2020, datetime(2024, 1, day)), (f"k{day}", 2020, datetime(2024, 1, day))], STATE).coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))
    query, got = by_state(spark, tmp_path, event_time="at", horizon="3 days")
    assert sorted(k for k, _ in got if k != "a") == ["k1", "k2", "k20", "k21", "k22"]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 6


def test_of_the_store_only_keys_of_the_batch_are_shuffled(spark, tmp_path, monkeypatch):
    read, plain = [], writers.not_stored
    monkeypatch.setattr(writers, "not_stored", lambda new, stored, keys: read.append(stored.count()) or plain(new, stored, keys))
    rows = spark.range(400).selectExpr("if(id = 399, null, cast(id as string)) data_hash", "cast(if(id % 5 = 0, null, 2000 + id % 3) as int) year")
    batch = "data_hash in ('7', '8', '395') or data_hash is null"
    for name, most, wanted in (("sent", writers.MOST_SENT, 4), ("whole", 3, 400)):
        monkeypatch.setattr(writers, "MOST_SENT", most)
        for how in ({}, {"rows": 4}):
            target = str(tmp_path / f"{name}{len(how)}")
            writers.insert_if_absent(rows, target)
            more = rows.where(batch).unionByName(spark.createDataFrame([("new", 2001), ("new", 2001)], rows.schema))
            writers.insert_if_absent(more.where("data_hash <> 'new' or data_hash is null"), target, **how)
            assert read.pop() == wanted and spark.read.parquet(target).count() == 400
            writers.insert_if_absent(more, target)
            got = spark.read.parquet(target)
            assert read.pop() == wanted and got.count() == 401 and got.where("data_hash = 'new' and year = 2001").count() == 1
