"""Windows kept as state, balanced elements, computed folders, discovered schemas, bitmaps that add up."""

from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import extract, kept, quality
from millrace.operators.aggregates import add_parts, distinct_counts, distinct_parts
from millrace.operators.incremental import new_rows
from millrace.sinks import tables as sinks
from millrace.sources import catalog, files
from millrace.streaming import landing


def windows_of(spark, folder, deliveries):
    """Runs the stream once per delivery; the counts so far, and the last progress with state of each run."""
    schema, seen = "id int, at timestamp", []
    for times in deliveries:
        spark.createDataFrame([(k, t) for k, t in enumerate(times)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = landing.land_windows(landing.windowed_counts(stream, "at"), f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
        states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        seen.append((sum(s["numRowsDroppedByWatermark"] for s in states), states[-1]["numRowsTotal"]))
    rows = spark.read.schema("window_start timestamp, total_streams bigint").parquet(f"{folder}/out").collect()
    return sorted((r[0].hour, r[1]) for r in rows), seen


def test_windows_close_once_and_drop_late_rows(spark, tmp_path):
    at = lambda hour, minute=0: datetime(2024, 3, 5, hour, minute)
    deliveries = [[at(1), at(1, 30), at(2), None, at(5)], [at(4, 59), at(1, 5), at(5, 1)], [at(9, 30)], [at(4)]]
    rows, seen = windows_of(spark, tmp_path, deliveries)
    # At five, hours that end by four are closed: one and two. The row of 1:05 is late, that of 4:59 is not.
    assert rows == [(1, 2), (2, 1), (4, 1), (5, 2)]
    assert [dropped for dropped, _ in seen] == [0, 1, 0, 1]
    assert all(open_ <= 2 for _, open_ in seen)


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    days = [[datetime(2024, 3, day, hour, m) for hour in range(24) for m in (0, 20, 40)] for day in range(1, 5)]
    rows, seen = windows_of(spark, tmp_path, days)
    assert len(rows) == 4 * 24 - 2 and all(n == 3 for _, n in rows)
    assert all(open_ <= 2 and not dropped for dropped, open_ in seen)


def outermost(markup, tag):
    """Reference: a cursor over the tags."""
    import re
    out, depth, begin = [], 0, 0
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])([^>]*)>", markup, re.I):
        closes, alone = bool(m[1]), not m[1] and m[0].endswith("/>")
        if closes and m[2].strip():
            continue
        if alone:
            out += [""] if depth == 0 else []
        elif not closes:
            begin = m.end() if depth == 0 else begin
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                out.append(markup[begin : m.start()])
    return out + ([markup[begin:]] if depth else [])


MARKUP = st.lists(st.sampled_from(["<div>", "</div>", '<DIV class="a">', "</Div >", "<divs>", "</divs>", "<div/>", "x", " \n", "<p>", "é", "<", "&gt;"]), max_size=14)


@settings(max_examples=15, deadline=None)
@given(cases=st.lists(MARKUP, min_size=1, max_size=30))
def test_nested_elements_equal_a_cursor(spark, cases):
    texts = ["".join(c) for c in cases]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    got = df.select("id", extract.nested_elements(F.col("html"), "div").alias("e")).orderBy("id").collect()
    assert [list(r["e"]) for r in got] == [outermost(t, "div") for t in texts]


def test_nested_elements_edges(spark):
    df = spark.createDataFrame([(None,), ("",), ("<div><div>a</div>b</div><div>c",)], "html string")
    e, first = extract.nested_elements(F.col("html"), "div"), extract.nested_element(F.col("html"), "div")
    assert [tuple(r) for r in df.select(e, first).collect()] == [(None, None), ([], None), (["<div>a</div>b", "c"], "<div>a</div>b")]


@settings(max_examples=60, deadline=None)
@given(a=st.datetimes(datetime(2022, 11, 1), datetime(2024, 3, 3)), hours=st.integers(0, 9000))
def test_covering_folders_hold_the_hours_of_the_range(a, hours):
    from datetime import timedelta
    start = a.replace(minute=0, second=0, microsecond=0)
    names = files.covering_folders(a, start + timedelta(hours=hours))
    want = {f"{start + timedelta(hours=k):year=%Y/month=%m/day=%d/hour=%H}" for k in range(hours)}
    held = {w: [n for n in names if w == n or w.startswith(n + "/")] for w in want}
    assert all(len(n) == 1 for n in held.values())
    outside = [f"{start + timedelta(hours=k):year=%Y/month=%m/day=%d/hour=%H}" for k in (-1, hours)]
    assert not [n for n in names for o in outside if o == n or o.startswith(n + "/")]
    assert len(names) <= 2 * (23 + 30 + 11) + 2


def test_declared_ranges_read_computed_folders_only(spark, tmp_path):
    rows = [(k, f"2024-03-{d:02d} {h:02d}:10:00") for k, (d, h) in enumerate((d, h) for d in (1, 2, 4) for h in (0, 5, 23))]
    df = spark.createDataFrame(rows, "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    from millrace.sinks.files import write_by_time
    write_by_time(df, str(tmp_path), F.col("at"), "hourly", "parquet")
    schema = "id int, at timestamp_ntz, year string, month string, day string, hour string"
    read = lambda *a, **k: files.read_declared(spark, str(tmp_path), schema, *a, **k)
    found = read(datetime(2024, 3, 1, 5), datetime(2024, 3, 4, 5))
    assert sorted((r["id"], r["day"], r["hour"]) for r in found.collect()) == [
        (1, "01", "05"), (2, "01", "23"), (3, "02", "00"), (4, "02", "05"), (5, "02", "23"), (6, "04", "00")]
    opened = found.inputFiles()
    assert len(opened) == 6 and not [f for f in opened if "day=04/hour=05" in f or "day=01/hour=00" in f]
    assert read(datetime(2023, 1, 1), datetime(2025, 1, 1), declared=(datetime(2024, 3, 2), datetime(2024, 3, 4))).count() == 3
    assert read(datetime(2030, 1, 1), datetime(2030, 1, 2)).count() == 0
    assert read(datetime(2024, 3, 2), datetime(2024, 3, 1)).columns == ["id", "at", "year", "month", "day", "hour"]


def test_widest_types():
    i, n, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert [catalog.widest(*p) for p in ((i, n), (n, i), (i, T.FloatType()), (n, d), (d, s), (T.NullType(), i), (T.BooleanType(), i))] == [n, n, d, d, s, i, s]
    assert catalog.widest(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert catalog.widest(T.ByteType(), T.ShortType()) == T.ShortType()
    for a in (i, n, d, s, T.FloatType(), T.DateType()):
        for b in (i, n, d, s, T.FloatType(), T.DateType()):
            assert catalog.widest(a, b) == catalog.widest(b, a)


def test_discovery_reads_new_files_only(spark, tmp_path):
    folder, name = str(tmp_path / "in"), "discovered_in_tests"
    write = lambda df, k: df.coalesce(1).write.parquet(f"{folder}/{k}")
    write(spark.range(3).selectExpr("CAST(id AS INT) AS id", "'x' AS only_here"), 1)
    write(spark.range(3).selectExpr("id + 10 AS ID", "DATE'2024-01-01' AS at"), 2)
    assert len(catalog.discover(spark, name, folder)) == 2
    assert dict(spark.table(name).dtypes) == {"id": "bigint", "only_here": "string", "at": "date"}
    assert catalog.discover(spark, name, folder) == []
    for k in range(3, 9):
        write(spark.range(1).selectExpr("id + 0.5D AS id", "TIMESTAMP_NTZ'2024-01-01 05:00:00' AS at"), k)
    fresh = catalog.discover(spark, name, folder)
    assert len(fresh) == 6 and all("/in/1/" not in f and "/in/2/" not in f for f in fresh)
    got = spark.table(name)
    assert dict(got.dtypes) == {"id": "double", "only_here": "string", "at": "timestamp_ntz"}
    assert sorted(r["id"] for r in got.collect()) == [0, *[0.5] * 6, 1, 2, 10, 11, 12] and got.where("only_here = 'x'").count() == 3
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3
    spark.sql(f"DROP VIEW {name}")
    with pytest.raises(Exception):
        catalog.discover(spark, name, str(tmp_path / "nothing"))


def test_bitmaps_add_up(spark):
    rows = [(d, g, u) for d in range(5) for g in "ab" for u in (None, d, d, d + 1, 40_000 * d, -7, 2**40)]
    df = spark.createDataFrame(rows, "day int, g string, u bigint")
    stored, new = distinct_parts(df.where("day < 4"), "u", ["day", "g"]), distinct_parts(df.where("day = 4"), "u", ["day", "g"])
    parts = stored.unionByName(new)
    want = df.agg(F.count_distinct("u")).first()[0]
    assert distinct_counts(parts, [], "n").first()["n"] == want
    assert distinct_counts(add_parts(parts, ["g"]), [], "n").first()["n"] == want
    for by in (["g"], ["day"], ["day", "g"]):
        expected = sorted(tuple(r) for r in df.groupBy(*by).agg(F.count_distinct("u")).collect())
        assert sorted(tuple(r) for r in distinct_counts(parts, by, "n").collect()) == expected
    assert distinct_counts(distinct_parts(df.limit(0), "u", []), [], "n").first()["n"] == 0


def test_merges_rewrite_touched_ranges_only(spark, tmp_path):
    import os

    from millrace.operators import stored
    from millrace.operators.upsert import merge

    folder, schema = str(tmp_path), "k bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = [(k, "old", datetime(2020, 1, 1), datetime(2020, 1, 1)) for k in range(0, 50, 2)] + [(None, "old", None, None)]
    target = spark.createDataFrame(old, schema)
    stored.store(target, folder, "k", 10)
    files_of = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder)
                        for f in names if f.endswith(".parquet")}
    before = files_of()
    source = spark.createDataFrame([(12, "new"), (13, "new"), (71, "new")], "k bigint, v string")
    at = datetime(2024, 5, 1)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    want = rows(merge(target, source, ["k"], "created_updated", at))
    for _ in range(2):  # a repeated merge gives the same rows
        assert stored.merge_stored(spark, folder, target.schema, source, ["k"], 10, "created_updated", at) == [1, 7]
        found = rows(stored.read_stored(spark, folder, target.schema).drop(stored.PART))
        assert [r[:2] for r in found] == [r[:2] for r in want] and {r for r in found if r[0] not in (13, 71)} == {r for r in want if r[0] not in (13, 71)}
    after = files_of()
    assert all(after.get(f) == t for f, t in before.items() if "key_range=1/" not in f)
    assert not [f for f in before if "key_range=1/" in f and f in after]
    assert stored.merge_stored(spark, folder, target.schema, source.limit(0), ["k"], 10) == [] and files_of() == after
    nulls = spark.createDataFrame([(None, "more")], "k bigint, v string")
    assert stored.merge_stored(spark, folder, target.schema, nulls, ["k"], 10) == [None]
    assert stored.read_stored(spark, folder, target.schema).where("k IS NULL").count() == 2


def test_a_bad_record_fails_its_batch(spark, tmp_path):
    from millrace.streaming.sources import read_arrivals

    for part in ([(1, "ok"), (2, "bad"), (3, None)], [(4, "ok"), (5, None)]):
        spark.createDataFrame(part, "id int, kind string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_arrivals(spark, f"{tmp_path}/in", "id int, kind string", "parquet", 1)
    write = landing.all_or_nothing(landing.to_folder(f"{tmp_path}/ok"), landing.to_folder(f"{tmp_path}/bad"), F.col("kind") == "bad")
    landing.write_batches(stream, f"{tmp_path}/state", write).awaitTermination()
    ids = lambda name: sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/{name}").collect())
    assert (ids("bad"), ids("ok")) == ([1, 2, 3], [4, 5])
    write(spark.read.parquet(f"{tmp_path}/in").where("id < 4"), "again")  # a repeated batch replaces itself
    write(spark.read.parquet(f"{tmp_path}/in").where("id < 4"), "again")
    assert ids("bad") == [1, 1, 2, 2, 3, 3] and ids("ok") == [4, 5]


def test_no_batch_has_more_records_than_the_bound(spark, tmp_path):
    from millrace.streaming.sources import read_arrivals

    landing.land_bounded(spark.range(23).coalesce(1), f"{tmp_path}/in", 5)
    stream = read_arrivals(spark, f"{tmp_path}/in", "id bigint", "parquet", 1)
    landing.write_batches(stream, f"{tmp_path}/state", landing.counted(landing.to_folder(f"{tmp_path}/out"), f"{tmp_path}/counts")).awaitTermination()
    counts = [r["records"] for r in landing.batch_counts(spark, f"{tmp_path}/counts").collect()]
    assert max(counts) <= 5 and sum(counts) == 23


def test_lanes_of_bounded_batches_run_side_by_side(spark, tmp_path):
    import threading

    from millrace.streaming.sources import read_arrivals

    def run(name, write):
        landing.write_lanes(
            lambda lane: read_arrivals(spark, lane, "id bigint", "parquet", 1), f"{tmp_path}/{name}", 4, f"{tmp_path}/{name}_state", write)

    landing.land_bounded(spark.range(0, 230, 1, 3), f"{tmp_path}/in", 5, 4)
    lanes = [spark.read.schema("id bigint").parquet(p).count() for p in landing.lane_folders(f"{tmp_path}/in", 4)]
    assert sum(lanes) == 230 and max(lanes) - min(lanes) <= 15
    together, refused = threading.Barrier(4, timeout=60), []
    write = landing.counted(landing.to_folder(f"{tmp_path}/out"), f"{tmp_path}/counts")

    def met(batch, label):
        if label.endswith("-0"):  # the first batch of each lane waits for those of the others
            together.wait()
        if label.endswith("-2") and not refused:
            refused.append(label)
            raise ValueError("refused once")
        write(batch, label)

    with pytest.raises(Exception, match="refused once"):
        run("in", met)
    assert not spark.streams.active
    run("in", lambda batch, label: write(batch, label))
    counts = [r["records"] for r in landing.batch_counts(spark, f"{tmp_path}/counts").collect()]
    assert max(counts) <= 5 and sum(counts) == 230
    assert sorted(r["id"] for r in spark.read.schema("id bigint").parquet(f"{tmp_path}/out").collect()) == list(range(230))
    landing.land_bounded(spark.range(0), f"{tmp_path}/none", 5, 4)
    run("none", landing.counted(landing.to_folder(f"{tmp_path}/out2"), f"{tmp_path}/counts2"))
    assert landing.batch_counts(spark, f"{tmp_path}/counts2").collect() == []


def test_a_count_of_records_takes_no_job(spark, tmp_path):
    def jobs(name, write):
        spark.sparkContext.setJobGroup(name, "")
        write(spark.range(7), "a")
        write(spark.range(3), "a")  # a repeated batch replaces its count
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    plain = jobs("plain", landing.to_folder(f"{tmp_path}/plain"))
    assert jobs("counted", landing.counted(landing.to_folder(f"{tmp_path}/out"), f"{tmp_path}/counts")) == plain
    assert [tuple(r) for r in landing.batch_counts(spark, f"{tmp_path}/counts").collect()] == [("a", 3)]


def test_a_failing_load_leaves_the_published_table(spark, tmp_path):
    schema, name = "k int, v string", "published_test"
    checks = [quality.not_null("k"), quality.accepted_values("v", ["a", "b"])]

    def load(rows, k):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in{k}")
        return spark.read.parquet(f"{tmp_path}/in{k}")

    with pytest.raises(quality.CheckFailed):
        sinks.publish(load([(None, "a")], 0), name, f"{tmp_path}/0", checks)
    assert not spark.catalog.tableExists(name)
    first = load([(1, "a"), (2, None)], 1)
    context = spark.sparkContext
    context.setJobGroup("publish", "")
    assert sinks.publish(first, name, f"{tmp_path}/1", checks) == 2
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("publish")) == 1
    with pytest.raises(quality.CheckFailed) as failed:
        sinks.publish(load([(None, "a"), (None, "c"), (3, "b")], 2), name, f"{tmp_path}/2", checks)
    assert failed.value.failures == {"not_null_k": 2, "accepted_values_v": 1}
    assert sorted(spark.table(name).collect()) == sorted(first.collect())
    assert all("/1/" in f for f in spark.table(name).inputFiles())
    with pytest.raises(ValueError):
        sinks.publish(first.withColumn("w", F.lit(1)), name, f"{tmp_path}/3", checks)
    assert sinks.publish(load([(4, "b")], 4), name, f"{tmp_path}/4", checks) == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [(4, "b")]
    assert sinks.publish(load([], 5), name, f"{tmp_path}/5", checks) == 0
    assert spark.table(name).count() == 0
    assert sinks.publish(spark.createDataFrame([], schema), name, f"{tmp_path}/6", checks) == 0
    spark.sql(f"DROP TABLE {name}")


def test_counts_grow_by_new_rows_only(spark, tmp_path):
    def run(rows, folder=f"{tmp_path}/counts"):
        df = spark.createDataFrame(rows, "k string, at int")
        return sorted(((r[0] or "", r[1]) for r in kept.add_counts(df, folder, ["k"], "at", "n").collect()))

    def files_of(folder=f"{tmp_path}/counts"):
        return {f: f.stat().st_mtime_ns for f in Path(folder).glob("*.parquet")}

    assert run([]) == [] and not files_of(tmp_path)
    old = [("a", 1), ("a", 2), (None, 2), ("b", 3), ("b", None)]
    assert run(old) == [("", 1), ("a", 2), ("b", 1)]
    before = files_of()
    # Nothing new, and a row that ties with the mark: no count changes and no file appears.
    assert run([*old, ("a", 3)]) == [("", 1), ("a", 2), ("b", 1)] and files_of() == before
    # Old rows need not be there any more: only what is beyond the mark is read.
    assert run([("a", 4), ("c", 9)]) == [("", 1), ("a", 3), ("b", 1), ("c", 1)]
    assert before.items() <= files_of().items()
    kept.compact_counts(spark, f"{tmp_path}/counts", f"{tmp_path}/one", ["k"], "n")
    assert run([("a", 9), ("b", 10)], f"{tmp_path}/one") == [("", 1), ("a", 3), ("b", 2), ("c", 1)]


def test_the_mark_of_kept_counts_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 AS k", "id AS at").write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    kept.add_counts(rows.filter("at < 60"), f"{tmp_path}/counts", ["k"], "at", "n")
    mark = spark.read.parquet(f"{tmp_path}/counts").select(F.col(kept.UPTO).alias("at"))
    plan = new_rows(rows, mark, "at")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at,59)" in plan
    assert sorted(kept.add_counts(rows, f"{tmp_path}/counts", ["k"], "at", "n").collect()) == [(0, 34), (1, 33), (2, 33)]
