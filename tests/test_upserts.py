"""Merges, change detection, incremental loads and the run log."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace import session
from millrace.operators import incremental, upsert

AT, BEFORE = datetime(2024, 5, 1), datetime(2020, 1, 1)
KV = "k int, v string"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_changes(spark):
    target = spark.createDataFrame(
        [(1, None, None, 5), (2, "a", 1.0, 5), (3, "x", 0.0, 5)], "k int, s string, n double, c int")
    staging = spark.createDataFrame(
        [(1, "", 0.0, 5), (2, "b", 1.0, 5), (3, "x", None, 6), (4, "n", None, 5), (None, "z", None, 5)],
        "k int, s string, n double, c int")
    changed = upsert.detect_changes(staging, target, "k", ignore=("c",))
    assert sorted((r.k is None, r.k, r.RECORD_STATUS) for r in changed.collect() if r.k) == [
        (False, 2, "U"), (False, 4, "I")]
    assert [r.RECORD_STATUS for r in changed.collect() if r.k is None] == ["I"]


def test_changes_of_dates_and_flags(spark):
    kinds = "k int, t timestamp_ntz, d date, b boolean, m decimal(10,2)"
    old = spark.createDataFrame([(1, None, None, None, None), (2, AT, AT.date(), True, None)], kinds)
    new = spark.createDataFrame([(1, None, None, False, None), (2, BEFORE, AT.date(), True, None)], kinds)
    assert [(r.k, r.RECORD_STATUS) for r in upsert.detect_changes(new, old, "k").collect()] == [(2, "U")]


def test_merge_stamps(spark):
    target = spark.createDataFrame(
        [(1, "a", BEFORE, BEFORE), (None, "n", BEFORE, BEFORE)],
        "k int, v string, created_at timestamp_ntz, updated_at timestamp_ntz")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (None, "m")], KV)
    merged = upsert.merge(target, source, ["k"], "created_updated", AT)
    assert rows(merged) == sorted(
        [(1, "b", BEFORE, AT), (2, "c", AT, AT), (None, "m", AT, AT), (None, "n", BEFORE, BEFORE)], key=repr)
    assert merged.dtypes == target.dtypes


def test_merge_takes_created_at_from_source(spark):
    target = spark.createDataFrame([(1, BEFORE, BEFORE)], "k int, created_at timestamp_ntz, updated_at timestamp_ntz")
    source = spark.createDataFrame([(1, AT)], "k int, created_at timestamp_ntz")
    assert rows(upsert.merge(target, source, ["k"], "created_updated", AT)) == [(1, AT, AT)]


def test_duplicate_source_key(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, at int")
    with pytest.raises(upsert.RepeatedKey, match="more than one source row"):
        upsert.merge(target, twice.drop("at"), ["k"])
    assert rows(upsert.merge(target, twice, ["k"], latest_by="at")) == [(1, "y")]


def test_merge_updates_every_target_row_of_a_key(spark):
    target = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], KV)
    source = spark.createDataFrame([(1, "z"), (3, "c")], KV)
    assert rows(upsert.merge(target, source, ["k"])) == sorted([(1, "z")] * 50 + [(2, "b"), (3, "c")], key=repr)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    source = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], KV)
    assert rows(upsert.insert_if_absent(target, source, ["k"], None)) == sorted(
        [(1, "a"), (2, "y"), (None, "z")], key=repr)


def test_apply_flagged_empty(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    none = spark.createDataFrame([], KV + ", RECORD_STATUS string")
    assert rows(upsert.apply_flagged(target, none, ["k"])) == [(1, "a")]


pairs = st.dictionaries(st.integers(0, 8), st.sampled_from(["", "a", "b", None]), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_upsert_is_idempotent(spark, old, new):
    target = spark.createDataFrame(list(old.items()), KV)
    staging = spark.createDataFrame(list(new.items()), KV)
    once = spark.createDataFrame(upsert.upsert(target, staging, "k").collect(), KV)
    assert upsert.detect_changes(staging, once, "k").count() == 0
    expected = dict(old)
    expected.update({k: v for k, v in new.items() if k not in old or (v or "") != (old[k] or "")})
    assert rows(once) == sorted(expected.items(), key=repr)


@pytest.mark.parametrize("limit", [1000, 0])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_merge_equals_dictionary_update(spark, limit, old, new):
    target, source = spark.createDataFrame(list(old.items()), KV), spark.createDataFrame(list(new.items()), KV)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(upsert, "BROADCAST_ROWS", limit)
        merged = upsert.merge(target, source, ["k"])
        assert rows(merged) == sorted({**old, **new}.items(), key=repr)
        assert ("SortMergeJoin" in merged._jdf.queryExecution().toString()) == (limit < len(new))


def test_new_rows(spark):
    source = spark.createDataFrame([(9,), (10,), (11,)], "ts bigint")
    target = spark.createDataFrame([(10,)], "ts bigint")
    assert rows(incremental.new_rows(source, target, "ts")) == [(11,)]
    assert rows(incremental.new_rows(source, target, "ts", late="include_ties")) == [(10,), (11,)]
    assert incremental.new_rows(source, target.limit(0), "ts").count() == 3
    assert incremental.new_rows(source, None, "ts").count() == 3
    with pytest.raises(ValueError):
        incremental.new_rows(source, target, "ts", late="maybe")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "string"])
def test_mark_in_another_zone(spark, kind):
    texts = [f"2024-03-{d:02d}" for d in range(1, 21)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        source = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"CAST(t AS {kind}) AS ts")
        target = source.limit(0).union(source.filter(f"ts <= CAST('2024-03-10' AS {kind})"))
        assert incremental.new_rows(source, target, "ts").count() == 10
        assert incremental.new_rows(source, target, "ts", late="include_ties").count() == 11
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_slices_equal_full_load(spark):
    source = spark.range(100).withColumnRenamed("id", "ts")
    target = None
    for upto in (10, 55, 100):
        target = incremental.load_increment(source.filter(f"ts < {upto}"), target, "ts")
    assert rows(target) == rows(source)


def test_run_log(spark):
    kinds = "PKG_NAME string, STATUS int, START_DT timestamp_ntz, END_DT timestamp_ntz, LAST_RUN_DT timestamp_ntz"
    log = spark.createDataFrame([("p", 1, BEFORE, BEFORE, BEFORE), ("q", 1, BEFORE, BEFORE, BEFORE)], kinds)
    running = incremental.begin_run(log, AT, "p")
    assert incremental.last_run(running, "p").first()[0] == BEFORE
    later = datetime(2024, 5, 2)
    done = incremental.finish_run(running, later)
    assert rows(done) == [("p", 1, AT, later, AT), ("q", 1, BEFORE, BEFORE, BEFORE)]
    assert done.dtypes == log.dtypes


def test_run_log_is_kept(spark, tmp_path):
    log = incremental.RunLog(spark, str(tmp_path / "log"))
    assert log.last_run("p") is None
    log.add(spark.createDataFrame([("p", 1, BEFORE, BEFORE, BEFORE)], incremental.RUN_LOG), BEFORE)
    log.begin("p", AT)
    assert log.last_run("p") == BEFORE and log.last_run("unknown") is None
    log.finish("p", datetime(2024, 5, 2))
    assert log.last_run("p") == AT
    assert rows(log.current()) == [("p", 1, AT, datetime(2024, 5, 2), AT)]


def test_latest_never_erases(spark):
    target = spark.createDataFrame([(1, "old", None)], "id int, name string, stamp int")
    changes = spark.createDataFrame([(1, "new", None), (2, "fresh", None), (3, "a", 1), (3, "b", 1), (3, "c", None)],
                                    target.schema)
    got = upsert.merge(target, changes, ["id"], latest_by="stamp")
    assert rows(got) == [(1, "new", None), (2, "fresh", None), (3, "b", 1)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_staging_leaves_a_large_target_in_place(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "md5(CAST(id AS STRING)) AS v").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(5, "x"), (-1, "y")], "id bigint, v string").write.parquet(str(tmp_path / "s"))
    target, staging = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        changes = upsert.detect_changes(staging, target, "id")
        scan = _plan(changes).split("BroadcastHashJoin [id")
        assert len(scan) > 1, _plan(changes)
        assert rows(changes) == [(-1, "y", "I"), (5, "x", "U")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_changes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 10_000)
    target = spark.range(50).selectExpr("id", "'a' AS v")
    changes = spark.range(40).selectExpr("id", "repeat('x', 1000) AS v")
    merged = upsert.merge(target, changes, ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Keys alone may still be broadcast.
        assert "LeftOuter, BuildRight" not in _plan(upsert.merge(target, changes, ["id"])) and merged.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_flags_are_an_error(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    for key, flag in ((1, "X"), (1, None), (None, "U")):
        changes = spark.createDataFrame([(key, "b", flag)], "id int, v string, RECORD_STATUS string")
        with pytest.raises(ValueError, match="RECORD_STATUS"):
            upsert.apply_flagged(target, changes, ["id"])
