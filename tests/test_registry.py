"""Keys over deliveries: a log of digests, and a table brought up to date split by split."""

import pytest

from carestitch.sinks import registry as R
from carestitch.sinks.registry import Registry, rekeyed, stage_increment, with_registered_id


def _table(spark, rows):
    return spark.createDataFrame(rows, "v string, w int, split string")


def _read(spark, path):
    return {(r.v, r.w, r.split): r.g_id for r in spark.read.schema("v string, w int, g_id bigint, split string").parquet(path).collect()}


def test_known_rows_keep_their_key_and_new_ones_get_unused_ones(spark, tmp_path):
    log = Registry(spark, f"{tmp_path}/log")
    rows = [(f"v{i}", i, None) for i in range(500)]
    first = {r.v: r.g_id for r in with_registered_id(_table(spark, rows), log).collect()}
    later = rows[100:] + [(f"n{i}", i, None) for i in range(300)] + [rows[100]]
    second = {r.v: r.g_id for r in with_registered_id(_table(spark, later), log).collect()}
    assert len(set(first.values())) == 500 and len(second) == 700 == len(set(second.values()))
    assert all(second[f"v{i}"] == first[f"v{i}"] for i in range(100, 500))
    assert not set(first.values()) & {second[f"n{i}"] for i in range(300)}
    third = {r.v: r.g_id for r in with_registered_id(_table(spark, rows), log).collect()}
    assert third == first  # rows that come back get their old key


def test_nulls_tell_rows_apart(spark, tmp_path):
    table = spark.createDataFrame([(None, "a"), ("a", None), (None, None), (None, "a")], "x string, y string")
    got = with_registered_id(table, Registry(spark, f"{tmp_path}/log")).collect()
    assert len(got) == 3 == len({r.g_id for r in got})


def test_only_changed_splits_are_written(spark, tmp_path):
    path, log = f"{tmp_path}/table", Registry(spark, f"{tmp_path}/log")
    rows = [(f"v{i}", i, "abc"[i % 3]) for i in range(90)] + [("x", 1, None), ("y", 2, None)]
    done = stage_increment(_table(spark, rows), path, log, "split")
    first = _read(spark, path)
    assert (done.added, done.gone, done.splits) == (92, 0, [None, "a", "b", "c"]) and set(first) == set(rows)
    files = {s: sorted(p.name for p in (tmp_path / "table" / f"split={s}").glob("*.parquet")) for s in ("a", "b", "c", "__HIVE_DEFAULT_PARTITION__")}
    later = [r for r in rows if r[2] not in ("c", None)] + [("new", 7, "b"), ("d", 0, "d")]
    done = stage_increment(_table(spark, later), path, log, "split")
    second = _read(spark, path)
    assert (done.added, done.gone, done.splits) == (2, 32, [None, "b", "c", "d"]) and set(second) == set(later)
    assert all(second[r] == first[r] for r in later if r in first) and len(set(second.values())) == len(second)
    now = {p.name[6:]: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "table").glob("split=*")}
    assert now["a"] == files["a"] and now["b"] != files["b"] and set(now) == {"a", "b", "d"}
    assert stage_increment(_table(spark, later), path, log, "split") == R.Increment(3, 0, 0, [])


def test_a_stopped_run_is_taken_up_again(spark, tmp_path, monkeypatch):
    path, log = f"{tmp_path}/table", Registry(spark, f"{tmp_path}/log")
    stage_increment(_table(spark, [("a", 1, "p")]), path, log, "split")
    rows = [("a", 1, "p"), ("b", 2, "q")]
    with monkeypatch.context() as broken:
        broken.setattr(R, "live_ids", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stage_increment(_table(spark, rows), path, log, "split")
    assert log.runs() == [1, 2] and log.pending() == [2]
    (tmp_path / "log" / "run-3").mkdir()  # a run that was stopped while it wrote its log
    done = stage_increment(_table(spark, rows), path, log, "split")
    assert done.splits == ["q"] and set(_read(spark, path)) == set(rows) and log.pending() == []


def test_staged_tables_get_registered_keys(spark, tmp_path):
    tables = {"t": spark.createDataFrame([(5, "a"), (6, "b")], "g_id bigint, s string"), "none": spark.createDataFrame([], "s string, g_id bigint")}
    one, two = ({n: sorted(map(tuple, df.collect())) for n, df in rekeyed(tables, f"{tmp_path}/keys/").items()} for _ in range(2))
    assert one == two and one["none"] == [] and [r[1] for r in sorted(one["t"], key=lambda r: r[1])] == ["a", "b"]
