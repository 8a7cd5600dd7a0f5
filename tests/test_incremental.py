"""Rebuilding only the days of changed files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickwise.sources import incremental

SCHEMA = "k int, day date, v double"
DAYS = [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(6)]


def _put(spark, folder, name, rows):
    path = f"{folder}/in/{name}"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def _read(s, paths):
    return s.read.schema(SCHEMA).parquet(*paths)


def _build(rows):
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


def _run(spark, folder):
    return incremental.rebuild(spark, f"{folder}/in", f"{folder}/out", _read, _build)


def _table(spark, folder):
    return {r.day: (r.n, r.total) for r in spark.read.parquet(f"{folder}/out").collect()}


def _full(spark, folder):
    files = [r.path for r in incremental.source_files(spark, f"{folder}/in").collect()]
    return {r.day: (r.n, r.total) for r in _build(_read(spark, files)).collect() if r.day}


def _stamps(folder):
    out = {}
    for name in os.listdir(f"{folder}/out"):
        if name.startswith("day="):
            out[name[4:]] = sorted((f, os.stat(f"{folder}/out/{name}/{f}").st_mtime_ns)
                                   for f in os.listdir(f"{folder}/out/{name}"))
    return out


def test_only_the_days_of_changed_files_are_built(spark, tmp_dir):
    # days 0-1 in a, 1-2 in b, 3 in c (with a row that has no day), odd name in d
    _put(spark, tmp_dir, "a", [(1, DAYS[0], 1.0), (2, DAYS[1], 2.0), (2, DAYS[1], 2.0)])
    _put(spark, tmp_dir, "b", [(3, DAYS[1], 3.0), (4, DAYS[2], None)])
    _put(spark, tmp_dir, "c", [(5, DAYS[3], 5.0), (5, None, 5.0)])
    _put(spark, tmp_dir, "d %41 ü", [(6, DAYS[4], 6.0)])
    assert _run(spark, tmp_dir) == DAYS[:5]
    assert _table(spark, tmp_dir) == _full(spark, tmp_dir)
    before = _stamps(tmp_dir)
    assert _run(spark, tmp_dir) == [] and _stamps(tmp_dir) == before

    _put(spark, tmp_dir, "b", [(3, DAYS[1], 30.0), (7, DAYS[5], 7.0)])     # leaves day 2, enters day 5
    assert _run(spark, tmp_dir) == [DAYS[1], DAYS[2], DAYS[5]]
    assert _table(spark, tmp_dir) == _full(spark, tmp_dir) and DAYS[2] not in _table(spark, tmp_dir)
    after = _stamps(tmp_dir)
    for d in (DAYS[0], DAYS[3], DAYS[4]):
        assert after[str(d)] == before[str(d)]
    assert after[str(DAYS[1])] != before[str(DAYS[1])]

    os.rename(f"{tmp_dir}/in/a", f"{tmp_dir}/a-gone")                      # a source file goes
    assert _run(spark, tmp_dir) == [DAYS[0], DAYS[1]]
    assert _table(spark, tmp_dir) == _full(spark, tmp_dir)


def test_a_failed_run_is_repeated(spark, tmp_dir):
    _put(spark, tmp_dir, "a", [(1, DAYS[0], 1.0)])
    _run(spark, tmp_dir)
    _put(spark, tmp_dir, "b", [(2, DAYS[1], 2.0)])

    def broken(rows):
        raise RuntimeError("in the build")

    with pytest.raises(RuntimeError):
        incremental.rebuild(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", _read, broken)
    assert _run(spark, tmp_dir) == [DAYS[1]]
    assert _table(spark, tmp_dir) == _full(spark, tmp_dir)


def test_files_without_rows(spark, tmp_dir):
    _put(spark, tmp_dir, "a", [(1, None, 1.0)])
    assert _run(spark, tmp_dir) == [] and _run(spark, tmp_dir) == []
