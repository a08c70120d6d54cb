"""Several writers of one table, and the removal of what no version names."""

import threading

import pytest
from pyspark.sql import functions as F

from tickloom.sources import storage


def one(spark, value):
    return spark.createDataFrame([(value,)], "x int")


def days(spark, first, last, value):
    """Two bars a day of two symbols."""
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rows = spark.createDataFrame([("a",), ("b",)], "symbol string").select("symbol", day.alias("d"))
    ts = F.expr("cast(d AS timestamp_ntz) + make_dt_interval(0, h)")
    return rows.select("symbol", "d", F.explode(F.array(F.lit(10), F.lit(15))).alias("h")).select("symbol", ts.alias("bar_ts"), F.lit(float(value)).alias("close"))


def rows_of(spark, path):
    return sorted(storage.read_partitioned(spark, path).select("symbol", "bar_ts", "close").collect())


def test_no_update_is_lost(spark, tmp_path):
    root, errors = str(tmp_path / "shared"), []

    def add(value):
        try:
            for k in range(3):
                row = one(spark, value * 10 + k)
                storage.update_version(spark, root, lambda old, row=row: row if old is None else old.unionByName(row))
        except Exception as exc:  # shown by the test
            errors.append(exc)

    threads = [threading.Thread(target=add, args=(n,)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted(r.x for r in storage.read_version(spark, root).collect()) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    assert storage.versions(spark, root) == list(range(1, 10))
    assert [storage.read_version(spark, root, n).count() for n in (1, 5, 9)] == [1, 5, 9]


def test_a_write_on_an_older_version_is_refused(spark, tmp_path):
    root = str(tmp_path / "table")
    storage.write_version(one(spark, 1), root, 0)
    with pytest.raises(storage.VersionConflict):
        storage.write_version(one(spark, 2), root, 0)
    assert storage.versions(spark, root) == [1] and storage.read_version(spark, root).first().x == 1
    assert not storage._put_if_absent(spark, f"{root}/_versions/{1:020d}", "other")


@pytest.mark.parametrize("period,other", [("day", "2024-01-03"), ("day", "2024-01-20"), ("month", "2024-01-03"), ("month", "2024-02-20")])
def test_refreshes_at_the_same_time_equal_one_after_the_other(spark, tmp_path, monkeypatch, period, other):
    """Another writer's refresh is stored after the first has written its window and before it stores its list."""
    paths = [storage.write_partitioned(days(spark, "2024-01-01", "2024-02-25", 0), str(tmp_path / p), period) for p in ("both", "serial")]
    mine, theirs = ("2024-01-15", days(spark, "2024-01-15", "2024-02-24", 1)), (other, days(spark, other, "2024-02-25", 2))
    for start, new in (theirs, mine):
        storage.refresh_partitions(spark, paths[1], new, start, period)
    write, calls = storage._write_dates, []

    def interrupted(*args):
        done = write(*args)
        calls.append(1)
        if len(calls) == 1:
            storage.refresh_partitions(spark, paths[0], theirs[1], theirs[0], period)
        return done

    monkeypatch.setattr(storage, "_write_dates", interrupted)
    storage.refresh_partitions(spark, paths[0], mine[1], mine[0], period)
    assert rows_of(spark, paths[0]) == rows_of(spark, paths[1])
    # The window is written again only if its kept rows came from a folder that was replaced.
    assert len(calls) == (3 if other < "2024-01-15" or (period == "month" and other < "2024-02") else 2)


def test_the_store_stays_small(spark, tmp_path):
    path = storage.write_partitioned(days(spark, "2024-01-01", "2024-01-06", 0), str(tmp_path / "bars"))
    for k in range(10):
        storage.refresh_partitions(spark, path, days(spark, "2024-01-05", "2024-01-06", k), "2024-01-05")
    want = rows_of(spark, path)
    storage.remove_old_units(spark, path)
    assert len(list((tmp_path / "bars/data").glob("unit=*"))) == 11  # all within the grace time
    storage.remove_old_units(spark, path, keep=1, grace_seconds=0)
    assert len(list((tmp_path / "bars/data").glob("unit=*"))) == 2
    assert len(list((tmp_path / "bars/dates").glob("f=*"))) == 1 and len(storage.versions(spark, f"{path}/dates")) == 1
    assert rows_of(spark, path) == want
    storage.refresh_partitions(spark, path, days(spark, "2024-01-06", "2024-01-06", 9), "2024-01-06")
    assert rows_of(spark, path) == want
