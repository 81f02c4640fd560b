"""Changes of single partitions: what is rewritten, what keeps its files, and repeated runs."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import plan, tuples
from saleswright.operators import partitioned
from saleswright.operators.partitioned import (
    create_partitioned,
    keys_between,
    locations,
    read_partitioned,
    run_partition_change,
)
from saleswright.operators.rules import BrokenRules, TableRules
from saleswright.plans.catalog import ORACLES, QUERIES
from saleswright.sources.schemas import CUSTOMER


@pytest.fixture
def table(spark, tmp_path):
    """Keys 0 to 99 in ten partitions."""
    name, base = f"ranged_{tmp_path.name}", f"{tmp_path}/t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(100).select(F.col("id").alias("Id"), (F.col("id") * 2).alias("v"))
    create_partitioned(spark, name, rows, base, "Id", 10)
    yield name, base
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def files(spark, name):
    """Files and their times of change by partition."""
    found = {}
    for part, place in locations(spark, name).items():
        folder = place.removeprefix("file:")
        found[part] = {(f, os.stat(f"{folder}/{f}").st_mtime_ns) for f in os.listdir(folder)}
    return found


def test_an_update_rewrites_only_the_partitions_it_touches(spark, table):
    name, base = table
    before = files(spark, name)
    where = F.col("Id").between(25, 31)
    parts = run_partition_change(spark, name, base, "1", lambda s: s.update({"v": F.lit(-1)}, where), where)
    after = files(spark, name)
    assert parts == [2, 3]
    assert {k for k in after if after[k] != before[k]} == {2, 3} and len(after) == 10
    assert sorted(tuples(read_partitioned(spark, name))) == [(i, -1 if 25 <= i <= 31 else 2 * i) for i in range(100)]


def test_deletes_and_inserts(spark, table):
    name, base = table
    gone = F.col("Id").between(10, 19) | (F.col("Id") == 55)
    rows = spark.createDataFrame([(205,), (56_000,), (7,)], "Id long")
    rows = rows.filter("Id <> 7")
    parts = run_partition_change(spark, name, base, "1", lambda s: s.delete(gone), gone, rows)
    assert parts == [1, 5, 20, 5600]
    assert set(locations(spark, name)) == {0, 2, 3, 4, 5, 6, 7, 8, 9, 20, 5600}  # 1 has no rows left
    left = {i: 2 * i for i in range(100) if i != 55 and not 10 <= i <= 19} | {205: None, 56_000: None}
    assert dict(tuples(read_partitioned(spark, name))) == left
    parts = run_partition_change(spark, name, base, "2", lambda s: s.delete(), F.lit(True))
    assert len(parts) == 11 and locations(spark, name) == {} and read_partitioned(spark, name).count() == 0


def test_negative_keys_and_null_keys(spark, tmp_path):
    name, base = f"negative_{tmp_path.name}", f"{tmp_path}/t"
    rows = spark.createDataFrame([(-1, 1), (-10, 2), (-11, 3)], "Id long, v long")
    create_partitioned(spark, name, rows, base, "Id", 10)
    assert set(locations(spark, name)) == {-1, -2}
    null = spark.createDataFrame([(None, 1)], "Id long, v long")
    with pytest.raises(ValueError, match="has no partition"):
        run_partition_change(spark, name, base, "1", lambda s: s, None, null)
    with pytest.raises(ValueError, match="has no partition"):
        create_partitioned(spark, f"{name}_2", null, f"{base}2", "Id", 10)
    spark.sql(f"DROP TABLE {name}")


def test_a_key_may_not_leave_what_the_run_touches(spark, table):
    name, base = table
    before = files(spark, name)
    where = F.col("Id") == 5
    with pytest.raises(ValueError, match="does not touch"):
        run_partition_change(spark, name, base, "1", lambda s: s.update({"Id": F.lit(77)}, where), where)
    assert files(spark, name) == before
    both = where | (F.col("Id") == 70)
    run_partition_change(spark, name, base, "2", lambda s: s.update({"Id": F.lit(777)}, F.lit(False)).update({"Id": F.lit(79)}, where).delete((F.col("Id") == 79) & (F.col("v") == 158)), both)
    assert keys_between(spark, name, 70, 79).filter("Id = 79").collect()[0]["v"] == 10


def test_a_run_that_stopped_between_two_moves_is_finished(spark, table, monkeypatch):
    name, base = table
    where = F.col("Id").isin(1, 11, 21, 31)
    calls = []

    def change(s):
        calls.append(1)
        return s.update({"v": F.lit(-1)}, where)

    real, moved = spark.sql, []

    def stopping(text, *args, **kw):
        if "SET LOCATION" in text:
            if len(moved) == 2:
                raise RuntimeError("lost the driver")
            moved.append(text)
        return real(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", stopping)
    with pytest.raises(RuntimeError):
        run_partition_change(spark, name, base, "1", change, where)
    monkeypatch.undo()
    assert read_partitioned(spark, name).filter("v = -1").count() == 2
    for _ in range(2):
        assert run_partition_change(spark, name, base, "1", change, where) == [0, 1, 2, 3]
        assert read_partitioned(spark, name).filter("v = -1").count() == 4
    assert len(calls) == 1  # the repeats only move


def test_a_late_repeat_does_not_undo_a_later_run(spark, table):
    name, base = table
    first, second = F.col("Id") == 5, F.col("Id") == 6
    run_partition_change(spark, name, base, "1", lambda s: s.update({"v": F.lit(-1)}, first), first)
    run_partition_change(spark, name, base, "2", lambda s: s.update({"v": F.lit(-2)}, second), second)
    with pytest.raises(ValueError, match="has moved on"):
        run_partition_change(spark, name, base, "1", lambda s: s, first)
    rows = dict(tuples(read_partitioned(spark, name).filter("v < 0")))
    assert rows == {5: -1, 6: -2}
    # A run elsewhere is not in the way.
    other = F.col("Id") == 95
    run_partition_change(spark, name, base, "3", lambda s: s.delete(other), other)
    assert run_partition_change(spark, name, base, "2", lambda s: s, second) == [0]


def test_nothing_selected_changes_nothing(spark, table):
    name, base = table
    before = files(spark, name)
    assert run_partition_change(spark, name, base, "1", lambda s: s.delete(F.col("v") < 0), F.col("v") < 0) == []
    assert files(spark, name) == before


def test_rules_are_checked_before_anything_is_moved(spark, tmp_path):
    name, base = f"ruled_{tmp_path.name}", f"{tmp_path}/t"
    rows = spark.range(40).select(F.col("id").alias("Id"), F.lit("a").alias("FirstName"), F.lit("b").alias("LastName"), *[F.lit("c").alias(c) for c in ("City", "Country", "Phone")])
    create_partitioned(spark, name, rows, base, "Id", 10)
    orders = spark.range(1).select(F.lit(13).cast("long").alias("CustomerId"))
    rules = TableRules(CUSTOMER, {}, [("FK", orders, "CustomerId")])
    before = files(spark, name)
    for where, run in ((F.col("Id") == 13, "1"), (F.col("Id") < 20, "2")):
        with pytest.raises(BrokenRules, match="FK: 1"):
            run_partition_change(spark, name, base, run, lambda s, w=where: s.delete(w), where, rules=rules)
    again = rows.filter("Id = 7")
    with pytest.raises(BrokenRules, match="Id repeated: 1"):
        run_partition_change(spark, name, base, "3", lambda s: s, None, again, rules)
    assert files(spark, name) == before
    run_partition_change(spark, name, base, "4", lambda s: s.delete(F.col("Id") == 14), F.col("Id") == 14, rules=rules)
    assert read_partitioned(spark, name).count() == 39
    spark.sql(f"DROP TABLE {name}")


def test_reading_by_key_reads_its_partitions(spark, table):
    name, _ = table
    found = keys_between(spark, name, 18, 22)
    assert sorted(r["Id"] for r in found.collect()) == [18, 19, 20, 21, 22]
    assert "InMemoryFileIndex(2 paths)" in plan(found)


def test_many_partitions_are_added_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(partitioned, "_AT_ONCE", 7)
    name = f"many_{tmp_path.name}"
    create_partitioned(spark, name, spark.range(200).withColumnRenamed("id", "Id"), f"{tmp_path}/t", "Id", 10)
    assert len(locations(spark, name)) == 20 and Counter(tuples(read_partitioned(spark, name))) == Counter((i,) for i in range(200))
    spark.sql(f"DROP TABLE {name}")


def test_new_partitions_cost_no_statement_each(spark, table, monkeypatch):
    name, base = table
    asked, real = [], partitioned.partition_location
    monkeypatch.setattr(partitioned, "partition_location", lambda *a: asked.append(a[-1]) or real(*a))
    rows = spark.range(95, 300).withColumnRenamed("id", "Id").filter("Id > 99 OR Id = 95")
    parts = run_partition_change(spark, name, base, "1", lambda s: s, added=rows)
    assert parts == list(range(9, 30)) and set(asked) == {9}
    monkeypatch.undo()
    assert read_partitioned(spark, name).count() == 301 and len(locations(spark, name)) == 30


def test_partitions_out_of_reach_are_not_listed(spark, tmp_path):
    """Spark lists more than 32 folders in a job with a task for each."""
    name, base = f"unlisted_{tmp_path.name}", f"{tmp_path}/t"
    rows = spark.range(600).select(F.col("id").alias("Id"), F.lit(0).alias("v"))
    context = spark.sparkContext
    context.setJobGroup(name, name)
    create_partitioned(spark, name, rows, base, "Id", 10)
    where = F.col("v") == 0
    parts = run_partition_change(spark, name, base, "1", lambda s: s.update({"v": F.lit(1)}, where & F.col("Id").between(25, 31)), where, keys=(25, 31))
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(job).stageIds]
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks and max(tasks) < 60
    assert parts == [2, 3]
    found = dict(tuples(read_partitioned(spark, name)))
    assert found == {i: int(25 <= i <= 31) for i in range(600)}
    spark.sql(f"DROP TABLE {name}")


def test_a_key_may_not_become_null(spark, table):
    name, base = table
    where, null = F.col("Id") == 5, F.lit(None).cast("long")
    with pytest.raises(ValueError, match="does not touch"):
        run_partition_change(spark, name, base, "1", lambda s: s.update({"Id": null}, where), where)
    assert read_partitioned(spark, name).count() == 100


def test_registered_form(spark, data):
    assert "update_partitions" in ORACLES
    found = QUERIES["update_partitions"](spark, data)
    assert found.filter("Package = 'moved'").count() > 0
