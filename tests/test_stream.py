"""The audit stream: batches, restarts and repeated batches."""

import os

import pytest
from pyspark.sql import functions as F

from saleswright.operators.audit import read_log
from saleswright.operators.key_ranges import read_ranges
from saleswright.sources.schemas import AUDIT
from saleswright.streaming.audit_stream import (
    audit_rows,
    read_batches,
    read_changes,
    start_audit,
    start_product_audit,
)


@pytest.fixture
def changes(spark, tmp_path):
    """Three files of change rows."""
    folder = f"{tmp_path}/changes"
    rows = spark.range(90).select(
        F.col("id").cast("int").alias("productid"),
        F.concat(F.lit("p"), "id").alias("productname"),
        (F.col("id") % 4 == 0).alias("removed"),
    )
    for i in range(3):
        rows.filter(f"id BETWEEN {30 * i} AND {30 * i + 29}").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
    return folder, rows.schema


def run(spark, changes, log, checkpoint, files_per_batch=1000):
    folder, schema = changes
    stream = read_changes(spark, folder, schema, files_per_batch=files_per_batch)
    operation = F.when(F.col("removed"), "DEL").otherwise("INS")
    query = start_audit(audit_rows(stream, operation, F.localtimestamp()), log, checkpoint)
    query.awaitTermination()
    return query


def logged(spark, log):
    rows = spark.read.parquet(log).select("productid", "productname", "operation").collect()
    return sorted(map(tuple, rows))


def commits(checkpoint):
    return [name for name in os.listdir(f"{checkpoint}/commits") if name.isdigit()]


def test_one_batch_and_three_batches_give_the_same_log(spark, changes, tmp_path):
    run(spark, changes, f"{tmp_path}/one", f"{tmp_path}/one-check")
    run(spark, changes, f"{tmp_path}/three", f"{tmp_path}/three-check", files_per_batch=1)
    assert len(commits(f"{tmp_path}/one-check")) == 1
    assert len(commits(f"{tmp_path}/three-check")) == 3
    expected = sorted((i, f"p{i}", "DEL" if i % 4 == 0 else "INS") for i in range(90))
    assert logged(spark, f"{tmp_path}/one") == expected
    assert logged(spark, f"{tmp_path}/three") == expected


def test_a_restart_adds_only_what_is_new(spark, changes, tmp_path):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    run(spark, changes, log, checkpoint)
    first = logged(spark, log)
    run(spark, changes, log, checkpoint)
    assert logged(spark, log) == first
    folder, schema = changes
    spark.sql("SELECT 500 AS productid, 'late' AS productname, false AS removed").write.mode(
        "append"
    ).parquet(folder)
    run(spark, changes, log, checkpoint)
    assert logged(spark, log) == sorted([*first, (500, "late", "INS")])


def test_a_batch_that_is_run_again_is_logged_once(spark, changes, tmp_path):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    run(spark, changes, log, checkpoint, files_per_batch=1)
    first = logged(spark, log)
    # As after a crash between writing the last batch and noting that it is done.
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    run(spark, changes, log, checkpoint, files_per_batch=1)
    assert logged(spark, log) == first


def test_files_of_a_failed_attempt_are_not_read(spark, changes, tmp_path):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    run(spark, changes, log, checkpoint)
    first = logged(spark, log)
    spark.sql("SELECT 999 AS productid, 'ghost' AS productname, false AS removed").write.mode(
        "append"
    ).parquet(f"{log}/operation=INS")
    assert logged(spark, log) == first


def test_events_may_be_one_file_or_a_folder_of_files(spark, data, tmp_path):
    from saleswright.plans.catalog import QUERIES

    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    from_folder = QUERIES["stream_audit"](spark, str(tmp_path))
    from_file = QUERIES["stream_audit"](spark, data)
    assert from_folder.count() == events.count()
    assert from_folder.exceptAll(from_file).count() == 0


# --- the audit table ------------------------------------------------------------------


def audit(spark, changes, log, checkpoint, files_per_batch=1000):
    folder, schema = changes
    stream = read_changes(spark, folder, schema, files_per_batch=files_per_batch)
    rows = audit_rows(
        stream.select(
            F.col("productid").alias("Id"),
            F.col("productname").alias("ProductName"),
            F.lit(1).alias("SupplierId"),
            F.col("removed").alias("IsDiscontinued"),
        ),
        F.when(F.col("IsDiscontinued"), "DEL").otherwise("INS"),
        F.lit("2024-01-02T03:04:05").cast("timestamp_ntz"),
    )
    start_product_audit(rows, log, checkpoint).awaitTermination()
    return sorted(tuple(r) for r in read_batches(spark, log).select("batch", "id", "productid", "operation").collect())


def test_ids_go_on_from_batch_to_batch(spark, changes, tmp_path):
    log = f"{tmp_path}/log"
    rows = audit(spark, changes, log, f"{tmp_path}/check", files_per_batch=1)
    assert [r[1] for r in rows] == list(range(1, 91))
    assert sorted({r[0] for r in rows}) == [0, 1, 2]
    for batch in range(3):  # in a batch by product
        products = [r[2] for r in rows if r[0] == batch]
        assert products == sorted(products) and len(products) == 30
    found = read_log(spark, log, AUDIT.schema)
    assert found.columns == AUDIT.schema.names and found.count() == 90
    assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in AUDIT.schema}
    assert {(r.operation, r.IsDiscontinued) for r in found.collect()} == {("DEL", True), ("INS", False)}


@pytest.mark.parametrize("again", [("2",), ("1", "2")])
def test_a_replayed_batch_adds_nothing(spark, changes, tmp_path, again):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    first = audit(spark, changes, log, checkpoint, files_per_batch=1)
    for number in again:  # as after a crash before these were noted as done
        for name in (number, f".{number}.crc"):
            os.remove(f"{checkpoint}/commits/{name}")
            if number != again[0]:
                os.remove(f"{checkpoint}/offsets/{name}")
    assert audit(spark, changes, log, checkpoint, files_per_batch=1) == first
    assert read_ranges(spark, log).count() == 3


def test_a_batch_that_failed_half_way_is_written_whole(spark, changes, tmp_path):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    first = audit(spark, changes, log, checkpoint, files_per_batch=1)
    # Its ids are reserved, some of its files are there, and it is not noted as done.
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    folder = f"{log}/run_id=batch-000000000002/operation=INS"
    os.remove(next(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")))
    assert audit(spark, changes, log, checkpoint, files_per_batch=1) == first


def test_a_restart_goes_on_with_the_ids(spark, changes, tmp_path):
    log, checkpoint = f"{tmp_path}/log", f"{tmp_path}/check"
    first = audit(spark, changes, log, checkpoint)
    assert audit(spark, changes, log, checkpoint) == first
    folder, _ = changes
    spark.sql("SELECT 500 AS productid, 'late' AS productname, false AS removed").write.mode(
        "append"
    ).parquet(folder)
    assert audit(spark, changes, log, checkpoint) == [*first, (1, 91, 500, "INS")]
