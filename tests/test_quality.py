"""Rules that return the rows at fault."""

from datetime import datetime

from pyspark.sql import functions as F

from helpers import D, as_set, frame, small_sales, tuples
from saleswright.operators import quality
from saleswright.operators.quality import (
    bitmaps_pay,
    broken_references,
    duplicate_keys,
    fault_counts,
    null_counts,
    orphans,
    outside_domain,
    screened_duplicate_keys,
    suspected_buckets,
    too_long,
)
from saleswright.sources.schemas import ORDER, ORDER_ITEM, PRODUCT, TABLES


def test_keys(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a'), (1, 'a'), (1, 'b'), (2, 'a'), (NULL, 'a'),"
        " (3, CAST(NULL AS STRING)) t(x, y)"
    )
    assert as_set(duplicate_keys(df, ["x"])) == {(1, 3), (None, 1)}
    assert as_set(duplicate_keys(df, ["x", "y"])) == {(1, "a", 2), (None, "a", 1), (3, None, 1)}
    assert duplicate_keys(small_sales(spark).product, ["Id"]).count() == 0


def stored(spark, folder, df):
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_a_clean_ordered_table_has_no_suspects(spark, tmp_path):
    df = stored(spark, tmp_path / "clean", spark.range(-100_000, 900_000).toDF("k"))
    assert bitmaps_pay(df, F.col("k")) and suspected_buckets(df, F.col("k")).count() == 0
    assert screened_duplicate_keys(df, ["k"], F.col("k")).count() == 0
    # What is shuffled: a bitmap for each task and bucket, under a byte a row.
    sent = df.select(F.spark_partition_id(), F.bitmap_bucket_number("k")).distinct().count()
    assert sent * 4096 < 1_000_000


def test_screened_keys_are_those_of_the_whole_check(spark, tmp_path):
    """Repeats within a file, across files, a key that a third of the rows share, NULLs in a
    key of two columns, and different keys that share a place."""
    ids = spark.range(0, 300_000).select("id", (F.col("id") % 3).cast("string").alias("t"))
    again = ids.filter("id IN (7, 150000, 299999)")
    hot = spark.range(150_000).select(F.lit(40_000).cast("long").alias("id"), F.lit("x").alias("t"))
    nulls = spark.sql("SELECT * FROM VALUES (NULL, 'a'), (5L, NULL), (5L, NULL) n(id, t)")
    df = stored(spark, tmp_path / "t", ids.unionAll(again).unionAll(hot).unionAll(nulls))
    for key in (["id"], ["id", "t"]):
        wanted = as_set(duplicate_keys(df, key))
        assert bitmaps_pay(df, F.col("id")) and len(wanted) >= 5
        assert as_set(screened_duplicate_keys(df, key, F.col("id"))) == wanted
        coarse = F.expr("id div 3")
        assert as_set(screened_duplicate_keys(df, key, coarse)) == wanted
    suspected = {r["_bucket"] for r in suspected_buckets(df, F.col("id")).collect()}
    assert len(suspected) <= 4  # of ten


def test_scattered_keys_are_not_screened(spark, tmp_path, monkeypatch):
    df = spark.range(0, 5000).select((F.xxhash64("id")).alias("k"))
    df = stored(spark, tmp_path / "far", df.unionAll(df.limit(3)))
    assert not bitmaps_pay(df, F.col("k"))
    wanted = as_set(duplicate_keys(df, ["k"]))
    assert len(wanted) == 3 and as_set(screened_duplicate_keys(df, ["k"], F.col("k"))) == wanted
    monkeypatch.setattr(quality, "bitmaps_pay", lambda *_: True)
    assert as_set(screened_duplicate_keys(df, ["k"], F.col("k"))) == wanted
    assert screened_duplicate_keys(df.limit(0), ["k"], F.col("k")).count() == 0


def test_orphans_include_null_references(spark):
    child = spark.sql("SELECT * FROM VALUES (1, 10), (2, 99), (3, NULL) t(id, ref)")
    parent = spark.sql("SELECT * FROM VALUES (10), (10), (NULL) t(key)")
    assert {r.id for r in orphans(child, parent, [("ref", "key")]).collect()} == {2, 3}
    assert orphans(child, parent.limit(0), [("ref", "key")]).count() == 3


def test_references_of_all_tables(spark):
    s = small_sales(spark)
    specs = list(TABLES.values())
    assert broken_references(s.by_name(), specs).count() == 0
    tables = s.by_name()
    tables["OrderItem"] = tables["OrderItem"].unionByName(
        frame(spark, [(9, 77, 1, D("1"), 1), (10, 1, 88, D("1"), 1)], ORDER_ITEM.schema)
    )
    tables["Order"] = tables["Order"].unionByName(
        frame(spark, [(6, datetime(2014, 1, 1), None, None, None)], ORDER.schema)
    )
    assert as_set(broken_references(tables, specs)) == {
        ("FK_ORDERITE_REFERENCE_ORDER", 9, 77),
        ("FK_ORDERITE_REFERENCE_PRODUCT", 10, 88),
        ("FK_ORDER_REFERENCE_CUSTOMER", 6, None),
    }


def test_null_counts_in_one_pass(spark):
    s = small_sales(spark)
    counts = null_counts(s.supplier, {c: F.col(c) for c in ("Fax", "ContactTitle", "Id")})
    assert tuples(counts) == [(2, 3, 0)]


def test_text_limits_count_characters(spark):
    df = spark.sql("SELECT * FROM VALUES ('abcde'), ('abcdef'), ('ééééé'), (NULL) t(name)")
    assert as_set(too_long(df, {"name": 5})) == {("abcdef",)}


def test_a_rule_that_is_null_is_kept(spark):
    df = spark.sql("SELECT * FROM VALUES ('INS'), ('DEL'), ('UPD'), (NULL) t(operation)")
    rule = (F.col("operation") == "INS") | (F.col("operation") == "DEL")
    assert as_set(outside_domain(df, rule)) == {("UPD",)}


def test_faults_of_a_table(spark):
    rows = [
        (1, "x" * 51, 1, None, "y" * 30, True),
        (2, None, None, D("1"), "y" * 31, None),
    ]
    found = fault_counts(frame(spark, rows, PRODUCT.schema), PRODUCT)
    assert as_set(found) == {
        ("ProductName is null", 1),
        ("SupplierId is null", 1),
        ("IsDiscontinued is null", 1),
        ("ProductName over 50", 1),
        ("Package over 30", 1),
    }
