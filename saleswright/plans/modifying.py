"""Row changes, audit, checks and the audit stream over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import money
from saleswright.operators.audit import (
    TableSwitch,
    append_log,
    both,
    deleting,
    inserting,
    product_audit,
    product_log,
    read_log,
    row_sets_log,
    run_audited_change,
    snapshot_log,
)
from saleswright.operators.changes import (
    Statement,
    delete_rows,
    delete_through_view,
    insert_rows,
    insert_through_view,
    run_change,
    update_rows,
)
from saleswright.operators.inserting import insert_run
from saleswright.operators.numbering import assign_ids
from saleswright.operators.partitioned import (
    create_partitioned,
    read_partitioned,
    run_partition_change,
)
from saleswright.operators.quality import (
    duplicate_keys,
    null_counts,
    orphans,
    outside_domain,
    screened_duplicate_keys,
    too_long,
)
from saleswright.plans.registry import query
from saleswright.session import scratch_path
from saleswright.sources.schemas import AUDIT, DELETED, INSERTED, PRODUCT, complete_rows
from saleswright.sources.tables import drop_table, load_rows, read_table
from saleswright.streaming.audit_stream import audit_rows, read_changes, start_product_audit

# The texts that the changes below write, in Python and in SQL alike.
OSLO, TESTE, CRAIG_SMITH, ANITA_COATS = "Oslo", "TESTE", "Craig Smith", "Anita Coats"


# --- row changes ----------------------------------------------------------------------


@query(
    """
    SELECT s_suppkey, CASE WHEN s_suppkey = 15 THEN 'Oslo' ELSE s_name END AS s_name, s_nationkey
    FROM supplier
    """
)
def update_by_key(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return update_rows(supplier, {"s_name": F.lit(OSLO)}, F.col("s_suppkey") == 15)


@query(
    """
    SELECT s_suppkey, s_name,
           CASE WHEN s_name = 'Supplier#000000007' THEN 3 ELSE s_nationkey END AS s_nationkey
    FROM supplier
    """
)
def update_by_name(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    named = F.col("s_name") == "Supplier#000000007"
    return update_rows(supplier, {"s_nationkey": F.lit(3)}, named)


def _flagged_parts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    flag = (F.col("p_size") > 40).cast("int").alias("flag")
    return read_table(spark, folder, "part").select(*columns, flag)


@query("SELECT p_partkey, 0 AS flag FROM part")
def update_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    return update_rows(_flagged_parts(spark, folder, "p_partkey"), {"flag": F.lit(0)})


@query(
    """
    SELECT p_partkey, CASE WHEN p_retailprice = 997 THEN 'TESTE' ELSE p_name END AS p_name,
           CASE WHEN p_retailprice = 997 THEN 1 ELSE CAST(p_size > 40 AS INTEGER) END AS flag
    FROM part
    """
)
def update_by_value(spark: SparkSession, folder: str) -> DataFrame:
    parts = _flagged_parts(spark, folder, "p_partkey", "p_name", "p_retailprice")
    values = {"p_name": F.lit(TESTE), "flag": F.lit(1)}
    return update_rows(parts, values, F.col("p_retailprice") == 997).drop("p_retailprice")


@query("SELECT * FROM part WHERE NOT coalesce(p_partkey = 79, false)", name="delete_rows")
def delete_one_part(spark: SparkSession, folder: str) -> DataFrame:
    return delete_rows(read_table(spark, folder, "part"), F.col("p_partkey") == 79)


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT 1000000, 'Craig Smith'")
def insert_values(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    row = spark.range(1).select(
        F.lit(1000000).alias("s_suppkey"), F.lit(CRAIG_SMITH).alias("s_name")
    )
    return insert_rows(supplier, row)


@query(
    """
    SELECT s_suppkey, s_name, s_nationkey FROM supplier
    UNION ALL SELECT 1000000 + i, 'Anita Coats', NULL FROM range(5) t(i)
    """
)
def insert_partial_rows(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = spark.range(5).select(
        (F.col("id") + 1000000).alias("s_suppkey"), F.lit(ANITA_COATS).alias("s_name")
    )
    return insert_rows(supplier, rows)


@query(
    """
    SELECT c_name AS n, c_nationkey AS nk FROM customer
    UNION ALL SELECT substring(s_name, 1, 5), s_nationkey FROM supplier WHERE s_suppkey = 7
    """
)
def insert_select(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select(
        F.col("c_name").alias("n"), F.col("c_nationkey").alias("nk")
    )
    chosen = read_table(spark, folder, "supplier").filter(F.col("s_suppkey") == 7)
    rows = chosen.select(
        F.left("s_name", F.lit(5)).alias("n"), F.col("s_nationkey").alias("nk")
    )
    return insert_rows(customer, rows)


@query(
    """
    SELECT c_name AS n, c_nationkey AS nk, coalesce(c_nationkey = 3, false) AS visible
    FROM customer
    UNION ALL SELECT s_name, s_nationkey, coalesce(s_nationkey = 3, false) FROM supplier
    """,
    name="insert_through_view",
)
def suppliers_into_customer_view(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select(
        F.col("c_name").alias("n"), F.col("c_nationkey").alias("nk")
    )
    rows = read_table(spark, folder, "supplier").select(
        F.col("s_name").alias("n"), F.col("s_nationkey").alias("nk")
    )
    return insert_through_view(customer, rows, F.col("nk") == 3)


@query(
    "SELECT c_custkey FROM customer WHERE NOT (c_nationkey = 3 AND c_name LIKE '%55%')",
    name="delete_through_view",
)
def delete_from_customer_view(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    view, named = F.col("c_nationkey") == 3, F.col("c_name").like("%55%")
    return delete_through_view(customer, view, named).select("c_custkey")


@query(
    """
    SELECT s_suppkey, (SELECT max(c_custkey) FROM customer)
           + row_number() OVER (ORDER BY s_suppkey) AS new_id
    FROM supplier
    """,
    name="assign_ids",
)
def supplier_customer_ids(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey")
    customer = read_table(spark, folder, "customer")
    return assign_ids(supplier, customer, "c_custkey", [F.asc("s_suppkey")], "new_id")


# --- audit ----------------------------------------------------------------------------


def _stamp() -> Column:
    return F.lit(datetime(2024, 5, 6, 7, 8, 9).isoformat()).cast("timestamp_ntz")


@query(
    """
    SELECT p_partkey, p_name, TIMESTAMP '2024-05-06 07:08:09' AS updatedat, 'INS' AS operation
    FROM part WHERE p_size > 45
    UNION ALL SELECT p_partkey, p_name, TIMESTAMP '2024-05-06 07:08:09', 'DEL'
    FROM part WHERE p_size <= 5
    """
)
def audit_ins_del(spark: SparkSession, folder: str) -> DataFrame:
    """Small parts leave the table, large ones come in, and all others are renamed."""
    part = read_table(spark, folder, "part")
    old = part.filter("p_size <= 45").select("p_partkey", "p_name")
    name = F.when(F.col("p_size") > 45, F.col("p_name")).otherwise("new")
    new = part.filter("p_size > 5").select("p_partkey", name.alias("p_name"))
    return snapshot_log(old, new, "p_partkey", _stamp())


@query(
    """
    SELECT row_number() OVER (ORDER BY p_partkey) AS id,
           p_partkey AS productid, p_name AS productname,
           CAST(p_size AS BIGINT) AS "SupplierId",
           CAST(p_retailprice AS DECIMAL(12,2)) AS "UnitPrice",
           p_type AS package, p_size > 40 AS "IsDiscontinued",
           TIMESTAMP '2024-05-06 07:08:09' AS updatedat,
           CASE WHEN p_size > 25 THEN 'INS' ELSE 'DEL' END AS operation
    FROM part
    """
)
def audit_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as log rows of the audit table; the size stands in for the supplier."""
    product = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("Id"),
        F.col("p_name").alias("ProductName"),
        F.col("p_size").alias("SupplierId"),
        money("p_retailprice").alias("UnitPrice"),
        F.col("p_type").alias("Package"),
        (F.col("p_size") > 40).alias("IsDiscontinued"),
    )
    large = F.col("SupplierId") > 25
    log = row_sets_log(product.filter(large), product.filter(~large), _stamp())
    none = spark.range(0).select(F.col("id").cast("long").alias("id"))
    return product_audit(log, none)


@query(
    """
    SELECT p_partkey, CASE WHEN p_size > 25 THEN 'INS' ELSE 'DEL' END AS operation FROM part
    """
)
def audit_read(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", "p_size")
    log = row_sets_log(part.filter("p_size > 25"), part.filter("p_size <= 25"), _stamp())
    base = scratch_path(spark, "part-audit")
    append_log(log, base, "1")
    return read_log(spark, base, log.schema).select("p_partkey", "operation")


def _as_products(spark: SparkSession, folder: str) -> DataFrame:
    """The parts under the declared columns of the product table."""
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").cast("long").alias("Id"),
        F.col("p_name").alias("ProductName"),
        F.col("p_size").cast("long").alias("SupplierId"),
        money("p_retailprice").alias("UnitPrice"),
        F.col("p_type").alias("Package"),
        (F.col("p_size") > 40).alias("IsDiscontinued"),
    )


_PRODUCTS = """
    SELECT CAST(p_partkey AS BIGINT) AS "Id", p_name AS "ProductName",
           CAST(p_size AS BIGINT) AS "SupplierId",
           CAST(p_retailprice AS DECIMAL(12,2)) AS "UnitPrice", p_type AS "Package",
           p_size > 40 AS "IsDiscontinued" FROM part
"""


@query(
    f"""
    SELECT * FROM ({_PRODUCTS})
    UNION ALL
    SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY s_name, s_nationkey), s_name,
           CAST(s_nationkey AS BIGINT), CAST(0 AS DECIMAL(12,2)), NULL, false FROM supplier
    """
)
def insert_with_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """All suppliers become products without key, price, package and flag; the table that they
    are appended to has all parts."""
    base = scratch_path(spark, "products")
    load_rows(_as_products(spark, folder), PRODUCT, base, "1")
    rows = read_table(spark, folder, "supplier").select(
        F.col("s_name").alias("ProductName"),
        F.col("s_nationkey").cast("long").alias("SupplierId"),
    )
    parents = read_table(spark, folder, "nation").select(F.col("n_nationkey").alias("Id"))
    return insert_run(
        spark,
        base,
        "2",
        rows,
        PRODUCT,
        [F.asc("ProductName"), F.asc("SupplierId")],
        {"Supplier": parents},
    )


def _published(spark: SparkSession, folder: str, label: str) -> tuple[str, str]:
    """The parts as a published table of products: its name, and the folder of its snapshots."""
    base = scratch_path(spark, label)
    name = base.rsplit("/", 1)[1].replace("-", "_")
    _as_products(spark, folder).write.parquet(f"{base}/first")
    run_change(spark, name, base, "0", lambda old: old, f"{base}/first")
    return name, base


@query(
    f"""
    SELECT row_number() OVER (ORDER BY "Id", operation) AS id, "Id" AS productid,
           "ProductName" AS productname, "SupplierId", "UnitPrice", "Package" AS package,
           "IsDiscontinued", TIMESTAMP '2024-05-06 07:08:09' AS updatedat, operation
    FROM (SELECT *, 'DEL' AS operation FROM ({_PRODUCTS}) WHERE "SupplierId" > 25
          UNION ALL SELECT * REPLACE ('again' AS "ProductName"), 'INS'
          FROM ({_PRODUCTS}) WHERE "SupplierId" > 25)
    """
)
def audited_change(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the products are deleted and come back under the same keys; the log has both."""
    name, base = _published(spark, folder, "audited")
    large = F.col("SupplierId") > 25
    log = f"{base}/log"

    def change(old: DataFrame) -> Statement:
        back = old.filter(large).withColumn("ProductName", F.lit("again"))
        return both(deleting(old, large), lambda left: inserting(left, back, PRODUCT))

    run_audited_change(
        spark, name, base, "1", change, "Id", log, _stamp(), TableSwitch(spark),
        shape=product_log(spark, log, "1"),
    )
    drop_table(spark, name)
    return read_log(spark, log, AUDIT.schema)


@query("SELECT p_partkey, 'INS' AS operation FROM part WHERE p_size > 20")
def audit_switch(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of inserts into an empty table; its audit is switched off during the first one, by a
    property that stays with the table."""
    base = scratch_path(spark, "switched")
    name = base.rsplit("/", 1)[1].replace("-", "_")
    products = _as_products(spark, folder)
    products.limit(0).write.parquet(f"{base}/first")
    run_change(spark, name, base, "0", lambda old: old, f"{base}/first")
    switch, log = TableSwitch(spark), f"{base}/log"
    switch.disable(name)
    for run, batch in (("1", "SupplierId <= 20"), ("2", "SupplierId > 20")):
        run_audited_change(
            spark, name, base, run, lambda old, b=batch: inserting(old, products.filter(b)), "Id",
            log, _stamp(), switch, shape=product_log(spark, log, run),
        )
        switch.enable(name)
    drop_table(spark, name)
    return read_log(spark, log, AUDIT.schema).select(
        F.col("productid").alias("p_partkey"), "operation"
    )


@query(f"""SELECT * REPLACE ("SupplierId" + 1 AS "SupplierId") FROM ({_PRODUCTS})""")
def update_published(spark: SparkSession, folder: str) -> DataFrame:
    """A published table after an update of all its rows."""
    name, base = _published(spark, folder, "updated")
    change = {"SupplierId": F.col("SupplierId") + 1}
    _, new = run_change(spark, name, base, "1", lambda old: update_rows(old, change))
    drop_table(spark, name)
    return new


@query(
    f"""
    SELECT * REPLACE (CASE WHEN "Id" BETWEEN 91 AND 300 THEN 'moved' ELSE "Package" END AS "Package")
    FROM ({_PRODUCTS}) WHERE NOT "Id" BETWEEN 79 AND 90
    UNION ALL
    SELECT CAST(100000000 + s_suppkey AS BIGINT), s_name, CAST(s_nationkey AS BIGINT),
           CAST(NULL AS DECIMAL(12,2)), NULL, NULL FROM supplier
    """
)
def update_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Products in partitions of 100 keys after a delete, an update and an insert, each a run of its
    own that leaves all other partitions where they are."""
    base = scratch_path(spark, "partitions")
    name = base.rsplit("/", 1)[1].replace("-", "_")
    create_partitioned(spark, name, _as_products(spark, folder), base, "Id", 100)
    gone, moved = F.col("Id").between(79, 90), F.col("Id").between(91, 300)
    run_partition_change(spark, name, base, "1", lambda s: s.delete(gone), gone, keys=(79, 90))
    change = {"Package": F.lit("moved")}
    run_partition_change(
        spark, name, base, "2", lambda s: s.update(change, moved), moved, keys=(91, 300)
    )
    added = read_table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 100000000).cast("long").alias("Id"),
        F.col("s_name").alias("ProductName"),
        F.col("s_nationkey").cast("long").alias("SupplierId"),
    )
    run_partition_change(spark, name, base, "3", lambda s: s, added=added)
    return read_partitioned(spark, name)


# --- checks ---------------------------------------------------------------------------


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def check_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


#: Lines of an order are next to each other; an order has fewer than 8.
_LINE_PLACE = "l_orderkey * 8 + l_linenumber"


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def screened_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    """The key of order lines, by bitmaps of the places that are taken."""
    lines = read_table(spark, folder, "lineitem")
    return screened_duplicate_keys(lines, ["l_orderkey", "l_linenumber"], F.expr(_LINE_PLACE))


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'
    ) GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def screened_resent_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that a load has twice because it sent the returned lines again."""
    lines = read_table(spark, folder, "lineitem")
    sent = lines.unionAll(lines.filter("l_returnflag = 'R'"))
    return screened_duplicate_keys(sent, ["l_orderkey", "l_linenumber"], F.expr(_LINE_PLACE))


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    """
)
def check_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of customers that are missing once those in debt are left out."""
    parents = read_table(spark, folder, "customer").filter("c_acctbal >= 0")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orphans(orders, parents, [("o_custkey", "c_custkey")])


@query(
    """
    SELECT count(*) FILTER (WHERE nullif(s_nationkey, 15) IS NULL) AS bad_nk,
           count(*) FILTER (WHERE s_name IS NULL) AS bad_name
    FROM supplier
    """
)
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return null_counts(
        read_table(spark, folder, "supplier"),
        {"bad_nk": F.nullif("s_nationkey", F.lit(15)), "bad_name": F.col("s_name")},
    )


@query("SELECT p_partkey, CAST(NULL AS INTEGER) AS p_size, 0 AS is_discontinued FROM part")
def apply_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """A column left out takes its default; one that is given as NULL keeps the NULL."""
    schema = read_table(spark, folder, "part").select(
        "p_partkey", "p_size", F.lit(0).alias("is_discontinued")
    ).schema
    rows = read_table(spark, folder, "part").select(
        "p_partkey", F.lit(None).cast("int").alias("p_size")
    )
    return complete_rows(rows, schema, {"p_size": 1, "is_discontinued": 0})


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def check_text_length(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    return too_long(part, {"p_name": 10})


@query(
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT (o_orderstatus = 'O' OR o_orderstatus = 'F')
    """
)
def check_domain(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    status = F.col("o_orderstatus")
    return outside_domain(orders, (status == "O") | (status == "F"))


# --- stream ---------------------------------------------------------------------------


@query(
    """
    SELECT row_number() OVER (ORDER BY productid, operation) AS id, * FROM (
        SELECT event_id AS productid, event_type AS productname, user_id AS "SupplierId",
               CAST(value AS DECIMAL(12,2)) AS "UnitPrice", props AS package,
               value > 10 AS "IsDiscontinued", TIMESTAMP '2024-05-06 07:08:09' AS updatedat,
               CASE WHEN event_type = 'error' THEN 'DEL' ELSE 'INS' END AS operation
        FROM events)
    """
)
def stream_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The events as change rows of products, read as a stream into the audit table."""
    events = read_table(spark, folder, "events")
    # A pattern, as a stream takes a folder or a pattern but not the path of one file.
    changes = read_changes(spark, f"{folder}/{{events.parquet}}", events.schema)
    products = changes.select(
        F.col("event_id").alias("Id"),
        F.col("event_type").alias("ProductName"),
        F.col("user_id").alias("SupplierId"),
        money("value").alias("UnitPrice"),
        F.col("props").alias("Package"),
        (F.col("value") > 10).alias("IsDiscontinued"),
    )
    operation = F.when(F.col("ProductName") == "error", DELETED).otherwise(INSERTED)
    log = scratch_path(spark, "event-audit")
    rows = audit_rows(products, operation, _stamp())
    start_product_audit(rows, log, f"{log}-checkpoint").awaitTermination()
    return read_log(spark, log, AUDIT.schema)
