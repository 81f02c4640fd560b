"""Changes that must keep the declared rules, over the test tables under the declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.operators.changes import Statement, run_change
from saleswright.operators.rules import TableRules
from saleswright.plans.declared import declared_sql, declared_tables
from saleswright.plans.registry import query
from saleswright.session import scratch_path
from saleswright.sources.schemas import SUPPLIER
from saleswright.sources.tables import drop_table

_COLUMNS = ", ".join(SUPPLIER.schema.names)


@query(
    declared_sql(
        f"""
        SELECT * REPLACE (CASE WHEN Country = '3' THEN 'Atlantis' ELSE Country END AS Country)
        FROM the_Supplier s WHERE Id IN (SELECT SupplierId FROM the_Product)
        UNION ALL
        SELECT Id + 1000000, CompanyName, NULL, NULL, NULL, 'new', NULL, NULL FROM the_Supplier
        WHERE Country = '7'
        """
    )
)
def change_with_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers after one run that updates some, deletes those without products and adds others.
    The rules of the table, its products' references among them, are checked before the commit."""
    tables = declared_tables(spark, folder).by_name()
    base = scratch_path(spark, "suppliers")
    name = base.rsplit("/", 1)[1].replace("-", "_")
    tables["Supplier"].write.parquet(f"{base}/first")
    used = tables["Product"].select(F.col("SupplierId").alias("Id")).distinct()

    def change(old: DataFrame) -> Statement:
        unused = old.join(used.withColumn("used", F.lit(True)), "Id", "left")
        marked = unused.withColumn("used", F.coalesce("used", F.lit(False)))
        more = old.filter("Country = '7'").select(
            (F.col("Id") + 1000000).alias("Id"), "CompanyName", F.lit("new").alias("Country")
        )
        left = Statement.of(marked).delete(~F.col("used")).without("used")
        return left.update({"Country": F.lit("Atlantis")}, F.col("Country") == "3").insert(more)

    rules = TableRules.declared(SUPPLIER, tables)
    _, new = run_change(spark, name, base, "1", change, f"{base}/first", rules=rules)
    drop_table(spark, name)
    return new


@query(
    declared_sql(
        """
        SELECT * FROM (
            SELECT 'FK_PRODUCT_REFERENCE_SUPPLIER' AS rule, count(*) AS n FROM the_Product p
            JOIN the_Supplier s ON s.Id = SupplierId WHERE s.Id <= 5
            UNION ALL SELECT 'CompanyName is null', count(*) FROM the_Supplier
            WHERE Country = '3' AND Id > 5
            UNION ALL SELECT 'Fax over 30', count(*) FROM the_Supplier WHERE Country = '4' AND Id > 5
            UNION ALL SELECT 'Id repeated', count(*) FROM the_Supplier WHERE Country = '7' AND Id > 5
        ) WHERE n > 0
        """
    )
)
def broken_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What a run would break that deletes suppliers with products, and makes names NULL, fax numbers
    too long and keys twice: rules and their numbers of rows, for which no commit would be made."""
    tables = declared_tables(spark, folder).by_name()
    old = tables["Supplier"]
    again = old.filter("Country = '7' AND Id > 5").select("Id", "CompanyName")
    statement = (
        Statement.of(old)
        .delete(F.col("Id") <= 5)
        .update({"CompanyName": F.lit(None)}, F.col("Country") == "3")
        .update({"Fax": F.repeat(F.lit("9"), F.lit(31))}, F.col("Country") == "4")
        .insert(again)
    )
    written = statement.written(scratch_path(spark, "broken"))
    return TableRules.declared(SUPPLIER, tables).faults_of(written)
