"""Staged tables with statistics, and sessions that order joins by them.

A result that later statements use more than once is written as a table and analysed: its rows and,
for each column, the least and greatest value, NULLs and different values. A view or a DataFrame has
none of these, so a join over it keeps the order in which it was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleswright.session import scratch_path
from saleswright.sources.tables import quoted_name

_BY_COST = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
}


def stage_analysed(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """Write ``df`` as the table ``name`` with statistics of ``columns`` (by default all).

    The files lie in the shared folder of the application. A table of that name is replaced.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    table = quoted_name(name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.option("path", path).saveAsTable(table)
    chosen = ", ".join(quoted_name(c) for c in columns or df.columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {chosen}")
    return spark.table(table)


def cost_based_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that sees the same tables and orders inner joins by cost.

    Settings of the given session stay as they are; temporary views are its own.
    """
    other = spark.newSession()
    for key, value in _BY_COST.items():
        other.conf.set(key, value)
    return other


def in_session(session: SparkSession, name: str) -> DataFrame:
    """A staged table as another session reads it."""
    return session.table(quoted_name(name))
