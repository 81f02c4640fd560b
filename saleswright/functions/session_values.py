"""Values held between statements, and small scripts, for SQL users of the library.

A session variable holds one value that a query has given, until the session ends. A script is a
compound statement: it declares its own variables, branches, and handles errors; its last result
comes back as rows that Spark brings through the driver, so it should be few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.sources.tables import quoted_name


def hold_value(spark: SparkSession, name: str, kind: str, query: str) -> Column:
    """Hold the one value of ``query`` in the session variable ``name``, and return it as a column. A
    query without rows gives NULL; more than one row is an error. A variable is replaced."""
    variable = f"system.session.{quoted_name(name)}"
    spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} {kind}")
    spark.sql(f"SET VAR {variable} = ({query})")
    return F.expr(variable)


def drop_value(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS system.session.{quoted_name(name)}")


def label_by_threshold(
    spark: SparkSession, query: str, kind: str, threshold: object, above: str, below: str
) -> DataFrame:
    """One row, ``value`` and ``label``: the value that ``query`` gives, and ``above`` if it is over
    the threshold, or else (also for NULL) ``below``. The branch is taken by the script."""
    return spark.sql(
        f"""
        BEGIN
            DECLARE found {kind};
            SET found = ({query});
            IF found > {threshold} THEN
                SELECT found AS value, {_text(above)} AS label;
            ELSE
                SELECT found AS value, {_text(below)} AS label;
            END IF;
        END
        """
    )


def divided_or_message(spark: SparkSession, dividend: str, divisor: str, message: str) -> DataFrame:
    """One row, ``r`` and ``error_message``: the quotient of what two queries give, or NULL and the
    message if the divisor is 0. The error is raised by the division and caught by a handler."""
    return spark.sql(
        f"""
        BEGIN
            DECLARE a DOUBLE;
            DECLARE b DOUBLE;
            DECLARE EXIT HANDLER FOR DIVIDE_BY_ZERO
            BEGIN
                SELECT CAST(NULL AS DOUBLE) AS r, {_text(message)} AS error_message;
            END;
            SET a = ({dividend});
            SET b = ({divisor});
            SELECT a / b AS r, CAST(NULL AS STRING) AS error_message;
        END
        """
    )


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
