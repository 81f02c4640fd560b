"""Staged tables with statistics, values held between statements, and scripts."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from saleswright.functions.session_values import (
    divided_or_message,
    drop_value,
    hold_value,
    label_by_threshold,
)
from saleswright.plans.statements import sales_of_staged, staged_names
from saleswright.sources.staged import cost_based_session, stage_analysed
from saleswright.sources.tables import drop_table


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def first_join(text):
    """The tables below the innermost join."""
    return re.findall(r"Relation \S*staged_(line|order|customer)_", text[text.rindex("Join Inner") :])[:2]


def test_the_join_order_follows_the_statistics(spark, data):
    names = staged_names(spark, data)
    by_cost = sales_of_staged(cost_based_session(spark), names)
    as_written = sales_of_staged(spark, names)
    assert set(first_join(optimized(as_written))) == {"line", "order"}
    assert set(first_join(optimized(by_cost))) == {"order", "customer"}
    assert sorted(tuples(by_cost)) == sorted(tuples(as_written)) and by_cost.count() > 0
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    for name in names.values():
        drop_table(spark, name)


def test_a_staged_table_has_statistics_and_is_replaced(spark):
    for n in (10, 20):
        stage_analysed(spark.range(n).withColumn("v", F.col("id") % 5), "staged_numbers", ["v"])
        detail = spark.sql("DESCRIBE TABLE EXTENDED staged_numbers v").collect()
        found = {r["info_name"]: r["info_value"] for r in detail}
        assert (found["min"], found["max"], found["num_nulls"], found["distinct_count"]) == ("0", "4", "0", "5")
        stats = spark.sql("DESCRIBE TABLE EXTENDED staged_numbers").filter("col_name = 'Statistics'")
        assert f"{n} rows" in stats.first()["data_type"]
    drop_table(spark, "staged_numbers")


def test_a_value_is_held_between_statements(spark):
    spark.range(10).createOrReplaceTempView("held_numbers")
    value = hold_value(spark, "the value", "BIGINT", "SELECT max(id) FROM held_numbers")
    assert spark.range(20).filter(F.col("id") > value - 2).count() == 12
    assert spark.sql("SELECT `the value` + 1 AS v").first()["v"] == 10
    hold_value(spark, "the value", "BIGINT", "SELECT id FROM held_numbers WHERE id > 99")
    assert spark.sql("SELECT `the value` AS v").first()["v"] is None
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|ROW_SUBQUERY_TOO_MANY_ROWS"):
        hold_value(spark, "the value", "BIGINT", "SELECT id FROM held_numbers")
    drop_value(spark, "the value")
    drop_value(spark, "the value")


@pytest.mark.parametrize("threshold, label", [(40, "it's more"), (45, "less"), (50, "less")])
def test_a_script_branches(spark, threshold, label):
    spark.range(10).createOrReplaceTempView("branch_numbers")
    found = label_by_threshold(spark, "SELECT sum(id) FROM branch_numbers", "BIGINT", threshold, "it's more", "less")
    assert tuples(found) == [(45, label)]
    none = label_by_threshold(spark, "SELECT sum(id) FROM branch_numbers WHERE id > 99", "BIGINT", threshold, "more", "less")
    assert tuples(none) == [(None, "less")]


def test_a_handler_catches_the_division_only(spark):
    assert tuples(divided_or_message(spark, "SELECT 7", "SELECT 2", "no")) == [(3.5, None)]
    assert tuples(divided_or_message(spark, "SELECT 7", "SELECT 0", "it's \\ 0")) == [(None, "it's \\ 0")]
    assert tuples(divided_or_message(spark, "SELECT 7", "SELECT CAST(NULL AS INT)", "no")) == [(None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        divided_or_message(spark, "SELECT CAST('x' AS INT)", "SELECT 0", "no")
