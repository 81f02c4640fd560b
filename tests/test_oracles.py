"""Every registered query against its SQL, run by another engine on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from saleswright.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(rows):
    return sorted(
        tuple(str(round(v, 6) if isinstance(v, float) else v) for v in row) for row in rows
    )


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_and_types(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    answer = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(answer.columns)
    kinds = dict(zip(answer.columns, map(str, answer.types)))
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        assert KINDS.get(kind, kind.upper()) == kinds[field.name], field.name
    place = [answer.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in place) for row in answer.fetchall()]
    assert normal(tuple(row[c] for c in columns) for row in df.collect()) == normal(expected)


def test_top_unsorted_gives_any_rows_of_the_year(spark, data):
    chosen = QUERIES["top_unsorted"](spark, data)
    of_year = QUERIES["filter_year_param"](spark, data)
    assert chosen.count() == min(1000, of_year.count())
    assert chosen.join(of_year, "o_orderkey", "left_anti").count() == 0


def test_only_the_undetermined_query_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"top_unsorted"}


def test_entry(spark):
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.items() <= entry_point.oracle_sql().items()
    df = entry_point.entry(spark)
    assert df.columns == ["c_name", "total"]
    assert df.count() > 0


# The order of sorted results, which the comparison above does not see.
PART_SQL = "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) p FROM part"
ORDERED = {
    "filter_range_sorted": "SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000"
    " AND o_totalprice <= 150000 ORDER BY o_totalprice DESC, o_orderkey",
    "filter_not_range_sorted": "SELECT o_orderkey FROM orders WHERE NOT (o_totalprice >= 100000"
    " AND o_totalprice <= 450000) ORDER BY o_totalprice DESC, o_orderkey",
    "filter_between": "SELECT p_partkey FROM part WHERE p_retailprice BETWEEN 911 AND 922"
    " ORDER BY p_retailprice, p_partkey",
    "filter_not_between": "SELECT p_partkey FROM part WHERE p_retailprice NOT BETWEEN 905 AND 990"
    " ORDER BY p_retailprice, p_partkey",
    "sort_asc": "SELECT s_suppkey FROM supplier ORDER BY s_name, s_suppkey",
    "sort_desc": "SELECT s_suppkey FROM supplier ORDER BY s_name DESC, s_suppkey",
    "sort_multi": "SELECT c_custkey FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey",
    "top_n": "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10",
    "top_n_list": "SELECT p_partkey FROM part ORDER BY p_name DESC, p_partkey LIMIT 1000",
    "distinct_sorted": "SELECT DISTINCT s_nationkey FROM supplier ORDER BY 1",
    "group_count_sorted": "SELECT count(*) FROM customer GROUP BY c_nationkey ORDER BY 1 DESC",
    "having_count": "SELECT c_nationkey FROM customer WHERE c_nationkey <> 0 GROUP BY 1"
    " HAVING count(*) >= 60 ORDER BY count(*) DESC, 1",
    "join_three_way": "SELECT o_orderkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    " ORDER BY 1",
    "join_three_way_date": "SELECT o_orderkey FROM orders JOIN lineitem"
    " ON o_orderkey = l_orderkey ORDER BY 1",
    "join_group_sum": "SELECT c_name FROM orders JOIN customer ON o_custkey = c_custkey"
    " GROUP BY 1 ORDER BY sum(CAST(o_totalprice AS DECIMAL(12,2))) DESC, 1",
    "join_left": "SELECT c_custkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey"
    " AND o_orderstatus = 'P' ORDER BY o_totalprice NULLS FIRST, c_custkey, o_orderkey",
    "view_salesday": f"SELECT y FROM ({ORACLES['view_salesday']}) ORDER BY y, m, d, sales DESC",
    "view_sales_by_month": f"SELECT y FROM ({ORACLES['view_sales_by_month']}) ORDER BY y, m",
    "view_avg_by_year": f"SELECT y FROM ({ORACLES['view_avg_by_year']}) ORDER BY y",
    "view_salesday_customer": f"SELECT y FROM ({ORACLES['view_salesday_customer']})"
    " ORDER BY y, m, d, sales DESC",
    "view_top_customers": f"SELECT c_name FROM ({ORACLES['view_top_customers']})"
    " ORDER BY total DESC, c_name",
    "udf_discount_grouped": f"SELECT l_orderkey FROM ({ORACLES['udf_discount_grouped']})"
    " ORDER BY final_sale_value DESC, l_orderkey",
    "product_list": f"SELECT p_partkey FROM ({PART_SQL}) ORDER BY p DESC, p_partkey",
    "product_list_max": f"SELECT p_partkey FROM ({PART_SQL}) WHERE p <= 910 ORDER BY p, p_partkey",
    "product_list_min_max": f"SELECT p_partkey FROM ({PART_SQL}) WHERE p BETWEEN 910 AND 920"
    " ORDER BY p, p_partkey",
    "query_top_x": "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_sorted_results_come_in_order(spark, data, duck, name):
    expected = [row[0] for row in duck.sql(ORDERED[name]).fetchall()]
    column = duck.sql(ORDERED[name]).columns[0]
    if name == "group_count_sorted":
        column = "n"
    found = [row[column] for row in QUERIES[name](spark, data).collect()]
    assert found == expected


@pytest.mark.parametrize("name", ["view_salesday", "view_salesday_customer"])
def test_days_come_dearest_line_first(spark, data, name):
    rows = QUERIES[name](spark, data).collect()
    keys = [(row.y, row.m, row.d, -row.sales, row.p_partkey) for row in rows]
    assert keys == sorted(keys)
