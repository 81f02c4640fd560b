"""Tables kept in partitions by a range of keys, where a change rewrites only what it touches.

A partition holds the keys of one range of fixed width and has a folder of its own. A change reads the
partitions in which its condition selects a row, writes them anew in the run's own folder, and then
moves each of them there; all others keep their files. What will be moved is written down before
the first move, so a run that fails between two moves is finished by repeating it. Until then
readers see some partitions moved and others not. There is one writer per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from saleswright.operators.changes import (
    CONTENT,
    ROW_SET,
    Statement,
    same_place,
    table_property,
)
from saleswright.operators.rules import TableRules
from saleswright.sources.tables import quoted_name

RANGE = "key_range"
#: Table properties: the key column, and how many keys a range has.
KEY, WIDTH = "range_key", "range_width"
_MOVES = "key_range long, old string, new string"
#: How Spark names the folder of rows without a range.
_NO_RANGE = "__HIVE_DEFAULT_PARTITION__"
#: Partitions that one statement adds.
_AT_ONCE = 200


def with_range(rows: DataFrame, key: str, width: int) -> DataFrame:
    """Rows with the number of their key's range. A null key has none, and no partition."""
    return rows.withColumn(RANGE, F.floor(F.col(key) / width).cast("long"))


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Dealt out by key, so that a range is a few sorted files, however its rows came."""
    return rows.repartitionByRange(RANGE, key).sortWithinPartitions(RANGE, key)


def create_partitioned(
    spark: SparkSession, table: str, rows: DataFrame, base: str, key: str, width: int
) -> DataFrame:
    """A catalogue table of ``rows`` in partitions of ``width`` keys, with its files at ``base``."""
    ranged = with_range(rows, key, width)
    if not ranged.filter(F.col(RANGE).isNull()).isEmpty():
        raise ValueError(f"a row without {key} has no partition")
    first = f"{base}/run-0/{ROW_SET}={CONTENT}"
    _spread(ranged, key).write.mode("overwrite").partitionBy(RANGE).parquet(first)
    columns = ", ".join(
        f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in ranged.schema.fields
    )
    spark.sql(
        f"CREATE TABLE {quoted_name(table)} ({columns}) USING parquet PARTITIONED BY ({RANGE}) "
        f"LOCATION '{base}/none' TBLPROPERTIES ('{KEY}' = '{key}', '{WIDTH}' = '{width}')"
    )
    found = sorted(_ranges_at(spark, first))
    _add(spark, table, [(k, f"{first}/{RANGE}={k}") for k in found])
    return read_partitioned(spark, table)


def read_partitioned(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows. A filter by key reaches the partitions by the range that it implies; see
    ``keys_between``."""
    return spark.table(quoted_name(table)).drop(RANGE)


def keys_between(spark: SparkSession, table: str, low: int, high: int) -> DataFrame:
    """The rows with keys from ``low`` to ``high``, read from their partitions alone."""
    key, width = _layout(spark, table)
    here = F.col(RANGE).between(low // width, high // width) & F.col(key).between(low, high)
    return spark.table(quoted_name(table)).filter(here).drop(RANGE)


def locations(spark: SparkSession, table: str) -> dict[int, str]:
    """The folder of each partition: as many rows as the table has partitions."""
    return {part: partition_location(spark, table, part) for part in _partitions(spark, table)}


def _partitions(spark: SparkSession, table: str) -> list[int]:
    rows = spark.sql(f"SHOW PARTITIONS {quoted_name(table)}").collect()
    return [int(row["partition"].split("=")[1]) for row in rows]


def _locations_of(
    spark: SparkSession, table: str, parts: Iterable[int]
) -> dict[int, str | None]:
    """The folder of each of some partitions, or None. Only those that there are cost a statement."""
    there = set(_partitions(spark, table))
    return {part: partition_location(spark, table, part) if part in there else None for part in parts}


def partition_location(spark: SparkSession, table: str, part: int) -> str | None:
    """A partition's folder, or None if there is no such partition."""
    name = quoted_name(table)
    try:
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({RANGE} = {part})")
    except AnalysisException:
        return None
    return detail.filter(F.col("col_name") == "Location").first()["data_type"]


def run_partition_change(
    spark: SparkSession,
    table: str,
    base: str,
    run: str,
    change: Callable[[Statement], Statement],
    touches: Column | None = None,
    added: DataFrame | None = None,
    rules: TableRules | None = None,
    keys: tuple[int, int] | None = None,
) -> list[int]:
    """Change the partitions in which ``touches`` selects a row, in one repeatable run, and return
    their ranges.

    All partitions are searched for such rows, or, where ``keys`` says between which two keys (both
    included) all of them lie, only the partitions of these.

    ``change`` gets the rows of those partitions as a ``Statement``, and ``added`` are inserted after
    it; ranges that only they have become partitions. A partition without rows left is dropped. An
    update may not move a key to a range that the run does not touch. ``rules`` are checked before
    anything is moved. Partitions that another run has moved since are left alone.
    """
    key, width = _layout(spark, table)
    moves = _planned(spark, base, run)
    if moves is None:
        moves = _write(spark, table, base, run, change, touches, added, rules, keys, key, width)
    places = _locations_of(spark, table, [part for part, _, _ in moves])
    for part, old, new in moves:
        if not (_same(places[part], old) or _same(places[part], new)):
            raise ValueError(f"{table} has moved on to {places[part]} in {RANGE} {part}")
    name = quoted_name(table)
    fresh = []
    for part, _, new in moves:
        place = places[part]
        if _same(place, new):
            continue
        spec = f"PARTITION ({RANGE} = {part})"
        if new is None:
            spark.sql(f"ALTER TABLE {name} DROP {spec}")
        elif place is None:
            fresh.append((part, new))
        else:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{new}'")
    _add(spark, table, fresh)
    spark.catalog.refreshTable(name)
    return [part for part, _, _ in moves]


def _write(
    spark: SparkSession,
    table: str,
    base: str,
    run: str,
    change: Callable[[Statement], Statement],
    touches: Column | None,
    added: DataFrame | None,
    rules: TableRules | None,
    keys: tuple[int, int] | None,
    key: str,
    width: int,
) -> list[tuple[int, str | None, str | None]]:
    """Write the changed partitions beside the old ones, and then what is to be moved."""
    whole = spark.table(quoted_name(table))
    touched = set()
    if touches is not None:
        searched = whole
        if keys is not None:
            low, high = keys
            searched = whole.filter(F.col(RANGE).between(low // width, high // width))
            touches = touches & F.col(key).between(low, high)
        touched |= {r[RANGE] for r in searched.filter(touches).select(RANGE).distinct().collect()}
    if added is not None:
        ranged = with_range(added, key, width)
        touched |= {r[RANGE] for r in ranged.select(RANGE).distinct().collect()}
    if None in touched:
        raise ValueError(f"a row without {key} has no partition")
    made = change(Statement.of(whole.filter(F.col(RANGE).isin(list(touched)))))
    if added is not None:
        made = made.insert(ranged)
    path = f"{base}/run-{run}"
    rows = _spread(with_range(made.rows, key, width), key)
    rows.write.mode("overwrite").partitionBy(ROW_SET, RANGE).parquet(path)
    kept = _ranges_at(spark, f"{path}/{ROW_SET}={CONTENT}")
    if not kept <= touched:
        raise ValueError(f"keys moved to ranges that the run does not touch: {kept - touched}")
    if rules:
        folders = StructType([StructField(ROW_SET, StringType()), StructField(RANGE, LongType())])
        plain = [f for f in rows.schema.fields if f.name not in (ROW_SET, RANGE)]
        written = spark.read.schema(StructType([*plain, *folders])).parquet(path)
        rules.require(rules.faults_of(Statement(written.drop(RANGE))))
    places = _locations_of(spark, table, touched)
    moves = [
        (
            part,
            places[part],
            f"{path}/{ROW_SET}={CONTENT}/{RANGE}={part}" if part in kept else None,
        )
        for part in sorted(touched)
    ]
    frame = spark.createDataFrame(moves, _MOVES)
    frame.coalesce(1).write.mode("overwrite").parquet(f"{base}/moves-{run}")
    return moves


def _ranges_at(spark: SparkSession, path: str) -> set[int | None]:
    """The ranges that have a folder at ``path``, by one listing of it; no folder of a range and no
    file is opened. None stands for rows without a key."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return set()
    names = [path.getName() for path in fs.FileUtil.stat2Paths(store.listStatus(folder))]
    parts = [name.removeprefix(f"{RANGE}=") for name in names if name.startswith(f"{RANGE}=")]
    return {None if part == _NO_RANGE else int(part) for part in parts}


def _planned(
    spark: SparkSession, base: str, run: str
) -> list[tuple[int, str | None, str | None]] | None:
    """What a run has written down to move, or None if it has not come so far."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/moves-{run}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        return None
    rows = spark.read.schema(_MOVES).parquet(f"{base}/moves-{run}").collect()
    return sorted(tuple(row) for row in rows)


def _layout(spark: SparkSession, table: str) -> tuple[str, int]:
    return table_property(spark, table, KEY), int(table_property(spark, table, WIDTH))


def _same(one: str | None, other: str | None) -> bool:
    if one is None or other is None:
        return one is other
    return same_place(one, other)


def _add(spark: SparkSession, table: str, parts: list[tuple[int, str]]) -> None:
    for i in range(0, len(parts), _AT_ONCE):
        some = " ".join(
            f"PARTITION ({RANGE} = {k}) LOCATION '{place}'" for k, place in parts[i : i + _AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {quoted_name(table)} ADD IF NOT EXISTS {some}")
