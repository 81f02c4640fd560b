"""Loading the declared tables in one checked run: rows that break a rule are kept apart, with why.

Files are read permissively. Each row is judged by its own text first (malformed lines, values that do
not fit their type, NULL, lengths), then by its key and its references to rows that are loaded.
Tables are taken parents first, so a child of a rejected row is rejected too. What passes becomes a run
of its table; what does not goes to the rejects of the same run. A load that is repeated replaces both.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from saleswright.functions.scalar import is_stamp_text, stamp_from_text
from saleswright.operators.quality import duplicate_keys
from saleswright.operators.rules import BrokenRules
from saleswright.session import scratch_path
from saleswright.sources.bucketed import CoBucketed, write_co_bucketed
from saleswright.sources.schemas import ORDER, ORDER_ITEM, TABLES, TableSpec, default_column
from saleswright.sources.tables import RUN, read_runs, write_run

_FAULTS, _RECORD, _CORRUPT = "_faults", "_record", "_corrupt"
#: Keys at fault that are broadcast, some 60 bytes each once hashed; more are joined as Spark sees fit.
_FEW = 1 << 21
REJECTED = "reason string, record string"


@dataclass(frozen=True)
class Files:
    """Files of one table, and the columns that they hold, in order (by default all)."""

    path: str
    given: list[str] | None = None
    file_format: str = "csv"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_text(self) -> bool:
        """Whether values come as texts, in whatever spelling, and lines can be malformed."""
        return self.file_format in ("csv", "json")


def _value(f: StructField) -> Column:
    """A text in its declared type, or NULL where it does not fit."""
    text = F.col(f.name)
    if isinstance(f.dataType, TimestampNTZType):
        spelled = F.when(is_stamp_text(text), stamp_from_text(text))
        return spelled.otherwise(text.try_cast(f.dataType))
    return text.try_cast(f.dataType)


def _spelled(f: StructField, files: Files) -> Column:
    """What a record holds for a value, if the files spell it as Spark does."""
    return (F.col(f.name).cast("string") if files.is_text else F.col(f.name)).alias(f.name)


def respelled_record(files: Files, spec: TableSpec) -> Column:
    """``_record`` of rows that were parsed with ``spared``: of values where it was left out."""
    spelled = [_spelled(f, files) for f in _given(files, spec)]
    return F.coalesce(_RECORD, F.to_json(F.struct(*spelled)))


def _given(files: Files, spec: TableSpec) -> list[StructField]:
    return [spec.schema[name] for name in files.given or spec.schema.names]


def parsed_rows(
    spark: SparkSession, files: Files, spec: TableSpec, spared: bool = False
) -> DataFrame:
    """All rows of the files under the declared schema, with ``_faults``, what is wrong with each by
    itself, and ``_record``, the row as it came. Columns that are not given take their defaults.

    With ``spared``, ``_record`` is NULL where ``respelled_record`` makes the same of the values, so
    that most rows are stored and shuffled once and not twice over.
    """
    given = _given(files, spec)
    reader = spark.read.format(files.file_format).options(**files.options)
    if files.is_text:
        fields = [*(StructField(f.name, StringType()) for f in given), StructField(_CORRUPT, StringType())]
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        rows = reader.schema(StructType(fields)).load(files.path)
        values = {f.name: _value(f) for f in given}
    else:
        rows = reader.schema(StructType(given)).load(files.path).withColumn(_CORRUPT, F.lit(None))
        values = {f.name: F.col(f.name) for f in given}
    faults = [F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed"))]
    columns = []
    for f in spec.schema.fields:
        there = f.name in values
        value = values[f.name] if there else default_column(spec.defaults.get(f.name)).cast(f.dataType)
        columns.append(value.alias(f.name))
        if there:
            misfit = F.col(f.name).isNotNull() & value.isNull()
            faults.append(F.when(misfit, F.lit(f"{f.name} cannot hold its text")))
        if not f.nullable:
            empty = F.col(f.name).isNull() if there else value.isNull()
            faults.append(F.when(empty & F.col(_CORRUPT).isNull(), F.lit(f"{f.name} is null")))
        if f.name in spec.text_limits:
            most = spec.text_limits[f.name]
            faults.append(F.when(F.length(value) > most, F.lit(f"{f.name} over {most}")))
    record = F.coalesce(_CORRUPT, F.to_json(F.struct(*[F.col(f.name) for f in given])))
    if spared:
        same = [F.col(_CORRUPT).isNull()]
        if files.is_text:
            same += [F.col(f.name).eqNullSafe(values[f.name].cast("string")) for f in given]
        record = F.when(~reduce(Column.__and__, same), record)
    return rows.select(*columns, F.array_compact(F.array(*faults)).alias(_FAULTS), record.alias(_RECORD))


def judged_rows(
    rows: DataFrame, spec: TableSpec, existing: DataFrame, parents: dict[str, DataFrame]
) -> DataFrame:
    """Parsed rows with the faults that their keys and references add, where they had none.

    All rows of a key that repeats in the load are at fault, since files have no first row, and so are
    those of a key that is there already. The keys at fault and the references without a parent are
    found from these columns alone and stored; up to ``_FEW`` of them are broadcast, so that rows are
    only shuffled to find more. In a session without broadcasts references are looked up row by row,
    so that Spark can split the rows of one that many share; parents' keys are unique.
    """
    key = spec.key
    sound = F.size(_FAULTS) == 0
    keys = rows.filter(sound).select(key)
    taken = duplicate_keys(keys, [key]).select(F.col(key).alias("_taken"))
    there = existing.select(F.col(key).alias("_taken")).join(
        keys, F.col("_taken") == keys[key], "left_semi"
    )
    taken = _found(taken.unionAll(there).distinct(), f"taken-{spec.name}")
    found = rows.join(taken, rows[key] == taken["_taken"], "left")
    faults = [F.when(F.col("_taken").isNotNull(), F.lit(f"{key} repeated"))]
    for i, reference in enumerate(spec.foreign_keys):
        name = f"_parent{i}"
        parent = parents[reference.parent].select(F.col(reference.parent_column).alias(name))
        if _broadcasts(rows.sparkSession):
            value = F.col(reference.column)
            values = rows.filter(sound & value.isNotNull()).select(value.alias(name)).distinct()
            missing = _found(values.join(parent, name, "left_anti"), f"lost-{reference.name}")
            found = found.join(missing, found[reference.column] == missing[name], "left")
            lost = F.col(name).isNotNull()
        else:
            found = found.join(parent, found[reference.column] == parent[name], "left")
            lost = F.col(reference.column).isNotNull() & F.col(name).isNull()
        faults.append(F.when(lost, F.lit(reference.name)))
    more = F.when(sound, F.array_compact(F.array(*faults))).otherwise(F.col(_FAULTS))
    return found.select(*spec.schema.names, more.alias(_FAULTS), _RECORD)


def load_tables(
    spark: SparkSession,
    files: dict[str, Files],
    base: str,
    load: str,
    stop: bool = False,
) -> DataFrame:
    """Load files of the declared tables, by name, into runs under ``base``; return one row per table
    and reason: table_name, reason (null for rows that were loaded), n.

    With ``stop``, a table with any row at fault ends the load before that table is written.
    """
    summaries = []
    for name in _parents_first(files):
        spec, target = TABLES[name], f"{base}/{name}"
        parsed = _written(parsed_rows(spark, files[name], spec, spared=True), f"parsed-{name}")
        parents = {
            k.parent: _stored(spark, f"{base}/{k.parent}", TABLES[k.parent]) for k in spec.foreign_keys
        }
        existing = _stored(spark, target, spec, but=load)
        judged = _written(judged_rows(parsed, spec, existing, parents), f"judged-{name}")
        reason = F.when(F.size(_FAULTS) > 0, F.array_join(_FAULTS, "; ")).alias("reason")
        counts = judged.groupBy(reason).agg(F.count("*").alias("n"))
        if stop:
            broken = counts.filter("reason IS NOT NULL").collect()  # one row per mix of faults
            if broken:
                raise BrokenRules({r["reason"]: r["n"] for r in broken})
        write_run(judged.filter(F.size(_FAULTS) == 0).select(*spec.schema.names), target, load)
        record = respelled_record(files[name], spec).alias("record")
        rejected = judged.filter(F.size(_FAULTS) > 0).select(reason, record)
        rejected.write.mode("overwrite").parquet(f"{base}/rejects/{RUN}={load}/table_name={name}")
        summaries.append(counts.select(F.lit(name).alias("table_name"), "reason", "n"))
    found = summaries[0]
    for more in summaries[1:]:
        found = found.unionAll(more)
    return found


def read_rejects(spark: SparkSession, base: str) -> DataFrame:
    """The rows that loads have kept apart: table_name, reason, record (the row as it came), run_id."""
    schema = f"{REJECTED}, {RUN} string, table_name string"
    return spark.read.schema(schema).parquet(f"{base}/rejects").select(
        "table_name", "reason", "record", RUN
    )


def bucket_order_lines(spark: SparkSession, base: str, buckets: int | None = None) -> CoBucketed:
    """The loaded orders and lines side by side in buckets, for joins that shuffle neither."""
    return write_co_bucketed(
        read_runs(spark, f"{base}/{ORDER.name}", ORDER.schema),
        read_runs(spark, f"{base}/{ORDER_ITEM.name}", ORDER_ITEM.schema),
        f"{base}/order_lines",
        ORDER.key,
        "OrderId",
        buckets,
    )


def _parents_first(names: Iterable[str]) -> list[str]:
    """The tables in an order in which each comes after those it refers to."""
    left, found = list(names), []
    while left:
        for name in left:
            if not any(k.parent in left for k in TABLES[name].foreign_keys):
                found.append(name)
                left.remove(name)
                break
    return found


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _broadcasts(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def _found(keys: DataFrame, label: str) -> DataFrame:
    """Keys stored and, if they are few, to be broadcast to the rows that they are looked up for."""
    stored = _written(keys, label)
    few = _broadcasts(keys.sparkSession) and stored.count() <= _FEW
    return F.broadcast(stored) if few else stored


def _stored(spark: SparkSession, target: str, spec: TableSpec, but: str | None = None) -> DataFrame:
    """A table's rows, without those of one run; none if nothing has been loaded."""
    schema = StructType([*spec.schema.fields, StructField(RUN, StringType())])
    try:
        rows = spark.read.schema(schema).parquet(target)
    except AnalysisException:
        return spark.createDataFrame([], schema).drop(RUN)
    return rows.filter(F.col(RUN) != but if but else F.lit(True)).drop(RUN)
