"""What the corpus operators share: inputs, written intermediate tables, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.session import scratch_path

#: Bytes of text that a Python task turns into objects at a time.
SLICE_BYTES = 8 << 20

#: [\x20\x09-\x0D], the white space of all contracts.
SPACE = " \t\n\x0b\x0c\r"


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster it is installed or shipped with the job (``--py-files``); where it lies at the
    same path, or all run on one machine, this is enough.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored_row_id() -> Column:
    """An id of a row read from Parquet files: 16 bytes made of its file and its place there.

    It is the same in every job and however the scan is cut, so that results of several scans can
    meet on it. ``monotonically_increasing_id()`` is not: Spark cuts files by the number of cores,
    which can change between two jobs.
    """
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return F.unhex(F.md5(place))


def kept(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no more than
    the tasks it ran, and what comes after sees one fixed copy."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# monotonically_increasing_id() keeps the partition above bit 33, the place in it below.
_PLACE_BITS = 33


def positions(rows: DataFrame, keys: list[str], order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``idx``, their position among the rows of one key from 0, and ``n``, how many
    the key has. Keys may not be null.

    The rows are range-partitioned and sorted once and written with partition and place, so that
    the numbers cannot change, and one hot key spreads over many tasks; only counts per partition
    and key are added up. Rows that are alike in all of ``order`` are spread by a salt.
    """
    names = rows.columns
    by = [*keys, *order, F.col("_salt")]
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    marked = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    marked = kept(marked.withColumn("_mark", F.monotonically_increasing_id()), label)
    marked = marked.withColumn("_part", F.shiftright("_mark", _PLACE_BITS))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = marked.groupBy(*keys, "_part").agg(F.min("_mark").alias("_first"), F.count("*").alias("_n"))
    runs = runs.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("n"),
    )
    return marked.join(runs, [*keys, "_part"]).select(
        *names, (F.col("_mark") + F.col("_shift")).alias("idx"), "n"
    )


def text_or_empty(df: DataFrame) -> Column:
    return F.coalesce(df["text"], F.lit(""))


def largest(df: DataFrame, value: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest positive ``value``, or all if there are fewer.

    Rows rank by 2^18ths of an octave, and equal ones by a hash of all columns. The place where
    ``n`` rows are full is found from counts, first by 64ths of an octave, then within one of
    these, then by hash, so no task sends its own ``n`` rows anywhere; only the last few rows, equal
    in all three, are sorted. ``df`` is read up to five times and should be a kept table.
    """
    if n <= 0:
        return df.limit(0)
    octave = F.log2(value) * 64
    finer = F.floor((octave - F.floor(octave)) * 4096)
    ranks = [-F.floor(octave), -finer, F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16))]
    chosen, level, left = F.lit(False), F.lit(True), n
    for rank in ranks:
        counts = df.filter(level).groupBy(rank.alias("rank")).agg(F.count("*").alias("rows"))
        last = None
        for row in sorted(counts.collect(), key=lambda r: r["rank"]):
            if row["rows"] > left:
                last = row["rank"]
                break
            left -= row["rows"]
        if last is None:
            return df.filter(chosen | level)
        chosen, level = chosen | (level & (rank < last)), level & (rank == last)
        if not left:
            return df.filter(chosen)
    rest = df.filter(level).orderBy(F.desc(value), *df.columns).limit(left)
    return df.filter(chosen).unionAll(rest)


def digest(column: Column) -> list[Column]:
    """A text's key: 128 bits, to join on where the text itself is too wide."""
    return [F.xxhash64(column), F.xxhash64(F.lit("second"), column)]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def pieces_of(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in each; a row is never cut."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(byte_lengths(values))
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def byte_lengths(values: pa.Array) -> np.ndarray:
    lengths = pa.compute.binary_length(values)
    return lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def binary_rows(data: np.ndarray, row_ends: np.ndarray) -> pa.Array:
    """``data`` cut into one binary value per row; ``row_ends`` counts bytes. Large rows fit."""
    ends = np.concatenate(([0], row_ends)).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))]
    return pa.Array.from_buffers(pa.large_binary(), len(row_ends), buffers).cast(pa.binary())
