"""Token ids in files: Huffman-coded blocks with bit offsets at which decoding can start.

A table of ids is a folder with two Parquet datasets. ``codes`` has the length of each id's
code, from which the canonical code follows. ``blocks/part=N`` has the documents in ascending
order, some to a block. A block decodes by itself: its row has its place among all ids, its
documents' ids and lengths, its bits, and the bit offset of every 128th id.

Parquet is the container because Spark's writer puts all of a job's files in place or none, on
any store; the bits are incompressible and stored as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm.common import binary_rows, kept, pieces_of, text_or_empty
from saleswright.llm.huffman import LIMIT, Code, code_lengths
from saleswright.llm.tokens import encoder

#: Ids in a block, but that a document is not cut.
BLOCK_IDS = 1 << 16

_RAW = (
    "part int, block int, n_ids long, doc_ids array<long>, lengths array<int>, ids binary, "
    "counts binary"
)
_BLOCK = (
    "part int, block int, start long, n_ids long, doc_ids array<long>, lengths array<int>, "
    "bits binary, checkpoints array<long>"
)


def _lists(values: pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)


def _kind(vocabulary: str, end_id: int) -> str:
    """How raw ids are kept: in two bytes where all of the vocabulary's fit."""
    return "<u2" if max(encoder(vocabulary).size - 1, end_id) < 1 << 16 else "<u4"


def _blocks_of_ids(docs: DataFrame, vocabulary: str, end_id: int, kind: str) -> DataFrame:
    """Raw blocks, in order of doc_id over the partitions and in them. The last row of a partition
    is no block (its number is -1) but has the counts of all its ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        counts = np.zeros(0, dtype=np.int64)
        for batch in pieces_of(batches):
            ids, ends = encoder(vocabulary).encode(batch.column(1))
            ids = np.insert(ids, ends, end_id).astype(kind)
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            lengths = np.diff(ends, prepend=0) + 1
            ends = np.cumsum(lengths)
            # A block ends with the document that reaches the next multiple of its size.
            mark = ends // BLOCK_IDS
            last = np.flatnonzero(np.append(mark[1:] != mark[:-1], True)) + 1
            n = len(last)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part), pa.int32()),
                    pa.array(np.arange(block, block + n), pa.int32()),
                    pa.array(np.diff(ends[last - 1], prepend=0), pa.int64()),
                    _lists(batch.column(0), last),
                    _lists(pa.array(lengths, pa.int32()), last),
                    binary_rows(ids, ends[last - 1] * ids.itemsize),
                    pa.nulls(n, pa.binary()),
                ],
                names,
            )
            block += n
        used = np.flatnonzero(counts)
        if len(used):
            pairs = np.stack((used, counts[used]), axis=1).astype("<i8").tobytes()
            row = [[part], [-1], [0], [[]], [[]], [b""], [pairs]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            kinds += [pa.list_(pa.int32()), pa.binary(), pa.binary()]
            arrays = [pa.array(x, kind) for x, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["part", "block", "n_ids", "doc_ids", "lengths", "ids", "counts"]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("t"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("t")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_rows.select("doc_id", F.col("t").alias("text")).mapInArrow(encode, _RAW)


def _count_ids(raw: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column(0):
                ids, n = np.frombuffer(pairs.as_buffer(), "<i8").reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "n"])

    counted = raw.select("counts").filter("counts IS NOT NULL").mapInArrow(count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, limit: int = LIMIT
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order.

    Null doc_ids come first, and rows of one doc_id in an order fixed by their texts; repeated
    rows are written as often as they occur. A null or empty text is ``end_id`` alone. Columns
    but doc_id and text are not read. No documents make a table of no blocks. An existing
    table is an error.

    The texts are sorted and encoded once, in one shuffle; the ids are kept in the shared folder
    with each task's counts, which are added up (at most one row per id of the vocabulary comes to
    the driver, and one total per partition), and then coded.
    """
    kind = _kind(vocabulary, end_id)
    written = kept(_blocks_of_ids(docs, vocabulary, end_id, kind), "token-ids")
    counts = np.array(
        [(r["id"], r["n"]) for r in _count_ids(written).orderBy("id").collect()], dtype=np.int64
    ).reshape(-1, 2)
    raw = written.filter("block >= 0").drop("counts")
    symbols, lengths = counts[:, 0], code_lengths(counts[:, 1], limit)
    spark = docs.sparkSession
    book = spark.createDataFrame(
        pa.table({"id": pa.array(symbols), "length": pa.array(lengths)}).to_pandas(),
        "id long, length long",
    )
    book.coalesce(1).write.parquet(f"{path}/codes")
    totals = raw.groupBy("part", "block").agg(F.sum("n_ids").alias("n"))
    by_part = totals.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, starts = 0, {}
    for row in by_part:
        starts[row["part"]] = before
        before += row["n"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Code(symbols, lengths)
        for batch in batches:
            part = batch.column(0).to_numpy()
            coded = [
                codes.encode(np.frombuffer(ids.as_buffer(), kind)) for ids in batch.column("ids")
            ]
            base = np.array([starts[p] for p in part.tolist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(base + batch.column("before").to_numpy()),
                    *batch.columns[2:5],
                    pa.array([x[0] for x in coded], pa.binary()),
                    pa.array([x[1] for x in coded], pa.list_(pa.int64())),
                ],
                _BLOCK.replace(",", "").split()[::2],
            )

    # Blocks of one part: as many as one task wrote.
    offsets = kept(_starts_in_part(raw), "block-starts")
    placed = raw.join(offsets, ["part", "block"]).select(
        "part", "block", "n_ids", "doc_ids", "lengths", "ids", "before"
    )
    blocks = placed.mapInArrow(code, _BLOCK).sortWithinPartitions("part", "block")
    blocks.write.partitionBy("part").option("compression", "none").parquet(f"{path}/blocks")


def _starts_in_part(raw: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))
    return raw.select("part", "block", start.alias("before"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written table: doc_id, start (ids of all documents before it),
    n_tokens and ids (little-endian unsigned 32-bit). Blocks decode in any order and task."""
    book = spark.read.parquet(f"{path}/codes").orderBy("id").collect()
    symbols = np.array([row["id"] for row in book], dtype=np.int64)
    lengths = np.array([row["length"] for row in book], dtype=np.int64)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Code(symbols, lengths)
        for whole in batches:
            for batch in pieces_of([whole], "bits", 4 << 20):
                col = dict(zip(batch.schema.names, batch.columns, strict=True))
                blocks = [
                    (bits.as_py(), offsets.values.to_numpy(), n)
                    for bits, offsets, n in zip(
                        col["bits"], col["checkpoints"], col["n_ids"].to_pylist(), strict=True
                    )
                ]
                ids = np.concatenate(codes.decode(blocks)).astype("<u4")
                n_tokens = col["lengths"].flatten().to_numpy()
                ends = np.cumsum(n_tokens, dtype=np.int64)
                first = np.concatenate(([0], np.cumsum(col["n_ids"].to_numpy())[:-1]))
                docs = pa.compute.list_value_length(col["lengths"]).to_numpy()
                start = np.repeat(col["start"].to_numpy() - first, docs) + ends - n_tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        col["doc_ids"].flatten(),
                        pa.array(start),
                        pa.array(n_tokens, pa.int64()),
                        binary_rows(ids, ends * 4),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    columns = ["start", "n_ids", "doc_ids", "lengths", "bits", "checkpoints"]
    return blocks.select(*columns).mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary"
    )
