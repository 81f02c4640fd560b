"""Lines that many documents share, found through two Bloom filters.

One filter holds the hashes of lines seen once, the other of those seen twice. Each task fills
its own pair; pairs are merged bit by bit, where a bit that two tasks set in the first filter is
set in the second: all bits of a line that two tasks saw are. So the merged second filter has
every line that occurs in two documents. Only lines it has are shuffled, summed per task
first, and counted exactly by their text.

The filters have 16 bits a line, up to ``MOST_BITS``; beyond, more lines pass as suspects and
are shuffled, and the counts stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import SPACE, kept, pieces_of, text_or_empty

#: Bits of a filter, at most: 64 MB.
MOST_BITS = 1 << 29
#: Confirmed lines that every task holds, at most, in bytes. More are joined to the documents.
BROADCAST_BYTES = 16 << 20
#: 64-bit words of a filter that are merged at a time.
_CHUNK = 1 << 13


def line_keys(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Keys of all lines in one array, the row of each, and the lines as they are."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    counts = pc.list_value_length(lines).to_numpy()
    flat = lines.flatten()
    keys = pc.ascii_trim(pc.ascii_lower(flat), characters=SPACE)
    return keys, np.repeat(np.arange(len(texts)), counts), flat


def _hashes(keys: pa.Array) -> np.ndarray:
    found = xxhash.xxh3_64_intdigest
    values = keys.cast(pa.binary()).to_pylist()
    return np.fromiter(map(found, values), np.uint64, len(values))


def _once_per_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the first of each row's equal hashes."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    first = np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))[: len(order)]
    return order[first]


def _bits(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each hash, and four bits in it."""
    word = (hashes >> np.uint64(24)) & np.uint64(words - 1)
    mask = np.zeros(len(hashes), dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return word.astype(np.int64), mask


class SeenTwice:
    """A pair of filters, for hashes seen once and seen twice."""

    def __init__(self, words: int) -> None:
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        unique, n = np.unique(hashes, return_counts=True)
        word, mask = _bits(unique, len(self.once))
        again = (n > 1) | ((self.once[word] & mask) == mask)
        np.bitwise_or.at(self.twice, word[again], mask[again])
        np.bitwise_or.at(self.once, word, mask)

    def merge(self, at: slice, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice[at] |= twice | (self.once[at] & once)
        self.once[at] |= once


def suspects_filter(docs: DataFrame, lines: int, min_chars: int) -> np.ndarray:
    """The words of the merged second filter; at most ``MOST_BITS`` come to the driver."""
    words = 1 << 14
    while words * 64 < min(16 * lines, MOST_BITS):
        words *= 2
    spark = docs.sparkSession
    chunk = min(_CHUNK, words)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = SeenTwice(words)
        for batch in pieces_of(batches):
            keys, rows, _ = line_keys(batch.column(0))
            long_enough = pc.utf8_length(keys).to_numpy() >= min_chars
            hashes = _hashes(keys.filter(pa.array(long_enough)))
            pair.add(hashes[_once_per_row(rows[long_enough], hashes)])
        for i in range(0, words, chunk):
            used = np.flatnonzero(pair.once[i : i + chunk]).astype("<u2")
            if len(used):
                once, twice = (x[i : i + chunk][used].tobytes() for x in (pair.once, pair.twice))
                row = [[i // chunk], [used.tobytes()], [once], [twice]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[0], pa.int32()), *(pa.array(x, pa.binary()) for x in row[1:])],
                    ["chunk", "used", "once", "twice"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[int, SeenTwice] = {}
        for batch in batches:
            for row in batch.to_pylist():
                pair = pairs.setdefault(row["chunk"], SeenTwice(chunk))
                used = np.frombuffer(row["used"], "<u2")
                once, twice = np.zeros(chunk, np.uint64), np.zeros(chunk, np.uint64)
                once[used] = np.frombuffer(row["once"], np.uint64)
                twice[used] = np.frombuffer(row["twice"], np.uint64)
                pair.merge(slice(None), once, twice)
        for i, pair in pairs.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([pair.twice.tobytes()], pa.binary())],
                ["chunk", "twice"],
            )

    # Few and large tasks fill filters, as each of them sends a pair.
    tasks = 4 * spark.sparkContext.defaultParallelism
    filled = docs.coalesce(tasks).mapInArrow(
        fill, "chunk int, used binary, once binary, twice binary"
    )
    parts = min(64, words // chunk)
    merged = filled.repartition(parts, "chunk").mapInArrow(merge, "chunk int, twice binary")
    result = np.zeros(words, np.uint64)
    for row in merged.collect():
        i = row["chunk"] * chunk
        result[i : i + chunk] = np.frombuffer(row["twice"], np.uint64)
    return result


def _suspects(
    words: np.ndarray, batch: pa.RecordBatch, min_chars: int
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Keys in the second filter, each once per row, with row and line (both from 0)."""
    keys, rows, _ = line_keys(batch.column("text"))
    hashes = _hashes(keys)
    word, mask = _bits(hashes, len(words))
    found = (words[word] & mask) == mask
    found &= pc.utf8_length(keys).to_numpy() >= min_chars
    at = np.flatnonzero(found)
    at = at[_once_per_row(rows[at], hashes[at])]
    return keys.take(pa.array(at)), rows[at], at - np.searchsorted(rows, rows[at])


def suspected_lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per row of ``docs`` and line key that the merged second filter has: ``key``, the
    row's doc_id and digests, and the ``line`` (from 0) it is first found at."""
    text = text_or_empty(docs)
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    lines = docs.agg(F.coalesce(F.sum(n_lines), F.lit(0))).first()[0]
    words = suspects_filter(docs.select("text"), lines, min_chars)
    twice = docs.sparkSession.sparkContext.broadcast(words)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            keys, rows, line = _suspects(twice.value, batch, min_chars)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    *(batch.column(name).take(at) for name in ("doc_id", "d1", "d2")),
                    pa.array(line, pa.int64()),
                ],
                ["key", "doc_id", "d1", "d2", "line"],
            )

    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_row_digests(docs), "text")
    return marked.mapInArrow(suspects, "key string, doc_id long, d1 long, d2 long, line long")


def _row_digests(docs: DataFrame) -> list:
    doc_id = docs["doc_id"].cast("long")
    return [
        F.xxhash64(doc_id, docs["text"]).alias("d1"),
        F.xxhash64(F.lit("second"), doc_id, docs["text"]).alias("d2"),
    ]


def dedup_lines(
    docs: DataFrame, min_docs: int, min_chars: int = 1, keep: str = "none"
) -> DataFrame:
    """Drop lines whose key occurs in at least ``min_docs`` rows of ``docs``.

    Texts are cut at \\n; a null or empty text is one empty line. A line's key is the line
    without [\\x20\\x09-\\x0D] at its ends, A-Z in lower case. Keys shorter than ``min_chars``
    code points stay. With ``keep="first"`` the first of a key's lines stays, by doc_id (nulls
    first), then text, then line; rows that repeat doc_id and text keep it alike. Every row is a
    document, repeated rows too; a line repeated in one text counts once. No rows give no rows.

    Returns ``row`` (the other columns, so that names cannot clash), ``n_lines``, ``n_dropped``
    and ``kept_text``: the lines that stay, joined by \\n.

    Lines that are confirmed go to every task while they are few, by the bytes they have. Else
    they meet the suspects by key and the documents by row, and lines without any need no join.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    found = suspected_lines(docs, min_chars)
    place = F.min(F.struct("doc_id", "d1", "d2", "line")).alias("first")
    counted = found.groupBy("key").agg(F.count("*").alias("n_docs"), *[place][: keep == "first"])
    confirmed = kept(counted.filter(F.col("n_docs") >= min_docs), "shared-lines")
    others = F.struct(*[docs[c] for c in docs.columns if c.lower() != "text"]).alias("row")
    result = f"row {_others_type(docs)}, n_lines long, n_dropped long, kept_text string"
    size = confirmed.agg(F.coalesce(F.sum(F.octet_length("key") + 16), F.lit(0))).first()[0]
    if keep == "none" and size <= BROADCAST_BYTES:
        drop = pa.array([row["key"] for row in confirmed.select("key").collect()], pa.string())

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces_of(batches):
                keys, rows, lines = line_keys(batch.column("text"))
                gone = pc.is_in(keys, value_set=drop).to_numpy(zero_copy_only=False)
                yield _rewritten(batch, rows, lines, gone)

        return docs.select(others, "text").mapInArrow(rewrite, result)

    first = F.col("first") if keep == "first" else F.lit(None).cast(_FIRST)
    stays = first.eqNullSafe(F.struct("doc_id", "d1", "d2", "line").cast(_FIRST))
    lists = (
        found.join(confirmed, "key")
        .select("d1", "d2", F.struct("key", F.when(stays, F.col("line")).alias("line")).alias("x"))
        .groupBy("d1", "d2")
        .agg(F.collect_set("x").alias("drop"))  # at most the lines of one text
    )
    marked = docs.select(others, "text", *_row_digests(docs))
    joined = marked.join(kept(lists, "dropped-lines"), ["d1", "d2"], "left")

    def rewrite_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            keys, rows, lines = line_keys(batch.column("text"))
            gone = np.zeros(len(keys), dtype=bool)
            starts = np.searchsorted(rows, np.arange(len(batch) + 1))
            for i, drop in enumerate(batch.column("drop").to_pylist()):
                if drop:
                    here = slice(starts[i], starts[i + 1])
                    wanted = pa.array([x["key"] for x in drop], pa.string())
                    among = pc.is_in(keys[here], value_set=wanted)
                    gone[here] = among.to_numpy(zero_copy_only=False)
                    firsts = [x["line"] for x in drop if x["line"] is not None]
                    gone[starts[i] + np.array(firsts, dtype=np.int64)] = False
            yield _rewritten(batch, rows, lines, gone)

    return joined.select("row", "text", "drop").mapInArrow(rewrite_each, result)


_FIRST = "struct<doc_id:bigint,d1:bigint,d2:bigint,line:bigint>"


def _others_type(docs: DataFrame) -> str:
    fields = [f for f in docs.schema if f.name.lower() != "text"]
    kinds = [f"`{f.name}`:{f.dataType.simpleString()}" for f in fields]
    return f"struct<{','.join(kinds)}>"


def _rewritten(
    batch: pa.RecordBatch, rows: np.ndarray, lines: pa.Array, gone: np.ndarray
) -> pa.RecordBatch:
    n_lines = np.bincount(rows, minlength=len(batch))
    n_dropped = np.bincount(rows[gone], minlength=len(batch))
    ends = np.concatenate(([0], np.cumsum(n_lines - n_dropped)))
    left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines.filter(pa.array(~gone)))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"),
            pa.array(n_lines, pa.int64()),
            pa.array(n_dropped, pa.int64()),
            pc.binary_join(left, "\n"),
        ],
        ["row", "n_lines", "n_dropped", "kept_text"],
    )
