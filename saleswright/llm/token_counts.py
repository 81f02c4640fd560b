"""Token counts: an exact histogram of encoded lengths and what follows from it.

Documents are summed up by their encoded length, which leaves one row per length that occurs.
Sums from the short and from the long end then answer totals, quantiles and totals cut at any
context limit, with no second pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import kept, pieces_of, text_or_empty
from saleswright.llm.tokens import encoder

#: Lengths that one group of the running sums spans.
SPAN = 4096


def encoded_lengths(docs: DataFrame, vocabulary: str, extra: int = 0) -> DataFrame:
    """One row per document: ``n_tokens``, its ids plus ``extra`` (such as an end id)."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            _, ends = encoder(vocabulary).encode(batch.column(0))
            counts = np.diff(ends, prepend=0) + extra
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return docs.select(text_or_empty(docs).alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per length that occurs, from a table with one length per row.

    Returns ``length``, ``n_docs`` of that length, ``docs_to`` and ``tokens_to`` (documents up to
    that length and their tokens), ``docs_over`` and ``tokens_over`` (longer ones) and
    ``truncated`` (all tokens left when documents are cut at ``length``). A null length counts
    as 0; no rows give no rows.

    The sums run over spans of lengths first, so that no window holds more than ``SPAN`` rows,
    but for the one over spans: as many rows as the longest document has thousands of tokens.
    """
    length = F.coalesce(F.col(column), F.lit(0)).cast("long")
    # Written, since both the spans and the rows are made of it: the texts are encoded once.
    counted = kept(
        lengths.groupBy(length.alias("length")).agg(F.count("*").alias("n_docs")), "lengths"
    )
    counted = counted.withColumns(
        {"n_tokens": F.col("length") * F.col("n_docs"), "_span": F.expr(f"length div {SPAN}")}
    )
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_span").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    spans = counted.groupBy("_span").agg(
        F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens")
    )
    none = F.lit(0).cast("long")
    spans = spans.select(
        "_span",
        F.coalesce(F.sum("_docs").over(before), none).alias("_docs_before"),
        F.coalesce(F.sum("_tokens").over(before), none).alias("_tokens_before"),
        F.sum("_docs").over(whole).alias("_all_docs"),
        F.sum("_tokens").over(whole).alias("_all_tokens"),
    )
    upto = (
        Window.partitionBy("_span")
        .orderBy("length")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    docs_to = F.col("_docs_before") + F.sum("n_docs").over(upto)
    tokens_to = F.col("_tokens_before") + F.sum("n_tokens").over(upto)
    return (
        counted.join(spans, "_span")
        .withColumns({"docs_to": docs_to, "tokens_to": tokens_to})
        .withColumns(
            {
                "docs_over": F.col("_all_docs") - F.col("docs_to"),
                "tokens_over": F.col("_all_tokens") - F.col("tokens_to"),
            }
        )
        .withColumn("truncated", F.col("tokens_to") + F.col("length") * F.col("docs_over"))
        .select(
            "length", "n_docs", "docs_to", "tokens_to", "docs_over", "tokens_over", "truncated"
        )
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: ``limit``, tokens left when documents are cut there, and how many
    documents are cut. A limit need not be a length that occurs."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    short = F.col("length") <= F.col("limit")
    cut: Column = F.when(short, F.col("length")).otherwise(F.col("limit")) * F.col("n_docs")
    return (
        histogram.join(F.broadcast(wanted))
        .groupBy("limit")
        .agg(
            F.sum(cut).alias("tokens"),
            F.sum(F.when(short, 0).otherwise(F.col("n_docs"))).alias("docs_cut"),
        )
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share: the least length that at least that share of the documents does not pass."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(float(x),) for x in shares], "share double")
    reached = F.col("docs_to") >= F.col("share") * (F.col("docs_to") + F.col("docs_over"))
    return (
        histogram.join(F.broadcast(wanted))
        .groupBy("share")
        .agg(F.min(F.when(reached, F.col("length"))).alias("length"))
    )
