"""Benchmark decontamination: windows of test items' words found in documents.

The windows of the benchmark are a set of hashes that every task holds. Documents are scanned
by one expression: each window of a text's words is hashed and looked up, and only those found
leave the row, with their words. These meet the benchmark's windows in a broadcast join on the
words themselves, which verifies them and names the items. The texts are never shuffled.

A benchmark of more than ``BLOCK_WINDOWS`` windows is taken in blocks, one scan each. All of it
is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import kept, union_all
from saleswright.llm.simhash_dedup import numbered

WINDOW = 10
#: Windows that one scan looks for, at most: what is sent to every task.
BLOCK_WINDOWS = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a text whose A-Z are in lower case, and of any text.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A text's words, A-Z in lower case; none of a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({_WORD})"), F.lit(1))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per different window: ``hash``, ``words``, ``len`` and the ``items`` it is of.

    An item of fewer words than ``size``, but not none, is one window. A null item_id is no
    item's name: its windows count as hits, but name nothing.
    """
    starts = "sequence(1, greatest(size(w) - {0} + 1, 1))".format(size)
    cut = f"transform(if(size(w) = 0, array(), {starts}), i -> slice(w, i, {size}))"
    return (
        benchmark.select(
            benchmark["item_id"].cast("string").alias("item"), words(benchmark["text"]).alias("w")
        )
        .select("item", F.explode(F.expr(cut)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
        .select(F.xxhash64("words").alias("hash"), "words", F.size("words").alias("len"), "items")
    )


def _scan(texts: DataFrame, block: list) -> DataFrame:
    """Rows with their number of words and the windows of one block that may occur in them."""
    by_length: dict[int, list[int]] = {}
    for row in block:
        by_length.setdefault(row["len"], []).append(row["hash"])
    found = []
    for length, hashes in sorted(by_length.items()):
        lowest = "bigint(-9223372036854775808)"  # as a literal its digits alone are too large
        known = ",".join(lowest if h == -(1 << 63) else f"{h}L" for h in hashes)
        here = f"slice(w, i, {length})"
        starts = f"if(size(w) < {length}, array(), sequence(1, size(w) - {length} + 1))"
        hits = f"filter({starts}, i -> xxhash64({here}) IN ({known}))"
        found.append(f"transform({hits}, i -> named_struct('at', i, 'words', {here}))")
    none = "cast(array() AS array<struct<at: int, words: array<string>>>)"
    joined = f"concat({', '.join(found)})" if found else none
    # transform over one element names the words, so that they are made once for a row.
    scanned = F.expr(
        f"transform(array(w), w -> named_struct('n', size(w), 'found', {joined}))[0]"
    )
    lets = texts.select("rid", "doc_id", words(F.col("text")).alias("w"))
    return lets.select("rid", "doc_id", scanned.alias("s"))


def find_hits(texts: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of ``texts`` (rid, doc_id, text): rid, doc_id, ``n_words``, ``hits`` (the
    places of its words in any occurrence of a window, from 1, ascending) and ``items`` (the
    item_ids whose windows occur, as strings, sorted).

    A null or wordless text has no words and no hits. Repeated rows are rows of their own. With
    no benchmark words nothing is hit. ``rid`` numbers the rows.
    """
    windows = kept(benchmark_windows(benchmark, size), "windows")
    known = windows.select("hash", "len").orderBy("len", "hash").collect()
    blocks = [known[i : i + BLOCK_WINDOWS] for i in range(0, len(known), BLOCK_WINDOWS)] or [[]]
    # As many windows as were just collected block by block go to each task.
    if len(known) <= BLOCK_WINDOWS:
        windows = F.broadcast(windows)
    scans = union_all([_scan(texts, block) for block in blocks])
    found = scans.select(
        "rid", "doc_id", F.col("s.n").alias("n"), F.explode_outer("s.found").alias("f")
    )
    named = found.select("rid", "doc_id", "n", "f.at", "f.words")
    verified = named.join(windows.select("words", "len", "items"), "words", "left")
    span = F.when(F.col("len").isNotNull(), F.sequence("at", F.col("at") + F.col("len") - 1))
    return (
        verified.groupBy("rid", "doc_id")
        .agg(
            F.max("n").cast("long").alias("n_words"),
            F.collect_list(span).alias("spans"),  # of one text
            F.collect_set("items").alias("lists"),
        )
        .select(
            "rid",
            "doc_id",
            "n_words",
            F.array_sort(F.array_distinct(F.flatten("spans"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"),
        )
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which any window occurs. Other columns are kept as they are."""
    rows = kept(numbered(docs), "numbered")
    hits = find_hits(rows.select("rid", "row.doc_id", "row.text"), benchmark, size)
    gone = kept(hits.filter(F.size("hits") > 0).select("rid"), "contaminated")
    return rows.join(gone, "rid", "left_anti").select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the words that are hit cut out of ``text``; what stands between words stays."""
    rows = kept(numbered(docs), "numbered")
    hits = find_hits(rows.select("rid", "row.doc_id", "row.text"), benchmark, size)
    spans = kept(hits.filter(F.size("hits") > 0).select("rid", "hits"), "spans")
    parts = F.split("row.text", _ANY_WORD, -1)
    found = F.regexp_extract_all("row.text", F.lit(f"({_ANY_WORD})"), F.lit(1))
    left = F.expr(
        "transform(array(named_struct('p', p, 'w', w, 'h', hits)), x -> array_join(transform(x.p, "
        "(part, i) -> concat(if(i = 0 or array_contains(x.h, i), '', x.w[i - 1]), part)), ''))[0]"
    )
    cut = rows.join(spans, "rid").select("row", parts.alias("p"), found.alias("w"), "hits")
    columns = [left.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    cleaned = cut.select(F.struct(*columns).alias("row"))
    return rows.join(spans, "rid", "left_anti").select("row").unionAll(cleaned).select("row.*")
