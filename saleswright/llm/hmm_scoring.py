"""Scoring of texts by a hidden Markov language model trained on the corpus.

Words are counted over all training texts. The most frequent, ``HEAD`` at most and seen three
times at least, are symbols of the model; all others are one symbol, ``tail``, times the word's own share among them, with one count more
for a word never seen. That share does not depend on the state, so the likelihood of a text is
that of its symbols times the shares of its tail words, and stays exact. So the model keeps
one size, while the counts of all words stay in a table and are joined to the tail words.

Baum-Welch: every round, each task adds up the expected counts of its texts, these are summed
over the tasks by symbol, and the driver gets one row per symbol. The first model comes from
which frequent words share documents. All rounds read all training texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import binary_rows, kept, largest, pieces_of, text_or_empty
from saleswright.llm.hmm_model import (
    Counts,
    Hmm,
    add_expected,
    first_model,
    log10_likelihood,
    refined,
    word_clusters,
)

#: Words that are symbols of the model; with two more, symbols fit 16 bits.
HEAD = (1 << 16) - 2
#: Rarer words tell nothing of a state; together they tell how likely a word not seen yet is.
LEAST_COUNT = 3
STATES = 8
ROUNDS = 3
#: Frequent words that the first model is made from.
COMPANY = 256
#: The end of a text in the table of counts: no word is empty.
END = ""


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text (null: empty) modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words, coded, and the row of each. A-Z in lower case, cut at [\\x20\\x09-\\x0D]+."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    flat = lists.flatten()
    some = pc.not_equal(flat, "")
    return flat.filter(some).dictionary_encode(), rows[some.to_numpy(zero_copy_only=False)]


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and its count ``c`` in all rows of ``texts`` (text); an end, the empty word, per
    row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            coded, _ = _words(batch.column(0))
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            words = pa.concat_arrays([coded.dictionary, pa.array([END])])
            n = np.append(n, len(batch))
            yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

    found = texts.select("text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("c"))


class Symbols:
    """Symbols of words: the head in order of frequency, then the tail, then the end."""

    def __init__(
        self, words: list[str], counts: np.ndarray, tail_tokens: int, end_count: int
    ) -> None:
        self.of = {word: i for i, word in enumerate(words)}
        self.tail, self.end = len(words), len(words) + 1
        self.counts = np.concatenate((counts, [tail_tokens, end_count])).astype(np.int64)

    def __len__(self) -> int:
        return self.end + 1


def encoded(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """The rows with ``rid``, doc_id, ``held_out``, ``ids`` (symbols, 16 bits each), ``tail`` (its
    words that are not in the head, in order), ``n_tokens``, ``n_known`` and ``log_counts`` (sum
    of log10(c + 1)) of the head's words and the end."""
    log_counts = np.log10(symbols.counts + 1.0)
    shared = docs.sparkSession.sparkContext.broadcast(symbols)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = shared.value
        get, tail = symbols.of.get, symbols.tail
        for batch in pieces_of(batches):
            n = len(batch)
            coded, rows = _words(batch.column(3))
            known = [get(word, tail) for word in coded.dictionary.to_pylist()]
            codes = coded.indices.to_numpy()
            ids = np.array(known, dtype=np.int64)[codes]
            is_tail = ids == tail
            words = coded.dictionary.take(pa.array(codes[is_tail]))
            tails = np.concatenate(([0], np.cumsum(np.bincount(rows[is_tail], minlength=n))))
            lengths = np.bincount(rows, minlength=n)
            ends = np.cumsum(lengths)
            n_known = lengths - np.bincount(rows[is_tail], minlength=n)
            n_known += symbols.counts[symbols.end] > 0
            known_logs = np.where(is_tail, 0, log_counts[ids])
            logs = np.bincount(rows, known_logs, n) + log_counts[symbols.end]
            ids = np.insert(ids, ends, symbols.end).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    binary_rows(ids, (ends + np.arange(1, n + 1)) * 2),
                    pa.ListArray.from_arrays(pa.array(tails, pa.int32()), words),
                    pa.array(lengths + 1, pa.int64()),
                    pa.array(n_known, pa.int64()),
                    pa.array(logs, pa.float64()),
                ],
                ["rid", "doc_id", "held_out", "ids", "tail", "n_tokens", "n_known", "log_counts"],
            )

    return docs.select("rid", "doc_id", "held_out", "text").mapInArrow(
        encode,
        "rid long, doc_id long, held_out boolean, ids binary, tail array<string>, "
        "n_tokens long, n_known long, log_counts double",
    )


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ids = [np.frombuffer(x.as_buffer(), "<u2") for x in column]
    ends = np.cumsum([len(x) for x in ids])
    return np.concatenate([np.empty(0, "<u2"), *ids]).astype(np.int64), ends


def _rows_of(table: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """The rows of a matrix that are not all zero, numbered from ``first``."""
    used = np.flatnonzero(table.any(axis=1))
    columns = [pa.array(used + first, pa.int32())]
    columns += [pa.array(np.ascontiguousarray(x)) for x in table[used].T]
    yield pa.RecordBatch.from_arrays(columns, ["row", *(f"k{i}" for i in range(table.shape[1]))])


def _summed(rows: DataFrame, fill, width: int, height: int) -> np.ndarray:
    """The sum over all tasks of matrices that ``fill`` makes of their rows' symbols. Summed by
    row, so that the driver gets one matrix, whatever the number of tasks."""
    names = [f"k{i}" for i in range(width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((height, width))
        for batch in batches:
            for part in pieces_of([batch], "ids", 2 << 20):
                fill(table, *_sequences(part.column(0)))
        yield from _rows_of(table, 0)

    schema = ", ".join(["row int", *(f"{name} double" for name in names)])
    found = rows.select("ids").mapInArrow(partial, schema).groupBy("row")
    got = found.agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    table = np.zeros((height, width))
    at = got["row"].to_numpy()
    for i, name in enumerate(names):
        table[at, i] = got[name].to_numpy()
    return table


def train(rows: DataFrame, symbols: Symbols, states: int, rounds: int) -> Hmm:
    """The model of encoded training rows."""
    n = len(symbols)
    frequent = min(COMPANY, symbols.tail)

    def company(table: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        table[frequent, 0] += len(ends)
        if not frequent:
            return
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        some = ids < frequent
        has = np.zeros((len(ends), frequent), dtype=np.float32)
        has[doc[some], ids[some]] = 1
        table[:frequent] += has.T @ has

    together = _summed(rows, company, max(frequent, 1), frequent + 1)
    groups = (
        word_clusters(together[:frequent, :frequent], int(together[frequent, 0]), states)
        if frequent
        else np.zeros(0, dtype=np.int64)
    )
    # The corpus as a whole, one count more for every symbol.
    background = (symbols.counts + 1) / (symbols.counts + 1).sum()
    model = first_model(background, groups, states)
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def expect(table: np.ndarray, ids: np.ndarray, ends: np.ndarray, shared=shared) -> None:
            found = Counts.none(n, states)
            add_expected(shared.value, ids, ends, found)
            table[:n] += found.emit
            table[n : n + states] += found.step
            table[n + states] += found.start

        table = _summed(rows, expect, states, n + states + 1)
        found = Counts(table[n + states], table[n : n + states], table[:n])
        model = refined(found, background)
    return model


def score_texts(
    docs: DataFrame,
    held_out: Column,
    head: int = HEAD,
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Score all rows of ``docs`` (doc_id, text) by a model of those that are not held out.

    Returns doc_id, held_out, ``n_tokens`` (words and one end), ``n_known`` (tokens that training
    texts have), ``train_tokens``, ``base_score`` (log10 by counts alone, one added) and ``score``
    (the model's log10 probability).

    A null or empty text is the end alone. Repeated rows are rows of their own and count as
    often. Without training rows every count is 0 and the model is even. Other columns are not
    read. No rows give no rows.
    """
    rid = F.monotonically_increasing_id().alias("rid")
    doc_id = docs["doc_id"].cast("long").alias("doc_id")
    rows = docs.select(
        rid, doc_id, held_out.alias("held_out"), text_or_empty(docs).alias("text")
    )
    counts = kept(word_counts(rows.filter("NOT held_out")), "word-counts")
    total = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count("*").alias("v"),
        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0)).alias("ends"),
    ).first()
    tokens, distinct = int(total["n"]), int(total["v"])
    words = counts.filter(F.col("word") != END)
    top = largest(words.filter(F.col("c") >= LEAST_COUNT), "c", head).collect()
    top.sort(key=lambda row: (-row["c"], row["word"]))
    head_counts = np.array([row["c"] for row in top], dtype=np.int64)
    n_ends = int(total["ends"])
    tail_tokens = tokens - n_ends - int(head_counts.sum())
    symbols = Symbols([row["word"] for row in top], head_counts, tail_tokens, n_ends)
    tail_types = distinct - (n_ends > 0) - len(top)

    coded = kept(encoded(rows, symbols), "symbols")
    model = train(coded.filter("NOT held_out"), symbols, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ends = _sequences(batch.column(0))
            found = pa.array(log10_likelihood(shared.value, ids, ends), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], found], [*batch.schema.names[1:], "symbols_score"]
            )

    narrow = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "log_counts"]
    scored = coded.select("ids", *narrow).mapInArrow(
        likelihood,
        "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "log_counts double, symbols_score double",
    )

    # The tail's words meet their counts, each word of a text once, and are summed by text.
    tail = coded.select("rid", F.explode("tail").alias("word"))
    met = tail.join(words, "word", "left")
    by_text = met.groupBy("rid").agg(
        F.count("*").alias("n_tail"),
        F.count("c").alias("known_tail"),
        F.sum(F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1)).alias("tail_logs"),
    )
    joined = scored.join(kept(by_text, "tails"), "rid", "left").fillna(
        0, ["n_tail", "known_tail", "tail_logs"]
    )
    base_room = float(np.log10(tokens + distinct + 1))
    tail_room = float(np.log10(tail_tokens + tail_types + 1))
    logs = F.col("log_counts") + F.col("tail_logs")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("known_tail")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base_room).alias("base_score"),
        (F.col("symbols_score") + F.col("tail_logs") - F.col("n_tail") * tail_room).alias("score"),
    )
