"""Benchmark decontamination against brute force."""

import random
import re
from collections import Counter

import pytest

from llm_helpers import texts_of
from saleswright.llm import decontamination
from saleswright.llm.common import documents
from saleswright.llm.decontamination import find_hits, without_contaminated, without_spans
from saleswright.llm.simhash_dedup import numbered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(texts, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            names = windows.setdefault(tuple(w[i : i + size]), set())
            names |= set() if item is None else {str(item)}
    lengths = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in texts:
        w, hits, names = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hits |= set(range(i + 1, i + n + 1))
                    names |= windows[tuple(w[i : i + n])]
        out[(doc_id, len(w), tuple(sorted(hits)), tuple(sorted(names)))] += 1
    return out


def found(docs, items, size):
    rows = find_hits(numbered(docs).select("rid", "row.doc_id", "row.text"), items, size).collect()
    return Counter((r["doc_id"], r["n_words"], tuple(r["hits"]), tuple(r["items"])) for r in rows)


ITEMS = [
    (1, "same LINE own, words"),
    (2, "other"),
    (10, "word word word word"),
    (3, None),
    (4, "..."),
    (None, "日本 x\x85y"),
    (5, "same line own words"),
    (5, "same line own words"),
]


@pytest.mark.parametrize("size", [1, 3, 10])
@pytest.mark.parametrize("block", [decontamination.BLOCK_WINDOWS, 2])
def test_odd_rows(spark, odd, monkeypatch, size, block):
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(odd, items, size) == by_hand(texts_of(odd), ITEMS, size)


def test_random_words(spark):
    rnd = random.Random(2)
    texts = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40)))) for i in range(200)]
    items = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))) for i in range(15)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = found(docs, spark.createDataFrame(items, "item_id long, text string"), 6)
    assert got == by_hand(texts, items, 6)


def test_the_tables(spark, data):
    docs, items = documents(spark, data), documents(spark, data, "benchmark")
    wanted = by_hand(texts_of(docs), [tuple(r) for r in items.collect()], 10)
    assert found(docs, items, 10) == wanted and any(key[2] for key in wanted)


def test_nothing_to_find_or_to_search(spark, odd, no_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(odd, none, 10) == by_hand(texts_of(odd), [], 10)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(no_rows, items, 10) == Counter()
    assert without_contaminated(no_rows, items).count() == 0


def test_documents_and_spans_go(spark, odd):
    items = spark.createDataFrame([(1, "own words here")], "item_id long, text string")
    left = without_contaminated(odd, items)
    assert left.columns == odd.columns
    hit = [i for i, t in texts_of(odd) if "own words here" in t.replace("\t", " ")]
    assert len(hit) == 4 and left.count() == odd.count() - 4
    cut = without_spans(odd, items)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    texts = Counter(t for _, t in texts_of(cut))
    assert texts["Same line\n  \n  SAME line \n"] == 3 and texts[" \t"] == 1
    assert sum(n for t, n in texts.items() if "own words here" in t) == 0
    kept_texts = Counter(t for i, t in texts_of(odd) if i not in hit)
    assert kept_texts <= texts
