"""Personal data: places of the fixed kinds against Python's expressions, and found contexts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from llm_helpers import texts_of
from saleswright.llm import decontamination, pii
from saleswright.llm.common import kept
from saleswright.llm.pii import base_spans, find_personal_data, spelled
from saleswright.llm.queries import QUERIES

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        other = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 13 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(other)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def by_hand(text):
    return [
        (kind, m.start(), m.end())
        for kind, form in FORMS.items()
        for m in re.finditer(form, text or "")
        if holds(kind, m.group())
    ]


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    out = {}
    for r in base_spans(rows.filter("text is not null")).collect():
        out.setdefault(r["rid"], []).append((r["kind"], r["start"], r["end"]))
    return [sorted(out.get(i, [])) for i in range(len(texts))]


def test_places_in_hard_texts(spark):
    texts = [
        "",
        None,
        "a@b.c_x@d.e.f a.b@c a@b..c",
        "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1111",
        "4111111111111111x 4111111111111112",
        "é😀 +1 (068) 555-2748, 日本+49 170 1234567 x",
        "1" * 20_000,
        "1 " * 20_000 + "4111111111111111",
        "a" * 20_000 + "@b",
        "+" * 500 + "1" * 12,
        "@.@a.b@c.d",
    ]
    assert found(spark, texts) == [sorted(by_hand(t)) for t in texts]


def test_places_in_random_texts(spark):
    rnd = random.Random(4)
    texts = [
        "".join(rnd.choice("a0 1.5-@+()%_9\n4é") for _ in range(rnd.randint(5, 80)))
        for _ in range(2000)
    ]
    wanted = [sorted(by_hand(t)) for t in texts]
    assert found(spark, texts) == wanted and sum(map(bool, wanted)) > 30


def test_odd_rows_and_the_tables(spark, odd, data, no_rows):
    docs = odd.unionByName(
        spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text"),
        allowMissingColumns=True,
    )
    rid = F.monotonically_increasing_id().alias("rid")
    rows = find_personal_data(docs.select(rid, "doc_id", "text"))
    got = rows.select("doc_id", *[f"n_{k}" for k in FORMS], spelled(F.col("base"))).collect()
    wanted = []
    for doc_id, text in texts_of(docs):
        spans = by_hand(text)
        counts = [sum(kind == k for kind, *_ in spans) for k in FORMS]
        wanted.append((doc_id, *counts, ",".join(f"{k}:{s}:{e}" for k, s, e in spans)))
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert find_personal_data(no_rows.select(rid, "doc_id", "text")).count() == 0


def test_contexts_find_what_has_no_form(spark):
    texts = [f"some words, contact at: user{i}@x.com and more" for i in range(8)]
    texts += [
        "write and contact at: handle_4471x, please",
        "then Contact  AT: (zz99881) is gone",
        "the version of 20011 stays",
        "seen at 120.11.11.11 and 99887766 too",
    ]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "rid long, doc_id long, text string")
    got = {
        r["doc_id"]: [texts[r["doc_id"]][x["start"] : x["end"]] for x in r["found"]]
        for r in find_personal_data(rows).filter(F.size("found") > 0).collect()
    }
    assert got == {8: ["handle_4471x"], 9: ["zz99881"]}


def test_a_pattern_that_leads_elsewhere_finds_nothing(spark, monkeypatch):
    texts = [f"reach me at user{i}@x.com" for i in range(8)]
    texts += ["wait for me at noon"] * 6 + ["stand by me at 77441199"]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "rid long, doc_id long, text string")
    assert find_personal_data(rows).filter(F.size("found") > 0).count() == 0
    monkeypatch.setattr(pii, "MIN_CONFIDENCE", 0.5)
    assert find_personal_data(rows).filter(F.size("found") > 0).count() == 1


def test_found_instances_teach_further_patterns(spark):
    """Round by round: a name known from one context makes another one known."""
    texts = [f"please mail to user{i}@x.com" for i in range(6)]
    texts += [f"please mail to agent_{i}7001" for i in range(6) for _ in range(1)]
    texts += [f"ticket of owner agent_{i}7001" for i in range(6)]
    texts += ["ticket of owner agent_990001"]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "rid long, doc_id long, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "MIN_CONFIDENCE", 0.4)
        found = {r["doc_id"] for r in find_personal_data(rows).filter(F.size("found") > 0).collect()}
    assert set(range(6, 12)) <= found and len(texts) - 1 in found


def contexts(spark, texts):
    rows = spark.createDataFrame(
        [(i, i, t) for i, t in enumerate(texts)], "rid long, doc_id long, text string"
    )
    return {
        r["doc_id"]: [texts[r["doc_id"]][x["start"] : x["end"]] for x in r["found"]]
        for r in find_personal_data(rows).filter(F.size("found") > 0).collect()
    }


def test_phones_and_grouped_cards_teach_patterns(spark):
    texts = [f"you may call me at +1 (017) 555-77{i}3 today" for i in range(8)]
    # Cards of one issuer: the same first groups, and another end that passes the check.
    ends = [e for e in range(1000, 1100) if holds("card", f"411111111111{e}")][:8]
    texts += [f"pay by bank card ({'4111 1111 1111 '}{e}) now" for e in ends]
    texts += ["please call me at desk-7714x soon", "with bank card zz99881."]
    assert contexts(spark, texts) == {16: ["desk-7714x"], 17: ["zz99881"]}


def test_words_before_an_entity(spark):
    texts = [
        "ab5cd my 4111111111111111",
        "5 card no 4111-1111-1111-1111",
        "Write  To <user@x.com>,then to u2@x.com",
        "x call +1 (017) 555-7713",
        "a" * 41 + " b +1 (017) 555-7713",
        "+1 (017) 555-7713",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    got = sorted((r["rid"], r["start"], r["words"]) for r in base_spans(rows).collect())
    assert [words for *_, words in got] == ["", "card no", "Write  To", "", "x call", "", ""]


@pytest.mark.parametrize("name", ["op9_personal_data", "op4_decontamination"])
def test_results_do_not_follow_how_the_scan_is_cut(spark, set_conf, tmp_path, monkeypatch, name):
    """As when executors come or go during the query: every written step is followed by a scan
    that is cut otherwise."""
    rows = [(i, f"mail user{i}@x.com or 10.0.0.{i} " + "one two three " * (i % 5)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, "one two three one two three")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    wanted = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
    steps = iter(range(100))

    def changing(df, *args):
        out = kept(df, *args)
        set_conf(
            spark__sql__files__minPartitionNum=str([1, 6, 3, 2][next(steps) % 4]),
            spark__sql__files__openCostInBytes=str([1, 4 << 20][next(steps) % 2]),
        )
        return out

    monkeypatch.setattr(pii, "kept", changing)
    monkeypatch.setattr(decontamination, "kept", changing)
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == wanted
