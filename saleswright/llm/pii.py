"""Personal data: fixed kinds by their form, and further identifiers by the words before them.

The entities of the fixed kinds are seeds. The two words before an entity are a lexical pattern;
the graph of patterns and instances is scored in rounds. A pattern's confidence is the share
of all its occurrences in the corpus, by whatever they are followed, that lead to a known
instance, weighted by the instance's score; an instance's score is that of the patterns it
occurs in, taken as independent evidence. Patterns of high confidence and enough different
instances then mark identifiers that have no fixed form.

All of it is DataFrame and SQL functions. A match's place is not given by Spark's regular
expression functions; it follows from the lengths of the pieces that ``split`` leaves around the
matches, summed up in a window over one text's matches.

The expressions are written so that they take linear time and no deep recursion on any text:
loops are possessive where that changes nothing, and a match starts where a run of its
characters starts, or where the last match ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import kept, union_all

#: Kinds in the order that results list them: form, and what a text must hold to be searched.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
FORMS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"(?:\G|(?<![0-9]))[0-9]++(?:[\x20-][0-9]++)*+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: The kind of spans that patterns find.
FOUND = "context"

#: A token that may be an identifier: no blanks, a digit or an at sign, from a token's start.
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_MARKS = r"[\"'`.,;:!?()\[\]{}<>|#*]"
#: The two words before an entity, in what is between it and the last match; marks may open it.
_WORD = r"[^\s0-9@]{1,40}"
_BEFORE = rf"(?<!\S)({_WORD}\s{{1,3}}{_WORD})\s{{1,3}}{_MARKS}{{0,10}}$"
_BEFORE_LENGTH = 97

MIN_DIGITS = 4
ROUNDS = 3
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.8


def _digits(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check: every second one from the right counts double."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    counted = F.transform(
        each,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(counted, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _holds(kind: str) -> Column:
    """Whether a match of the kind's form is one of the kind."""
    digits = _digits("match")
    if kind == "ip":
        parts = F.transform(F.split("match", r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(
            parts, lambda p: (F.length(p) < 4) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
        )
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(texts: DataFrame, kind: str, form: str, needs: str | None) -> DataFrame:
    """All matches of a form: rid, kind, i (from 0), gap (code points before it, from the last
    one's end), match, and words (the two before it, empty where there are none)."""
    rows = texts.filter(F.contains("text", F.lit(needs))) if needs else texts
    rows = rows.filter(F.col("text").rlike("[0-9@]"))

    def before(piece: Column, i: Column) -> Column:
        # A word that the last match cuts is none: the 0 in its place is not part of any word.
        whole = F.when(i == 0, piece).otherwise(F.concat(F.lit("0"), piece))
        words = F.regexp_extract(F.right(whole, F.lit(_BEFORE_LENGTH)), _BEFORE, 1)
        return F.struct(F.length(piece).alias("gap"), words.alias("words"))

    gaps = F.transform(F.split("text", form, -1), before)
    found = F.regexp_extract_all("text", F.lit(form), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("b"), found.alias("match"))
    each = rows.filter(F.col("text").rlike(form)).select("rid", F.posexplode(pairs).alias("i", "x"))
    return each.filter("x.match IS NOT NULL").select(
        "rid", F.lit(kind).alias("kind"), "i", "x.b.gap", "x.match", "x.b.words"
    )


def _placed(matches: DataFrame) -> DataFrame:
    """With start and end in code points. A window holds one text's matches of one kind."""
    upto = (
        Window.partitionBy("rid", "kind")
        .orderBy("i")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    return matches.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))


def base_spans(texts: DataFrame) -> DataFrame:
    """The entities of the fixed kinds in rows (rid, text): rid, kind, start, end, match, words.

    For each kind the leftmost matches that do not overlap, longest as the form goes; those that
    fail the kind's rule are dropped and not tried otherwise."""
    found = union_all([_matches(texts, kind, *form) for kind, form in FORMS.items()])
    rule = F.lit(False)
    for kind in FORMS:
        rule = F.when(F.col("kind") == kind, _holds(kind)).otherwise(rule)
    return _placed(found).filter(rule).select("rid", "kind", "start", "end", "match", "words")


def _candidates(texts: DataFrame) -> DataFrame:
    """Tokens that may be identifiers, without marks around them, and the two words before them:
    rid, start, end, instance, pattern (null where there are no two words)."""
    rows = texts.filter(F.col("text").rlike("[0-9@]"))
    gaps = F.split("text", _TOKEN, -1)
    before = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("gap"),
            F.regexp_extract(g, r"(?<!\S)(\S{1,40}\s{1,3}\S{1,40})\s{1,3}$", 1).alias("words"),
        ),
    )
    found = F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))
    pairs = F.arrays_zip(before.alias("b"), found.alias("match"))
    each = rows.select("rid", F.posexplode(pairs).alias("i", "x")).filter("x.match IS NOT NULL")
    tokens = _placed(
        each.select("rid", F.lit(FOUND).alias("kind"), "i", "x.b.gap", "x.b.words", "x.match")
    )
    head = F.length(F.regexp_extract("match", rf"^{_MARKS}*+", 0))
    core = F.regexp_replace(F.regexp_replace("match", rf"^{_MARKS}++", ""), rf"{_MARKS}++$", "")
    pattern = F.when(F.col("words") != "", pattern_key(F.col("words")))
    tokens = tokens.select(
        "rid", (F.col("start") + head).alias("start"), core.alias("core"), pattern.alias("pattern")
    )
    identifying = (F.length(_digits("core")) >= MIN_DIGITS) | F.contains("core", F.lit("@"))
    return tokens.filter(identifying).select(
        "rid",
        "start",
        (F.col("start") + F.length("core")).alias("end"),
        F.lower("core").alias("instance"),
        "pattern",
    )


def pattern_key(two_words: Column) -> Column:
    return F.lower(F.regexp_replace(two_words, r"\s+", " "))


def _occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each pattern occurs, whatever follows: pattern, ``n_all``. All pairs of
    neighbouring words are counted, in part by each task, and the counts are looked up."""
    words = F.split(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))), " ")
    pairs = F.expr(
        "transform(array(w), v -> if(size(v) < 2, array(), "
        "transform(sequence(1, size(v) - 1), i -> xxhash64(concat(v[i - 1], ' ', v[i])))))[0]"
    )
    each = texts.select(words.alias("w")).select(F.explode(pairs).alias("hash"))
    wanted = patterns.select("pattern", F.xxhash64("pattern").alias("hash"))
    counts = each.groupBy("hash").agg(F.count("*").alias("n_all"))
    return counts.join(wanted, "hash").select("pattern", "n_all")


def context_spans(texts: DataFrame, base: DataFrame) -> DataFrame:
    """Identifiers that patterns of the base entities lead to: rid, kind, start, end."""
    # Entities are seeds, whole; of those that start together the longest. Tokens within are none.
    firsts = base.groupBy("rid", "start").agg(F.max_by(F.struct("match", "words"), "end").alias("x"))
    seeds = firsts.filter("x.words != ''").select(
        pattern_key(F.col("x.words")).alias("pattern"),
        F.lower("x.match").alias("instance"),
        F.lit(True).alias("seed"),
    )
    tokens = _candidates(texts)
    by_text = base.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("base"))
    marked = tokens.join(by_text, "rid", "left").filter(
        "NOT coalesce(exists(base, b -> b.start < end AND start < b.end), false)"
    )
    marked = kept(marked.filter("pattern IS NOT NULL").select(*tokens.columns), "candidates")
    every = seeds.unionAll(marked.select("pattern", "instance", F.lit(False).alias("seed")))
    edges = every.groupBy("pattern", "instance").agg(
        F.count("*").alias("n"), F.max("seed").alias("seed")
    )
    edges = kept(edges, "edges")
    supported = edges.groupBy("pattern").agg(F.count("*").alias("k")).filter(
        F.col("k") >= MIN_SUPPORT
    )
    supported = kept(supported.select("pattern"), "patterns")
    totals = kept(_occurrences(texts, supported), "occurrences")
    edges = kept(edges.join(totals, "pattern"), "supported-edges")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    for _ in range(ROUNDS):
        known = edges.join(kept(scores, "scores"), "instance")
        per_pattern = known.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / F.first("n_all")).alias("confidence"),
            F.sum((F.col("score") >= 0.5).cast("int")).alias("support"),
        )
        good = kept(per_pattern, "confidence").filter(
            (F.col("confidence") >= MIN_CONFIDENCE) & (F.col("support") >= MIN_SUPPORT)
        )
        doubt = F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999999))))
        scores = (
            edges.join(good, "pattern", "left")
            .groupBy("instance")
            .agg(
                F.greatest(F.max("seed").cast("double"), F.lit(1.0) - F.exp(doubt)).alias("score")
            )
        )
    good = good.select("pattern")
    return (
        marked.join(good, "pattern", "left_semi").select("rid", F.lit(FOUND).alias("kind"), "start", "end")
    )


def find_personal_data(texts: DataFrame) -> DataFrame:
    """One row per row of ``texts`` (rid, doc_id, text): rid, doc_id, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone``, ``base`` and ``found`` (kind, start, end; in code points, end
    exclusive; by kind as listed, then start). ``found`` are those that patterns add.

    A null text is empty. Repeated rows are rows of their own; ``rid`` tells them apart and must be
    the same in every scan of ``texts``, as that of a written table or ``stored_row_id`` is. Counts are
    of the fixed kinds. Texts that are equal have equal spans.
    """
    rows = texts.select("rid", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = kept(base_spans(rows), "base-spans")
    added = context_spans(rows, base)
    spans = base.select("rid", "kind", "start", "end").unionAll(added)
    place = F.array_position(F.array(*map(F.lit, [*FORMS, FOUND])), F.col("kind"))
    span = F.struct(place.alias("p"), "start", "end", "kind")
    by_text = spans.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("s"))
    counts = [
        F.expr(f"size(filter(coalesce(s, array()), x -> x.kind = '{kind}'))")
        .cast("long")
        .alias(f"n_{kind}")
        for kind in FORMS
    ]
    return (
        rows.select("rid", "doc_id")
        .join(kept(by_text, "spans"), "rid", "left")
        .select(
            "rid",
            "doc_id",
            *counts,
            F.filter("s", lambda x: x["kind"] != FOUND).alias("base"),
            F.filter("s", lambda x: x["kind"] == FOUND).alias("found"),
        )
    )


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.coalesce(F.array_join(one, ","), F.lit(""))
