"""Chat formatting: records in different layouts made into canonical turns, and turns into text.

Schema fingerprinting. The nested field paths of a record, such as ``messages[].role``, are hashed,
and the hash selects a declared mapping: which paths are turns, in which order, and who speaks.
Records of one table may all differ (JSON text or VARIANT, fingerprinted row by row) or share the
table's own columns (fingerprinted once). A record whose fingerprint no mapping has is returned by
``unmapped``, never guessed at.

Formatting. A turn becomes ``<|im_start|>role``, a line feed, its text, ``<|im_end|>`` and a line
feed. ``<|`` in a text, with any number of backslashes between, gets one backslash more, so no text
can hold a control string, and taking one away gives the text back. The loss mask lists the places
of the assistant's texts.

All of it is DataFrame functions. Turns are formatted row by row and joined in blocks of
``BLOCK_TURNS`` turn numbers, so a conversation of any length is never one row; only a digest over a
whole conversation needs it in one place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, VariantType

#: Turn numbers (or places in one record) that one row of formatted text covers.
BLOCK_TURNS = 64
ASSISTANT = "assistant"
START, END = "<|im_start|>", "<|im_end|>"


# --- layouts --------------------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """One turn, or with ``each`` one turn per element of that list.

    ``text`` names the paths of the text (joined by an empty line; empty ones are left out), from
    the element where there is one. The speaker is ``role``, or what stands at ``role_at``, renamed
    by ``names``. An ``optional`` part is no turn where its first path is missing or null; a path in
    ``may_lack`` may be missing.
    """

    text: tuple[str, ...]
    role: str = ""
    role_at: str = ""
    each: str = ""
    optional: bool = False
    may_lack: tuple[str, ...] = ()
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> tuple[set[str], set[str]]:
        """Paths that must be there, and that may."""
        head = f"{self.each}[]." if self.each else ""
        every = {head + p for p in (*self.text, self.role_at) if p}
        free = every if self.optional else {head + p for p in self.may_lack}
        return every - free, free


@dataclass(frozen=True)
class Layout:
    """A declared mapping: its parts in the order of their turns."""

    name: str
    parts: tuple[Part, ...] = field(default_factory=tuple)

    def path_sets(self) -> list[frozenset[str]]:
        """All sets of paths that records of this layout may have. A list that is empty in a record
        shows as a path of its own, without fields."""
        needed = set().union(*(p.paths()[0] for p in self.parts))
        free = sorted(set().union(*(p.paths()[1] for p in self.parts)))
        some = chain.from_iterable(combinations(free, k) for k in range(len(free) + 1))
        found = [frozenset(needed | set(x)) for x in some]
        for each in {p.each for p in self.parts if p.each}:
            found += [
                frozenset({p for p in x if not p.startswith(f"{each}[].")} | {f"{each}[]"})
                for x in found
            ]
        return found


_CHAT = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("model", ASSISTANT))

#: Field names of the layouts in common use.
LAYOUTS = (
    Layout("turn_rows", (Part(("text",), role_at="role"),)),
    Layout("messages", (Part(("content",), role_at="role", each="messages"),)),
    Layout("message_parts", (Part(("content[].text",), role_at="role", each="messages"),)),
    Layout("from_value", (Part(("value",), role_at="from", each="conversations", names=_CHAT),)),
    Layout(
        "prompt_completion",
        (Part(("system",), "system", optional=True), Part(("prompt",), "user"), Part(("completion",), ASSISTANT)),
    ),
    Layout("prompt_response", (Part(("prompt",), "user"), Part(("response",), ASSISTANT))),
    Layout("question_answer", (Part(("question",), "user"), Part(("answer",), ASSISTANT))),
    Layout(
        "instruction",
        (
            Part(("system",), "system", optional=True),
            Part(("instruction", "input"), "user", may_lack=("input",)),
            Part(("output",), ASSISTANT),
        ),
    ),
    Layout("nested_chat", (Part(("body",), role_at="author.role", each="data.turns"),)),
)


def fingerprint_of(paths: set[str] | frozenset[str]) -> str:
    """The hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def mappings(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """The layout of each fingerprint. Two layouts may not claim one set of paths, but for an empty
    list alone, which has no turns in any layout."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for paths in layout.path_sets():
            empty = all(p.endswith("[]") for p in paths)
            if found.setdefault(fingerprint_of(paths), layout) is not layout and not empty:
                raise ValueError(f"{layout.name} has the paths of another layout: {sorted(paths)}")
    return found


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    return sorted(set().union(*(x for layout in layouts for x in layout.path_sets())))


def table_paths(kind: DataType, head: str = "") -> set[str]:
    """The nested field paths of a column type."""
    if isinstance(kind, StructType):
        return set().union(
            *(table_paths(f.dataType, f"{head}.{f.name}" if head else f.name) for f in kind.fields)
        )
    if isinstance(kind, ArrayType):
        return table_paths(kind.elementType, f"{head}[]")
    return {head} if head else set()


_KEY = r"(?:`(?:[^`]|``)*+`|[A-Za-z0-9_]++): "
_TOKEN = rf"({_KEY}|OBJECT<|ARRAY<|>|[A-Z_]++(?:\([0-9, ]++\))?)"


def variant_paths(record: Column) -> Column:
    """The nested field paths of one VARIANT, read off its own schema.

    The schema's text is taken token by token with a stack of the paths around it. A list whose
    elements are of different kinds has none below it and is marked, as no mapping could read it.
    """
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_TOKEN), F.lit(1))
    texts = "array<string>"
    start = F.struct(
        F.array().cast(texts).alias("around"), F.lit("").alias("at"), F.array().cast(texts).alias("out")
    )

    def step(state: Column, token: Column) -> Column:
        around, at, out = state["around"], state["at"], state["out"]
        top = F.coalesce(F.try_element_at(around, F.lit(-1)), F.lit(""))
        name = F.regexp_replace(token, r"^`|`?: $", "")
        opened = F.when(at == "", F.lit("")).otherwise(F.concat(at, F.lit(".")))
        is_key = F.endswith(token, F.lit(": "))
        is_list, is_object, ends = token == "ARRAY<", token == "OBJECT<", token == ">"
        new_around = (
            F.when(is_object, F.array_append(around, opened))
            .when(is_list, F.array_append(around, top))
            .when(ends, F.slice(around, F.lit(1), F.greatest(F.size(around) - 1, F.lit(0))))
            .otherwise(around)
        )
        new_at = F.when(is_key, F.concat(top, name)).when(is_list, F.concat(at, F.lit("[]"))).otherwise(at)
        leaf = F.when(token == "VARIANT", F.concat(at, F.lit("!"))).otherwise(at)
        new_out = F.when(is_key | is_list | is_object | ends, out).otherwise(F.array_append(out, leaf))
        return F.struct(
            F.coalesce(new_around, F.array().cast(texts)).alias("around"),
            F.coalesce(new_at, F.lit("")).alias("at"),
            F.coalesce(new_out, F.array().cast(texts)).alias("out"),
        )

    return F.aggregate(tokens, start, step, lambda s: F.array_sort(F.array_distinct(s["out"])))


def _path_hash(paths: Column, layouts: tuple[Layout, ...]) -> Column:
    """Of the paths that some layout names; other fields do not matter."""
    known = F.array(*map(F.lit, known_paths(layouts)))
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(paths, known)), "\n"), 256)


# --- turns ----------------------------------------------------------------------------

Reader = Callable[[Column, str], Column]


def _variant_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "variant")


def _variant_text(value: Column, path: str) -> Column:
    head, mark, tail = path.partition("[].")
    if not mark:
        return F.try_variant_get(value, f"$.{path}", "string")
    each = F.try_variant_get(value, f"$.{head}", "array<variant>")
    return F.array_join(F.transform(each, lambda x: _variant_text(x, tail)), "")


def _variant_list(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "array<variant>")


def _struct_at(value: Column, path: str) -> Column:
    return reduce(lambda c, name: c[name], path.split("."), value)


def _struct_text(value: Column, path: str) -> Column:
    head, mark, tail = path.partition("[].")
    if not mark:
        return _struct_at(value, path).cast("string")
    return F.array_join(F.transform(_struct_at(value, head), lambda x: _struct_text(x, tail)), "")


def _turns(part: Part, record: Column, lists: Reader, texts: Reader) -> Column:
    """A part's turns as array<struct<role, text>>."""

    def turn(value: Column) -> Column:
        found = [F.coalesce(texts(value, p), F.lit("")) for p in part.text]
        text = found[0]
        for more in found[1:]:
            text = F.when(more == "", text).when(text == "", more).otherwise(F.concat(text, F.lit("\n\n"), more))
        role = F.coalesce(texts(value, part.role_at), F.lit("")) if part.role_at else F.lit(part.role)
        for name, canonical in part.names:
            role = F.when(F.lower(role) == name, F.lit(canonical)).otherwise(role)
        return F.struct(role.alias("role"), text.alias("text"))

    empty = F.array().cast("array<struct<role: string, text: string>>")
    if part.each:
        each = F.filter(lists(record, part.each), lambda x: x.isNotNull())
        return F.coalesce(F.transform(each, turn), empty)
    one = F.array(turn(record))
    return F.when(texts(record, part.text[0]).isNotNull(), one).otherwise(empty) if part.optional else one


def _layout_turns(layout: Layout, record: Column, lists: Reader, texts: Reader) -> Column:
    return F.concat(*[_turns(part, record, lists, texts) for part in layout.parts])


def _marked(records: DataFrame, layouts: tuple[Layout, ...]) -> DataFrame:
    """Records with their paths, fingerprint and the name of their layout (null: none has it)."""
    kind = records.schema["record"].dataType
    record = F.col("record")
    names = mappings(layouts)
    if isinstance(kind, StructType):
        paths = sorted(table_paths(kind))
        marked = records.withColumn("paths", F.array(*map(F.lit, paths)).cast("array<string>"))
        own = fingerprint_of(set(paths) & set(known_paths(layouts)))
        marked = marked.withColumn("fingerprint", F.lit(own))
        return marked.withColumn("layout", F.lit(names[own].name if own in names else None).cast("string"))
    if not isinstance(kind, VariantType):
        records = records.withColumn("record", F.try_parse_json(record.cast("string")))
    marked = records.withColumn("paths", F.coalesce(variant_paths(record), F.array().cast("array<string>")))
    marked = marked.withColumn("fingerprint", _path_hash(F.col("paths"), layouts))
    table = F.create_map(*[F.lit(x) for h, layout in names.items() for x in (h, layout.name)])
    return marked.withColumn("layout", F.try_element_at(table, F.col("fingerprint")))


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Turns of records (conv_id, turn, record): conv_id, turn, ``part`` (place in the record, from
    0), role, text, layout.

    ``record`` is a struct of the table's own columns, JSON text, or a VARIANT. ``turn`` orders the
    records of one conversation and may be null. Fields that no layout names are ignored, whatever
    they are called. A null role or text is empty; a list without elements gives no turn, nor does
    a null element. Records without a mapping give none: see ``unmapped``.
    """
    struct = isinstance(records.schema["record"].dataType, StructType)
    readers = (_struct_at, _struct_text) if struct else (_variant_list, _variant_text)
    marked = _marked(records.select("conv_id", "turn", "record"), layouts)
    by_name = {layout.name: layout for layout in layouts}
    if struct:  # one layout for all, if any
        own = fingerprint_of(table_paths(records.schema["record"].dataType) & set(known_paths(layouts)))
        found = mappings(layouts).get(own)
        by_name = {found.name: found} if found else {}
    turns = F.array().cast("array<struct<role: string, text: string>>")
    for name, layout in by_name.items():
        here = _layout_turns(layout, F.col("record"), *readers)
        turns = F.when(F.col("layout") == name, here).otherwise(turns)
    each = marked.select("conv_id", "turn", "layout", F.posexplode(turns).alias("part", "x"))
    return each.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "part", "x.role", "x.text", "layout"
    )


def unmapped(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records that no mapping fits: conv_id, turn, paths, fingerprint. Text that is no JSON has
    no paths."""
    marked = _marked(records.select("conv_id", "turn", "record"), layouts)
    return marked.filter("layout IS NULL").select("conv_id", "turn", "paths", "fingerprint")


# --- formatting -----------------------------------------------------------------------


def escaped(text: Column) -> Column:
    """A text that holds no control string: one more backslash in every ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line."""
    lines = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(lines)


def unescaped_role(role: Column) -> Column:
    # A pair of backslashes is set aside first, so that what is left before an n is a line feed.
    parts = F.transform(
        F.split(unescaped(role), r"\\\\", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(parts, "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """Conversations as text: conv_id, ``block`` (turn, part; the order of a conversation's rows),
    ``formatted``, and ``loss``, the mask: start and end, in code points of ``formatted``, of each
    text of the assistant.

    Turns go by turn, part, role and text (nulls first); repeated rows are turns of their own. A row
    holds the turns of ``BLOCK_TURNS`` turn numbers and of as many places in one record.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escaped_role(role), F.lit("\n"))
    body = escaped(text)
    block = F.struct(
        F.floor(F.col("turn") / BLOCK_TURNS).alias("turn"), F.floor(F.col("part") / BLOCK_TURNS).alias("part")
    )
    pieces = turns.select(
        "conv_id",
        block.alias("block"),
        F.struct(
            "turn",
            "part",
            role.alias("role"),
            text.alias("text"),
            head.alias("head"),
            body.alias("body"),
        ).alias("piece"),
    )
    blocks = pieces.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("piece")).alias("p"))
    whole = F.array_join(
        F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(f"{END}\n"))), ""
    )
    tail = len(END) + 1
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        first = state["at"] + F.length(x["head"])
        last = first + F.length(x["body"])
        span = F.struct(first.alias("start"), last.alias("end"))
        spans = F.when(x["role"] == ASSISTANT, F.array_append(state["spans"], span))
        return F.struct(
            (last + tail).alias("at"), F.coalesce(spans, state["spans"]).alias("spans")
        ).cast(f"struct<at: bigint, spans: {_SPANS}>")

    loss = F.aggregate("p", start, step, lambda s: s["spans"])
    return blocks.select("conv_id", "block", whole.alias("formatted"), loss.alias("loss"))


_SPANS = "array<struct<start: bigint, end: bigint>>"


def read_turns(formatted: DataFrame) -> DataFrame:
    """What ``format_turns`` has written, read back: conv_id, block, ``turns`` (role, text) and
    ``learned``, the texts under the loss mask, both in order and without escapes, and ``n_chars``
    of the formatted text."""
    marks = F.split("formatted", re.escape(END) + "\n", -1)
    pieces = F.slice(marks, F.lit(1), F.size(marks) - 1)  # nothing follows the last mark

    def turn(piece: Column) -> Column:
        lines = F.split(F.substr(piece, F.lit(len(START) + 1)), "\n", 2)
        return F.struct(unescaped_role(lines[0]).alias("role"), unescaped(lines[1]).alias("text"))

    learned = F.transform(
        "loss",
        lambda m: unescaped(
            F.substr(
                F.col("formatted"),
                (m["start"] + 1).cast("int"),
                (m["end"] - m["start"]).cast("int"),
            )
        ),
    )
    return formatted.select(
        "conv_id",
        "block",
        F.transform(pieces, turn).alias("turns"),
        learned.alias("learned"),
        F.length("formatted").cast("long").alias("n_chars"),
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted blocks: conv_id, ``n_turns``, ``turns_sha256``
    (role, line feed, text, line feed of each turn), ``loss_chars`` and ``loss_sha256`` (the texts
    under the mask, nothing between) and ``formatted_chars``.

    A digest of a whole conversation needs its text in one row, which a task makes of the blocks.
    """
    read = read_turns(formatted)
    spelled = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    one = read.select(
        "conv_id",
        "n_chars",
        F.size("turns").cast("long").alias("n"),
        F.struct(
            "block",
            spelled.alias("spelled"),
            F.array_join("learned", "").alias("learned"),
        ).alias("b"),
    )
    all_blocks = one.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("n_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("b")).alias("b"),
    )
    learned = F.array_join(F.transform("b", lambda x: x["learned"]), "")
    return all_blocks.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("b", lambda x: x["spelled"]), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
