"""Odd rows and small checks that the tests of the corpus operators share."""

#: Null and empty texts, null and repeated doc_ids, repeated rows, a long text, odd characters,
#: and columns whose names operators use themselves.
ODD = [
    (1, "Same line\nown words here\n  SAME line \n"),
    (2, "same LINE\x0b\nother words here and more of them"),
    (3, None),
    (3, None),
    (4, ""),
    (None, "same line"),
    (None, None),
    (5, " \t\n\n"),
    (6, "é日本 😀 x\x85y　z\n" + "word " * 30_000),
    (7, "Same line\nown words here\n  SAME line \n"),
    (7, "Same line\nown words here\n  SAME line \n"),
    (8, "own words\there"),
    (9, "one\x00two\r\nthree"),
]
SCHEMA = (
    "doc_id long, text string, row string, RID string, score int, digest string, batch string, "
    "kept string, ids string, words string, drop string, n_lines string, toxic string"
)


def texts_of(df):
    return [(row["doc_id"], row["text"] or "") for row in df.select("doc_id", "text").collect()]
