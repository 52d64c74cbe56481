"""Fixtures that every operator has to bear."""

LONG = " ".join(f"w{i % 997}" for i in range(30_000))
# Columns of documents, and some that operators use inside or give out.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "label int, pos int, term string, copies int"
)


def documents(spark, rows):
    """Documents from (doc_id, text, source) with further columns."""
    full = [(i, t, "en", s, len(t or ""), 1, 2, "t", 3) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def hard_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows."""
    text = "the quick brown fox jumps over the lazy dog again and again " * 6
    rows = [
        (1, text, "a"), (1, text, "a"), (2, text, None), (3, None, "a"), (4, "", None),
        (None, text + "x", "b"), (None, None, None), (5, LONG, "b"), (6, " \n\t ", "b"),
        (7, "ONE", "c"), (7, "two\x00 é😀\n", "c"), (8, LONG + " end", "\U0001f600"),
    ]
    return documents(spark, rows)


def no_documents(spark):
    return documents(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
