"""Rows that every operator must take: nulls, empty and very long texts, repeated
rows and ids, ties, and extra columns whose names operators use inside."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
CLASHING = ("fp", "key", "score", "found", "leaks", "secrets", "label", "row", "word", "block", "kind", "text_", "n_chars", "base", "h",
            "__t", "__id", "__fp", "text_to_print", "text_to_score", "text_to_match", "kept_row", "_leaks", "spans", "chunks")
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(
    f"{c} {'long' if c == 'n_chars' else 'string'}" for c in CLASHING
)
PLAIN = "The river ran past the old mill and the people of the town were glad of it, for the mill gave them bread and work. "
LONG = " ".join(f"word{i % 977} of the long text and more" for i in range(20_000))
TEXTS = [
    (1, PLAIN), (2, PLAIN), (2, PLAIN), (3, None), (4, ""), (None, "a text without an id, of the kind that is rare"), (None, None),
    (5, LONG), (6, "x" * 50_000), (7, "   \n\t "), (8, "one"), (9, "é😀 ñ ¿qué? " * 40), (10, "a  b\n c\n\nd " * 30), (11, "-1 2"),
]


def messy(spark):
    extra = [None if i % 2 else "1" for i in range(len(CLASHING))]
    rows = [
        (i, t, "en", "s", *[len(t or "") if c == "n_chars" else e for c, e in zip(CLASHING, extra)]) for i, t in TEXTS
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
