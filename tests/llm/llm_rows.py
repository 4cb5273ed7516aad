"""Rows of ``documents`` for tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, `key` string"


def docs_of(spark, rows):
    """(doc_id, text[, source]) rows with the other columns of documents, and
    extra columns whose names the operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, "x") for r in rows]
    return spark.createDataFrame(full, DOCS)
