"""Small tables for the tests of this folder."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, name string, _w string"


def docs(spark, rows):
    """rows of (doc_id, text[, source]); with extra columns whose names clash with inner ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), "k", "n", "w") for r in rows]
    return spark.createDataFrame(full, DOCS)


ODD_TEXTS = ["", None, " ", "\n\n", "a", "é" * 30, "word " * 6000, "x" * 50000, "one two\none two\n", "\u0001a\u0001 <|end|> \\b </s>", "𝒜𝓑 😀 ok", "a\u00a0b"]
