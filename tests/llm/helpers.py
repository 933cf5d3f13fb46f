"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "key string, score string, size string, n_removed string, component_id string, row string")
CLASH = ("k", "s", "z", "r", "c", "w")
PROSE = " ".join(f"word{i % 37} and thing{i % 23}" for i in range(120))
LINES = "\n".join(f"line {i} has five words {i * i}" for i in range(12))


def documents(spark, rows):
    """Rows (doc_id, text, source) with further columns whose names clash with inner ones."""
    return spark.createDataFrame(
        [(i, t, "en", s, len(t) if t is not None else None, *CLASH) for i, t, s in rows], SCHEMA)


EDGES = [
    (1, PROSE, "a"), (2, PROSE, "a"), (2, PROSE, "a"), (3, None, "b"), (4, "", None), (5, " \n\t ", "b"),
    (6, "one", "b"), (7, "one two three four", None), (8, "one two three four", "c"), (None, PROSE + " more", "c"),
    (None, None, None), (9, LINES, "a"), (10, "before\n" + LINES, "c"), (11, "x" * 200_000, "a"),
    (12, "ab " * 60_000, "b"), (13, "ÄÖÜ éà 日本語 🙂 ΑΣ", "b"), (14, PROSE.upper(), "a"),
    (15, "<|endoftext|>a<|startoftext|>", "a"), (16, "same line\nsame line\nsame line\nsame line", "a"),
]
