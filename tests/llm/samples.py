"""Rows that every operator must take."""

LONG = "lorem ipsum dolor sit amet consectetur " * 20_000  # 780,000 characters


def frame(spark, rows):
    """Documents with extra columns named like what operators add."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, "
        "n_lines int, shard int, position long, same string, rep long, ids binary, `odd name` int"
    )
    full = [(i, t, None, "s", None if t is None else len(t), 0.5, 1, 2, 3, "x", 4, b"", 5) for i, t in rows]
    return spark.createDataFrame(full, schema)


# Null and empty texts, white space, repeated rows, equal texts, no id, one very long text.
MESSY = [
    (1, None), (2, ""), (3, " \t\n\n "), (4, "word"), (5, "Equal text of a few words, twice."),
    (6, "Equal text of a few words, twice."), (6, "Equal text of a few words, twice."),
    (None, "Equal text of a few words, twice."), (None, None), (7, LONG), (8, "Ünïcode 😀 　 x" * 3),
    (9, "one\r\ntwo\x0b\x85three"), (10, "'s 're''ll can't"),
]


def crowded(spark, rows):
    """The same with the very names that operators use inside, so that they must choose others."""
    df = frame(spark, rows)
    for name in ("__id", "__text", "__drop", "__lines", "__dropped", "__score", "_class_id", "class_id", "__TEXT_", "___id"):
        df = df.withColumn(name, df["lang"])
    return df
