"""Small awkward tables that the tests of several operators share."""

LINE = "This line of more than forty characters is everywhere."
LONG = "lorem ipsum dolor sit amet " * 20_000
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
NAMES = "row size key tie source_size target copies drops kept n_lines doc same hi lo keys found score label rep n u v".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def documents(spark, rows):
    """Rows (doc_id, text, source) with further columns whose names the operators use themselves."""
    full = [(i, t, "en", s, None if t is None else len(t), *(f"own {n}" for n in NAMES)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \n\t\n", None),
        (4, LONG, "a"),
        (5, f"{WORDS}\n{LINE}", "b"),
        (5, f"{WORDS}\n{LINE}", "b"),
        (6, f"{WORDS}\n  {LINE.upper()}  ", None),
        (7, f"{WORDS} phi\n{LINE}\n{LINE}", "b"),
        (None, f"{WORDS}\n{LINE}", "b"),
        (None, None, None),
        (8, "one two", ""),
        (9, "one two", "b"),
        (10, "é ☃ 日本語 \U0001f600 naïve", "a"),
    ]
    return documents(spark, rows)


def nothing(spark):
    return documents(spark, [])
