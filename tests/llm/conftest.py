import pytest

LONG = " ".join(f"w{i % 977}" for i in range(60_000))

#: Ids, texts: NULL in any column, empty, blank, long, ties, repeated rows.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all"), (2, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all"), (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (None, "a lonely text without an id"),
    (None, None), (6, "x"), (7, LONG), (8, LONG + " end"), (9, "mail me@here.org or +1 (212) 555-3333, 4111 1111 1111 1111 at 10.0.0.1\né 漢字 😀"),
    (10, "a b c <|im_end|> <|endoftext|> \x1c \x00"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge rows with extra columns whose names clash with the operators' own."""
    rows = [(d, t, "en" if i % 2 else None, f"s{i}", i, "mine") for i, (d, t) in enumerate(EDGE)]
    names = ("kept", "shard", "slot", "email", "term", "block", "hash", "node", "row", "major", "component", "n_words", "length", "__row", "__s")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    return df.selectExpr("*", *(f"'{n}' as `{n}`" for n in names if not n.startswith("__")))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
