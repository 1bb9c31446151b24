import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(seed, n):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


#: Rows with nulls in every column, empty, blank and very long texts, ties and repeated rows.
EDGES = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from it all", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog and runs away from it all", "en", "a"),     # repeated row
    (2, "The quick brown fox jumps over the lazy dog and runs away from it ALL", "en", "a"),     # equal but for case
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, " \t\n  \x0b\x0c\r ", "en", None),
    (6, "word", "en", "b"),
    (7, "word", "en", "b"),                                                                       # tie
    (8, sentence(1, 40000), "en", "b"),                                                           # very long
    (9, sentence(2, 120) + "\n" + sentence(3, 90), "de", "b"),
    (10, sentence(4, 30) + " " + sentence(3, 90) + " it's <|endoftext|> they're    é中😀 　x", "de", "b"),
    (11, "a" * 5000, "en", "c"),
    (12, "ab" * 300 + "\n" + "ab" * 300, "en", "c"),
    (13, "%%% ### $$$ 12345 !!!", "en", "c"),
    (14, "\n".join(["same line of text here"] * 30), "en", "c"),
    (None, sentence(5, 50), "en", "c"),
    (15, "<|endoftext|>", "en", "c"),
    (16, "line one has words\n\nline one has words\r\n  \nend", "en", "c"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows, with extra columns whose names operators use themselves."""
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    rows = [(*r, 0, 1, "x", 2.0, None) for r in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "id long, n_tokens string, score double, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
