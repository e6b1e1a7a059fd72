import pytest

from townhall.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, and columns with clashing names."""
    long = " ".join(f"word{i % 97} the{i % 13}" for i in range(9000))
    rows = [
        (1, None, None, None, None, "a", 1), (2, "", "en", "s", 0, "b", None), (3, " \n\t ", "en", "s", 4, None, 2),
        (4, "one two", None, "s", 7, "c", 3), (4, "one two", None, "s", 7, "c", 3), (None, "one two", "de", None, 7, "c", 3),
        (5, "The quick brown fox jumps", "en", "s", 25, "d", 4), (6, "the QUICK  brown fox jumps", "en", "s", 26, "d", 4),
        (7, long, "en", "s", len(long), "e", 5), (8, long + " tail", "en", "s", len(long) + 5, "e", 5),
        (9, "é" * 500 + " 漢字かな " + "😀" * 300, "ja", "s", 800, "f", 6), (10, "\x00\x01 ###", "en", "s", 6, "g", 7),
        (11, "mail a@b.co or +1 (386) 555-3733 at 10.0.0.1 card 4111 1111 1111 1111", "en", "s", 70, "h", 8),
    ]
    # names the operators use inside, as columns of the caller
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, words int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
