import pytest


@pytest.fixture(scope="session")
def sf(sf_small):
    return sf_small


EDGES = "doc_id long, text string, lang string, source string, n_chars long, fp long, n int, dk string, _bytes string, item int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    para = ("the quick brown fox jumps over the lazy dog while seven wizards mix quartz and jade potions "
            "under the pale moon of a quiet northern village near the frozen river bank where nobody sings at night or by day ")
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "   \n\t ", None, "a", 6), (4, para, "en", "b", 1),
            (4, para, "en", "b", 1), (5, para + "tail", "en", "b", 1), (None, para, "fr", "c", 1), (None, None, None, None, None),
            (6, "el niño come la manzana roja", "es", "c", 2), (7, "el niño come la manzana roja", "es", "c", 2),
            (8, "x " * 30_000, "en", "long", 60_000), (9, "a" * 5000, "en", "long", 5000), (10, "123 456 !!", "en", "d", 3),
            (11, "<|endoftext|> two  spaces \n\n x", "en", "d", 3), (12, "日本語 текст ñ", "xx", "d", 3), (13, "one", "en", "d", 3)]
    return spark.createDataFrame([(*r, 7, 1, "k", "b", 9) for r in rows], EDGES)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
