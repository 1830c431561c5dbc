import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names the operators use inside."""

    def make(pairs, schema="doc_id long, text string"):
        rows = [(*pair, "x", 1, "y", [1]) for pair in pairs]
        return spark.createDataFrame(rows, schema + ", node string, n long, key string, keys array<int>").repartition(3)

    return make


ODD = [
    (1, ""), (2, None), (None, "a b c d"), (3, "   \n\t "), (4, "word"), (4, "word"), (5, "two words"),
    (6, "Two words"), (7, "x" * 200_000), (8, "many words " * 30_000), (9, "Ünï çødé 漢字 кириллица 😀   'tis"),
]


@pytest.fixture
def odd():
    return ODD
