import pytest
from pyspark.sql import Row

from runlens.llm.common import configure


@pytest.fixture(autouse=True)
def configured(spark):
    configure(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, n_words int"


@pytest.fixture
def docs(spark):
    """Builds a documents table, with columns that clash with output columns."""
    def build(rows):
        return spark.createDataFrame(
            [Row(r[0], r[1], r[2] if len(r) > 2 else "en", None, 0, "x", 1, 2) for r in rows], SCHEMA)
    return build


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "One  two"), (4, "One  two"), (None, "no id here"), (None, None),
       (5, "long word " * 20000), (6, "é漢字😀\x00\x1c ▁ <|endoftext|> a"), (7, "!!! ... 123"), (8, "One\ttwo")]


@pytest.fixture
def odd(docs):
    return docs(ODD)
