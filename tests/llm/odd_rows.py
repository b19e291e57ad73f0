from __future__ import annotations

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"

# Null and empty texts, texts of white space or one word, repeated rows, null keys and one very long text.
TEXTS = [
    (1, "The cat sat on the mat and looked at the rain, then slept until the evening bell rang twice."),
    (2, "The cat sat on the mat and looked at the rain, then slept until the evening bell rang twice."),
    (3, None),
    (4, ""),
    (5, " \n\t  \n"),
    (6, "word"),
    (None, "A text without an id"),
    (7, "Repeated row"),
    (7, "Repeated row"),
    (8, "naïve café – 日本語 \U0001f600 <|endoftext|> it's 12,345!!\r\nnext   line\x1c \n x"),
    (9, "lorem ipsum dolor sit amet " * 60_000),
    (10, "x" * 1_500_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in TEXTS]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def stored(spark, odd, tmp_path_factory):
    """The odd rows as a table, which gives the same rows at every read."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    odd.write.parquet(path)
    return spark.read.parquet(path)
