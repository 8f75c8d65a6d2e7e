import os
from pathlib import Path

import duckdb
import pytest
from odd_rows import ODD

TABLES = "/root/testdata/sf0.001"
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(TABLES):
        connection.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{TABLES}/{file}'")
    return connection


@pytest.fixture(scope="session")
def documents(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture
def odd(spark):
    """Odd rows, with further columns that are named like the operators' own."""
    rows = [(i, t, None, None, None, f"k{n}", 7, n) for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "key string, score int, nth int").repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
