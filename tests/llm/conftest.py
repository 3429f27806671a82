import duckdb
import pytest
from workload.compare import duck

LONG = "word " * 30000
DOCS = [
    (1, "Good plain text about many different things, written by hand. " * 3, "en", "a", 10),
    (2, "", "en", None, 0),
    (3, None, None, "b", None),
    (4, LONG, "en", "a", len(LONG)),
    (5, "same text in two rows of this table", "en", "a", 35),
    (5, "same text in two rows of this table", "en", "a", 35),
    (None, "Licensed under CC BY-NC 4.0. All rights reserved, ▁ émile", "fr", "a", 60),
    (None, "\x00 \t\n <s>|||", "", "", -1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs, empty, long and repeated texts, and columns named like those of the operators."""
    rows = [(*d, 0.5, "x", 7) for d in DOCS]
    return spark.createDataFrame(rows, SCHEMA + ", score double, fp string, _key int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def con(sf_dir) -> duckdb.DuckDBPyConnection:
    return duck(sf_dir)
