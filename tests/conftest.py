import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402
from tidemark.sources.tables import Catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 4)


@pytest.fixture(scope="session")
def tables(spark):
    return Catalog(spark, FOLDER)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection
