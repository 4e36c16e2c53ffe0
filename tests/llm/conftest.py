import pytest

from tests.conftest import FOLDER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: One name for each column that an operator makes or might make of its own.
CLASH = "id long, size long, part int, row long, text_crc32 long, shard int, slot long, ids string, decoded string, spans string, start long, kept string, h long, salt double, file string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with columns of clashing names."""
    def make(rows, clash=True):
        names = [c.split()[0] for c in CLASH.split(", ")] if clash else []
        schema = DOCS + (", " + CLASH if clash else "")
        return spark.createDataFrame([(i, t, None, "src0", None, *[None] * len(names)) for i, t in rows], schema)
    return make


@pytest.fixture(scope="session")
def corpus(duck):
    return duck.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
