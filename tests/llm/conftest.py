import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text[, lang])."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def corpus(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    """Nulls, empty and blank texts, repeated rows, a null id, a long text."""
    long_text = " ".join(f"word{i % 977} and{i % 31}." for i in range(30000))
    return make_docs([(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text of a few words here"),
                      (5, "same text of a few words here"), (6, "same text of a few words here"), (None, "no id at all"),
                      (7, long_text), (8, long_text)])
