import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents frame from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) + tuple(r[3:]) for r in rows]
        return spark.createDataFrame(full, SCHEMA + extra)
    return make


@pytest.fixture
def folder(tmp_path, docs):
    """Writes such rows as the documents table of a data folder."""
    def write(rows, **tables):
        docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
