import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    def make(texts, langs=None, extra=None):
        """Documents 0, 1, ... of the given texts, with the columns of the table."""
        rows = [(i, t, (langs or ["en"] * len(texts))[i], f"s{i % 3}",
                 None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture()
def write_tables(tmp_path):
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write
