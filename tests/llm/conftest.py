import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""
    def build(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        return df.selectExpr("*", *(extra or []))
    return build
