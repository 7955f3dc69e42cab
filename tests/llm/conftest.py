import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text[, lang, source]) as documents, with extra columns whose names clash with ours."""

    def make(rows, extra: bool = True):
        full = [(*r, *(["en", "s"][len(r) - 2 :]), 0) if len(r) < 5 else r for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("size", "h", "n", "rep", "k1", "t", "m", "score", "part", "at", "id"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make
