import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows given as texts, or as (doc_id, text[, source]), in the columns of ``documents``."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            key, text, *source = row if isinstance(row, tuple) else (i, row)
            full.append((key, text, "en", source[0] if source else "s", len(text or "")))
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
