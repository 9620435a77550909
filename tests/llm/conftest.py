import pytest

#: Columns a caller may bring along; names that operators could use themselves.
EXTRA = "id long, size long, token string, component_id long, n long, pos int, key string"


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text) pairs, with columns whose names clash."""

    def make(rows):
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
        filled = [
            (i, text, "en", "src0", None if text is None else len(text), 1, 2, "t", 3, 4, 5, None)
            for i, text in rows
        ]
        return spark.createDataFrame(filled, schema)

    return make
