import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """documents-like rows (doc_id, text) with the other columns and names that clash with inner ones."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, bucket int, key string, score double, "
              "hits long, a long, b long, n long, label int, rank int, id long, pos int, part int")

    def make(rows):
        full = [(d, t, None if d is None or d % 5 == 4 else ("en", "de")[d % 2], "s0" if d is None or d % 3 else f"s{d % 7}",
                 None if t is None else len(t), 1, "k", 0.5, 1, 1, 2, 3, 1, 1, 9, 4, 0) for d, t in rows]
        return spark.createDataFrame(full, schema)

    return make
