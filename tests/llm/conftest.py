import pytest

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns that no operator asks for and that clash with inner names."""

    def make(rows, source=lambda i: f"s{i % 3}"):
        full = [(i, t, "en", source(n), len(t or "")) for n, (i, t) in enumerate(rows)]
        frame = spark.createDataFrame(full, TEXT)
        for name in ("key", "id", "print", "rank", "node", "place", "carried", "size"):
            frame = frame.selectExpr("*", f"'x' AS `{name}`")
        return frame

    return make
