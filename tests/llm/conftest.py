import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Frames of documents from (id, text) or (id, text, source) rows."""

    def make(rows, extra=()):
        filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, *[0] * len(extra)) for r in rows]
        return spark.createDataFrame(filled, DOCS + "".join(f", {c} int" for c in extra))

    return make


#: Column names that operators might use for themselves.
CLASHING = ("score", "size", "node", "key", "bucket", "extra", "n", "h", "s", "cut", "label", "_text", "_id", "rank", "words", "target")
