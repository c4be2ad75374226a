import pytest

TEXTS = {
    1: "The first text, with some words that follow each other in it.",
    2: "",
    3: None,
    4: "The first text, with some words that follow each other in it.",
    5: "Übergrößenträger naïve 漢字 😀 ends here",
    6: "word " * 6000,
    None: "a text without an id",
}


@pytest.fixture
def frame(spark):
    """A frame of documents from (doc_id, text) pairs, with columns that operators add themselves."""

    def make(rows):
        data = [(i, t, "x", 7, 0.5) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, score string, length int, id double")

    return make


@pytest.fixture
def odd(frame):
    """Nulls, an empty and a long text, an exact copy, and a repeated row."""
    rows = list(TEXTS.items())
    return frame([*rows, rows[0]])
