import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A table of (doc_id, text, source, lang), with extra columns whose names clash with results."""

    def build(rows):
        full = [(i, text, source, lang, "x", -1, "y") for i, text, source, lang in rows]
        schema = "doc_id bigint, text string, source string, lang string, key string, n_words int, component_id string"
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 7919} of{i}" for i in range(60_000))
    return [
        (1, None, "a", "en"),
        (2, "", "a", None),
        (3, " \n\t ", None, "en"),
        (4, long, "a", "en"),
        (5, "one two three", "a", "en"),
        (5, "one two three", "a", "en"),
        (None, "one two three", None, None),
        (6, "Größe und Ñandú 123 <b>", "b", "de"),
        (7, long, "b", "en"),
        (8, "\x00\x1f odd separators and \U0001f600 signs", "b", "fr"),
    ]
