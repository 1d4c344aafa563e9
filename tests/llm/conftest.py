import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def build(rows, partitions=3):
        full = [(*r, "en", "s")[:4] if len(r) == 2 else r for r in rows]
        data = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in full]
        return spark.createDataFrame(data, DOCS).repartition(partitions)

    return build


LONG_WORD = "x" * 300_000
MANY_WORDS = " ".join(f"word{i % 7919}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_documents(documents):
    """NULLs, empty and very long texts, repeated rows, and columns named like results."""
    from pyspark.sql import functions as F

    rows = [
        (None, None, None, None),
        (None, "a text without an id at all", "en", None),
        (1, "", "en", "s"),
        (2, None, None, "s"),
        (3, LONG_WORD, "en", "t"),
        (4, MANY_WORDS, "en", "t"),
        (5, "the same words twice over here", "en", "s"),
        (5, "the same words twice over here", "en", "s"),
        (6, "the same words twice over here", None, None),
        (7, " \t\n \x0b", "en", "s"),
        (8, "123 456 -- !", "en", "s"),
        (9, MANY_WORDS, "en", "t"),
    ]
    made = documents(rows)
    names = "id sha key n size taken target row kept keep_id score rep node queue before component_id ids offset"
    return made.withColumns({n: F.lit("other") for n in names.split()})


@pytest.fixture(scope="session")
def no_documents(documents, odd_documents):
    return odd_documents.limit(0)
