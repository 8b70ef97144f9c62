import pytest


@pytest.fixture(scope="session")
def session(spark):
    """A session whose workers can import the package."""
    from ferrytab.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def frame(session):
    """Documents (doc_id, text, lang, source, n_chars) from (doc_id, text[, source]) rows."""

    def make(rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return session.createDataFrame(full, schema)

    return make
