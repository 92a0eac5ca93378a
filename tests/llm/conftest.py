import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Build documents from (id, text) pairs, with columns whose names clash with those of results."""

    def make(rows, extra=True):
        df = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS
        )
        if extra:
            for name in ("row", "id", "ids", "n_words", "kept", "n_hit", "score", "label", "chunk", "c0", "d", "v", "class_id"):
                df = df.selectExpr("*", f"doc_id AS `{name}`")
        return df

    return make
