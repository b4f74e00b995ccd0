import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    def make(rows):
        """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(make):
    """Null, empty and very long texts, ties, repeated rows, null ids, and further columns with the names of results."""
    long = " ".join(f"wort{k % 977}" for k in range(60_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", "a"), (4, long, "de", "b"), (5, "one short text", "en", None), (5, "one short text", "en", None),
            (6, "one short text", "en", "b"), (None, "one short text", "en", "a"), (None, None, None, None), (7, "mail bob@example.com now " * 40, "fr", "c")]
    docs = make(rows)
    for name in ("score", "predicted", "spans", "position", "slot", "lang_pred", "component_id", "fingerprint", "item_id", "class_id", "tid", "family"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
