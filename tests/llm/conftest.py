import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts, or (id, text) pairs, with columns whose names the
    operators use themselves."""

    def build(*texts, lang="en", **columns):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        made = [(i, t, lang, "src", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(made, DOCUMENTS)
        return df.selectExpr("*", *(f"{v} as `{c}`" for c, v in columns.items()))

    return build


CLASHING = {
    "body": "1", "fp": "2", "score": "3.5", "language": "'x'", "label": "7", "rank": "1",
    "component_id": "9", "toxicity": "'y'", "row": "0", "count": "1", "name": "'n'",
}


@pytest.fixture
def clashing():
    return CLASHING
