import pytest


@pytest.fixture
def docs(spark):
    """Documents in several partitions, with columns whose names operators use themselves."""
    def build(*rows):
        full = [(doc_id, text, "en", "s", 1, 7, "x") for doc_id, text in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, `row` string"
        return spark.createDataFrame(full, schema).repartition(3)

    return build
