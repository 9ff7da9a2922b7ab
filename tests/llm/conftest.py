import pytest

from recordwise.llm.files import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Rows to documents; extra columns carry names that operators might use themselves."""

    def build(rows):
        shaped = [(i, t, "en", "text", -1, *"abcdefg") for i, t in rows]
        own = ", ".join(f"{name} string" for name in ("_sha", "_best", "_rank", "_row", "gone", "_GONE", "plain_text"))
        return spark.createDataFrame(shaped, f"doc_id bigint, text string, word string, group string, score int, {own}").repartition(3)

    return build
