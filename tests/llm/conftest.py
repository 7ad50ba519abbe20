import pytest

from reportloom.llm.registry import importable


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    importable(spark)


#: Names that the operators use inside; documents may have them as extra columns.
CLASHES = "block bigint, score double, label string, key string, rep bigint, sh string, w__ string, c int, h int, n_shingles int, kept string, held_out string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, a null id, repeated rows, a long text without breaks, ties, and clashing extra columns."""
    base = "the quick brown fox jumps over the lazy dog and runs away from the angry farmer who owns the big red barn near town "
    rows = [
        (1, base * 3),
        (2, base * 3),
        (2, base * 3),
        (3, None),
        (4, ""),
        (None, base),
        (5, "  \n\t "),
        (6, "one two three"),
        (7, "One TWO three"),
        (8, "x" * 60_000),
        (9, base * 3 + "tail"),
        (10, "wörter mit ümlauten und 漢字 " * 9),
        (11, "a\nb\n\nc"),
    ]
    extra = (None,) * 12
    return spark.createDataFrame([r + extra for r in rows], f"doc_id bigint, text string, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
