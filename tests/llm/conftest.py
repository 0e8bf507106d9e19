import pytest

# Columns whose names the operators use inside.
CLASHING = "id long, run int, digest string, fp long, gone_0 int, `a.b` string, score double, lang string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, blank, very long, repeated and tied rows, with extra columns of clashing names."""
    texts = [
        (1, "The same words stand here, twice over and again."),
        (2, "The same words stand here, twice over and again."),
        (2, "The same words stand here, twice over and again."),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "word " * 40_000),
        (7, "éß日本 \U0001f642 <|endoftext|> x"),
        (8, "%%% *** 123 ---"),
        (None, "no identifier at all, but some words"),
        (None, None),
        (9, "no identifier at all, but some words"),
    ]
    rows = [(i, t, 7, 1, "d", 5, 3, "x", 0.5, None if i == 1 else "en") for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
