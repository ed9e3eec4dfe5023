import pytest
from pyspark.sql import types as T

LONG = "word " * 30_000


@pytest.fixture(scope="session")
def messy(spark):
    """Rows with NULLs in every column, empty and blank texts, a very long one, repeated rows, and extra columns whose names
    operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, key string, _id long, copy int, h1 long"
    extra = (0.5, 7, "k", 3, 9, 1)
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a", 50),
        (1, "one two three four five six seven eight nine ten", "en", "a", 50),
        (2, "One two three four five six seven eight nine ten", "en", None, 50),
        (3, "", "en", "a", 0),
        (4, None, None, "b", None),
        (5, " \t\n ", "de", "b", 4),
        (None, "a text without an id, mail me at jo.doe@mail.example.com", "fr", "c", None),
        (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)),
        (7, "é", "fr", "c", 1),
        (8, "Call +1 (212) 555-0101 or +1 (212) 555-0101, from 10.1.2.3", "en", "c", 10),
    ]
    return spark.createDataFrame([r + extra for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(spark, messy):
    return spark.createDataFrame([], messy.schema)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]))


@pytest.fixture(scope="session")
def tables(root):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "conversations", "pages"):
        con.sql(f"CREATE VIEW {name} AS FROM '{root}/{name}.parquet'")
    return con
