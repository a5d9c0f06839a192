import pytest

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edge(spark, documents):
    """Nulls, empty and long texts, repeated rows, a null id and columns whose names might clash."""
    words = documents.orderBy("doc_id").limit(30).collect()
    long = " ".join(r.text for r in words) * 4
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "  \n", None, None, None), (4, long, "en", "b", len(long)),
            (5, words[0].text, "en", "b", 1), (5, words[0].text, "en", "b", 1), (6, words[0].text, None, "b", 1), (7, "one two", "en", "b", 7),
            (8, "One TWO", "en", None, 7), (None, words[1].text, "en", "a", 3), (9, words[1].text + " more", "en", "a", 3),
            (10, words[2].text, "en", "ä", 3), (11, words[2].text, "en", "ä", 3)]
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("n", "th", "size", "key", "node", "id", "range", "slice", "hash", "component"):
        from pyspark.sql import functions as F
        out = out.withColumn(name, F.lit(1))
    return out


@pytest.fixture(scope="session")
def empty(documents):
    return documents.where("false")
