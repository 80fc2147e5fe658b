import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows, over several partitions."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC)
        return df.repartition(partitions) if rows else df
    return make


#: nulls, empty and blank texts, repeated rows, ties, a null id, a very long text
EDGE_ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "Alpha beta gamma delta"), (7, "alpha BETA gamma delta"),
    (8, "alpha beta gamma delta"), (8, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (None, None),
    (9, "Ünï cödé 文字 text 123"), (10, "word " * 30_000), (11, "!!! ... ---"), (12, "x" * 3000),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_ROWS)


@pytest.fixture(scope="session")
def empty_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def clashing(edge_docs):
    """Extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    names = ["id", "key", "fp", "label", "size", "size_", "words", "start", "end", "kind", "n", "node", "text_", "spans", "unit", "digest"]
    return edge_docs.withColumns({c: F.lit("x") for c in names})
