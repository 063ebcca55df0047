import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source[, lang]]) tuples."""
    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None)
                for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


#: Rows that every operator must survive: nulls, empty and blank texts, a very
#: long text, repeated rows, a repeated id.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word " * 40_000), (5, "a b c"), (5, "a b c"), (5, "another text of the same id"),
    (None, "no id at all but some words here"), (None, None), (6, "x" * 30_000), (7, "one\ntwo\n\nthree", None), (8, "é ü 中文 🙂\u0085  z", None),
]


@pytest.fixture()
def odd(docs_of):
    from pyspark.sql import functions as F
    df = docs_of(ODD)
    clash = ["size", "shard", "slot", "r", "sk", "b", "key", "taken", "kept", "tkey", "marks", "ids", "score", "label", "n", "c", "w", "t", "one", "copy", "id"]
    return df.withColumns({c: F.lit(7) for c in clash})
