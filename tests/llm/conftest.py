import pytest
from pyspark.sql import Row

#: Nulls, empty and long texts, repeated rows, ties, and columns whose names
#: are also used inside the operators.
LONG = " ".join(f"word{i % 997} tail{i}" for i in range(30_000))
TEXTS = [None, "", "   \n ", "one", "two words.", "a b c d e f g h i j k l m n o p.", LONG, "!!! ???", "ÀÉ ñ 漢字 text here. Ünï",
         "a b c d e f g h i j k l m n o p."]


@pytest.fixture
def odd_docs(spark):
    rows = [Row(doc_id=i, text=t, id="x", node=None, n_words=7, hash=i, lang=None, label=1, score=0.5, spans=[1], u=0) for i, t in enumerate(TEXTS)]
    rows += [rows[5], Row(doc_id=None, text="no id at all here", id="y", node=1, n_words=None, hash=None, lang="en", label=None, score=None, spans=None, u=None),
             Row(doc_id=None, text=None, id=None, node=None, n_words=None, hash=None, lang=None, label=0, score=0.0, spans=[], u=1)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, node long, n_words int, hash long, lang string, "
                                 "label int, score double, spans array<int>, u long")


@pytest.fixture
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)
