"""Small tables for the tests of zpoints.llm; test modules import the fixtures that they use."""

import random

import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # extra columns whose names operators use inside
                     *[T.StructField(c, T.StringType()) for c in ("id", "spans", "plan", "epoch", "at", "gone", "score",
                                                                  "size", "shard", "bucket", "band", "rep", "copies",
                                                                  "node", "y", "n")]])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


VOCABULARY = ["".join(random.Random(i).choice("aeioubcdfglmnprst") for _ in range(2 + i % 7)) for i in range(900)]


def doc(i, text, source="s", lang="en"):
    return (i, text, lang, source, len(text) if text is not None else None, *["x"] * 16)


def edge_rows():
    """Nulls, empty, short, repeated, copied, nearly copied, interleaved, very long and odd texts."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    words = base.split(" ")
    near = words[:60] + ["changed"] + words[61:]
    passage = sentence(rng, 55)
    long_text = sentence(rng, 60_000)
    rows = [doc(1, "just four words here"), doc(2, None), doc(3, ""), doc(4, "  \n\t "), doc(5, base), doc(6, base),
            doc(6, base), doc(7, " ".join(near), source=None), doc(8, "a" * 20), doc(None, base, source="z"), doc(None, None, source="z"),
            doc(9, long_text, source="t", lang=None), doc(10, "x y  z 日本語 😀 \x85 \x1c end."),
            doc(11, " ".join(["spam"] * 300)), doc(12, sentence(rng, 30) + " " + passage + "\n" + sentence(rng, 25)),
            doc(13, sentence(rng, 40) + "  " + passage + " " + sentence(rng, 10)), doc(14, passage, source="t"),
            doc(15, sentence(rng, 500), source="u"), doc(16, sentence(rng, 19)), doc(17, sentence(rng, 20)),
            doc(-3, "word word" + " word" * 25, source="")]
    rows += [doc(100 + i, sentence(rng, 80) if i % 3 else base, source="hot") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(i, int(i % 2), int(i % 5 == 0)) for i in range(100, 140)] + [(None, 1, 0), (1, None, None)],
                                 LABELS)
