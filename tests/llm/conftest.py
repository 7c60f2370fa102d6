import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENT = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())]
    + [StructField("source", StringType()), StructField("n_chars", LongType()), StructField("block", StringType()), StructField("_key", StringType())]
)


@pytest.fixture
def documents(spark):
    """Maker of a documents table from (doc_id, text) rows, with two more columns of clashing names."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), "x", "y") for i, t in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


def words(n, seed=0):
    """n different words, others for another seed."""
    return [f"w{seed}x{i}" for i in range(n)]


@pytest.fixture
def odd_rows():
    """Nulls, empty, blank, repeated and very long texts, and ties."""
    long = " ".join(words(30_000, 9))
    shared = " ".join(words(60, 1))
    return [
        (1, shared),
        (2, shared + " tail"),
        (2, shared + " tail"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, "no key " + shared),
        (6, long),
        (7, "ünï cödé " + "日本語 " * 40 + "\nline\nline\n\nline"),
        (8, "x" * 100_000),
        (9, "A b\nA b\nC d e f g h i j k l m n\nC d e f g h i j k l m o"),
    ]
