import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use for columns of their own
    T.StructField("_row", T.StringType()), T.StructField("_text", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("signals", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("copies", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType()),
    T.StructField("bin", T.StringType()), T.StructField("_first", T.StringType()),
    T.StructField("_spans", T.StringType()), T.StructField("_doc", T.StringType()),
    T.StructField("block", T.StringType()), T.StructField("held_out", T.StringType()),
])


def prose(n, seed=0):
    import random
    rng = random.Random(seed)
    words = ["river", "stone", "walked", "the", "of", "and", "lamp", "quiet", "morning", "letter", "boat", "under",
             "green", "window", "seven", "garden", "often", "people", "carried", "bread", "salt", "winter", "road"]
    return " ".join(rng.choice(words) + str(rng.randrange(400)) * (rng.random() < 0.6) for _ in range(n))


def odd_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    odd white space and control strings."""
    long = prose(60_000, 7)
    rows = [
        (1, prose(120, 1) + "\nshared line of the site here\n" + prose(30, 2), "en", "a", 10),
        (2, prose(120, 1) + "\nshared line of the site here\n" + prose(30, 3), "en", "b", 10),
        (3, prose(120, 1) + "\nshared line of the site here\n" + prose(30, 2), "en", "c", 10),
        (3, prose(120, 1) + "\nshared line of the site here\n" + prose(30, 2), "en", "c", 10),  # a repeated row
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \t\n\x0b\x0c\r ", "xx", "", 1),
        (None, prose(80, 4), "en", "a", 5), (None, None, None, None, None), (None, prose(80, 4), "en", "a", 5),
        (7, long, "de", "a", len(long)), (8, long + " end", "de", "b", len(long)),
        (9, "one", "en", "a", 3), (10, "one", "en", "b", 3), (11, "One two", "en", "b", 3),
        (12, " x y \x1cz <|endoftext|> a  b\n\n\nc ", "fr", "a", 3),
        (13, "Привет мир " * 40, None, "d", 3), (14, "漢字かな交じり文 " * 40, None, "d", 3),
        (15, "word " * 300, "en", "e", 3), (16, "#$%& " * 100, "en", "e", 3), (-5, prose(60, 5), "en", "z", 3),
        (17, "x" * 100_000, "en", "z", 3), (18, "é" * 3 + "\n" + "É", "fr", "z", 3),
    ]
    return [r + ("own",) * (len(DOCS) - 5) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
