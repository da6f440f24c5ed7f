import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])


def passage(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(n))


def corpus() -> list[tuple]:
    """Nulls, empty and long texts, ties, near copies, shared passages, repeated rows."""
    rng = random.Random(7)
    shared = passage(rng, 70)
    rows = [(0, None, None), (1, "", "en"), (2, " \t\n", None), (3, "one two", "en"), (4, "ONE  two", "fr"), (5, "One two three four five", "en")]
    for i in range(10, 40):
        words = passage(rng, rng.randint(30, 160)).split()
        if i % 3 == 0:
            words[10:10] = shared.split()
        rows.append((i, " ".join(words) + ".", "en" if i % 2 else "de"))
    for i in range(40, 60):  # near and exact copies
        words = rows[6 + i % 7][1].split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "edit"
        rows.append((i, " ".join(words), "en"))
    rows.append((60, passage(rng, 6000), "en"))
    rows.append((61, "same " * 300, "en"))
    rows.append((62, "Ünïcode, naïve ﬁ漢字 İ. don't " * 20 + "😀", "fr"))
    rows.append((62, rows[-1][1], "fr"))
    rows.append((None, rows[6][1], "en"))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = ["doc", "id", "key", "kept", "keep_id", "n_words", "length", "rank", "part", "label", "labels", "score", "norm", "digest", "component", "component_id", "_spans", "block", "host", "text_key", "n"]
    return docs.select("*", *(F.lit("x").alias(n) for n in names))
