import random

import pytest
from pyspark.sql import types as T

# names that the operators use inside, as extra columns of their inputs
EXTRA = ["id", "node", "key", "score", "size", "bands", "copies", "salt", "digest", "shard", "_id", "keep_id", "length"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())] + [T.StructField(c, T.StringType()) for c in EXTRA])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of (doc_id, text[, lang]) rows with extra columns that clash with inner names."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, *["x"] * len(EXTRA)) for r in rows], SCHEMA)

    return make


def prose(n: int, seed: int, syllables: str = "the an re on ti ing er at nd es") -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(syllables.split()) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, repeated rows and a null id."""
    long = prose(40_000, 1) + " <|endoftext|> it's 'll  \n\n\t  end"
    return [(1, None), (2, ""), (3, "  \n\t"), (4, "é日本😀  x'S"), (5, long), (6, "same text here"), (7, "same text here"), (7, "same text here"), (None, "same text here"), (None, "alone"), (8, "-1 ²½ ٣ 4.5"), (9, "Word")]
