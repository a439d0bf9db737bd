import re

import pyarrow.parquet as pq
import pytest
from hypothesis import settings
from pyspark.sql import types as T

settings.register_profile("unhurried", deadline=None)
settings.load_profile("unhurried")

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Names that the operators use inside, as extra columns of their input.
CLASHING = ("key", "id", "h", "hs", "tie", "class", "ids", "n_words", "n_removed", "c0", "begin", "score", "kept", "ta")

PROSE = (
    "the quick brown fox jumps over a lazy dog near the quiet river bank while seven old sailors count their coins "
    "and sing about storms that broke the masts of ships long ago when harbours were small and lamps burned oil all "
    "through winter nights until morning came with gulls and grey light over the water and the market opened its gates "
    "for fishermen bakers smiths weavers and the children who carried baskets between the stalls without any hurry"
)


@pytest.fixture(scope="session")
def documents(sf_dir):
    """Rows of the documents table as dicts."""
    return pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()


@pytest.fixture()
def frame(spark):
    """A frame (doc_id, text, more columns with clashing names) of (doc_id, text) pairs."""

    def make(pairs, parts=3):
        schema = T.StructType(
            [T.StructField(n, T.StringType()) for n in CLASHING[:7]]
            + [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
            + [T.StructField(n, T.StringType()) for n in CLASHING[7:]]
        )
        rows = [(*("x" * 7), i, t, *("y" * (len(CLASHING) - 7))) for i, t in pairs]
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture()
def odd_pairs():
    """NULLs, empty and blank texts, repeated rows, a repeated key with another text, and a long text."""
    return [
        (None, None), (None, PROSE), (1, None), (2, ""), (3, " \n\t"), (4, PROSE), (4, PROSE), (5, "one"), (5, PROSE + " x"),
        (6, " ".join(f"w{i}" for i in range(30_000))), (7, "é ß 日本 \x00 <|endoftext|>"), (8, PROSE),
    ]
