"""Raw messages: one JSON document per row in a column named value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.schema import ENVELOPE, NARROW_ENVELOPE, TOPIC

KAFKA_DEFAULTS = {"subscribe": TOPIC, "startingOffsets": "latest"}


def stream_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Unbounded messages from a topic, or from a folder of text files.

    Kafka needs kafka.bootstrap.servers among the options and the connector on the class path.
    """
    if fmt == "kafka":
        return spark.readStream.format(fmt).options(**{**KAFKA_DEFAULTS, **options}).load().select("value")
    return spark.readStream.format(fmt).options(**options).load(path).select("value")


def read_messages(spark: SparkSession, fmt: str = "text", path: str | None = None, **options: str) -> DataFrame:
    """The same messages as one bounded batch."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.load(path) if path else reader.load()).select("value")


def parse(messages: DataFrame, schema: T.StructType = ENVELOPE, *kept: str) -> DataFrame:
    """JSON to columns, beside the columns of the message named in `kept`.

    A bad document gives NULLs and a bad field gives one NULL; neither fails the job.

    The document goes through a one-element explode: filters on its fields then stay above it, where pushed
    below a plain projection each of them would parse the text once more.
    """
    document = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(*kept, F.explode(F.array(document)).alias("data")).select(*kept, "data.*")


def parse_narrow(messages: DataFrame, *kept: str) -> DataFrame:
    """Only what unified records need."""
    return parse(messages, NARROW_ENVELOPE, *kept)
