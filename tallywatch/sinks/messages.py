"""Write records as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import TOPIC


def to_messages(records: DataFrame) -> DataFrame:
    """One JSON document per record, without its NULL fields."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def publish(records: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Append the records to a topic, or to a folder of text files."""
    writer = to_messages(records).write.format(fmt).mode("append")
    if fmt == "kafka":
        writer.options(**{"topic": TOPIC, **options}).save()
    else:
        writer.options(**options).save(path)
