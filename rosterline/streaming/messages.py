"""Message streams in and out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_source_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    """Options of the Kafka source. max_offsets bounds a micro-batch, if given."""
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A stream with a value column holding JSON messages.

    Kafka by default (the connector package is the caller's); any file format works
    as well, given a path: "text" has the right column already.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def write_messages(
    encoded: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    mode: str = "append",
) -> None:
    """Send encoded (key, value) rows to a topic, or to files."""
    out = encoded if fmt == "kafka" else encoded.select("value")
    writer = out.write.format(fmt).options(**(options or {})).mode(mode)
    writer.save(path) if path else writer.save()
