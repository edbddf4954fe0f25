"""Telemetry sources: JSON decode/encode and the streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.schemas import TELEMETRY_FIELDS, TELEMETRY_JSON_SCHEMA

DEFAULT_TOPIC = "fleet-telemetry"


def decode_telemetry(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Binary (or text) JSON ``value`` -> the nine flat telemetry fields.

    Malformed JSON yields an all-null row; a wrongly typed field yields null
    in that field only; unknown keys are ignored.

    The parsed struct is flattened by ``inline`` of a one-element array: the
    resulting Generate node is a barrier that keeps Catalyst from pushing
    the validity filter below the parse, where it would substitute
    ``from_json`` into every predicate and parse each message once per
    referenced field.  This way each message is parsed exactly once, and the
    filter and projections above stay in whole-stage codegen.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), TELEMETRY_JSON_SCHEMA)
    return df.select(F.inline(F.array(parsed)))


def encode_telemetry(df: DataFrame) -> DataFrame:
    """The nine telemetry fields -> one binary JSON ``value`` per row (no key)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in TELEMETRY_FIELDS])).cast("binary").alias("value"))


def kafka_source_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool | None = False,
) -> dict[str, str]:
    """Reader options of the live source.

    ``fail_on_data_loss=None`` leaves Spark's default (fail), which is how
    the older live path reads.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(bool(fail_on_data_loss)).lower()
    return options


def kafka_sink_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    """Writer options matching the producer's delivery settings."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
    }


def read_telemetry_stream(
    spark: SparkSession,
    source_format: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Any streaming DataFrame exposing a ``value`` column.

    ``kafka`` needs the Kafka connector on the classpath.  ``text`` reads
    one JSON object per line from a folder (useful for replays and tests).
    """
    reader = spark.readStream.format(source_format)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path) if path else reader.load()


def write_telemetry_kafka(df: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Publish telemetry rows as JSON values (batch)."""
    writer = encode_telemetry(df).write.format("kafka")
    for key, value in kafka_sink_options(bootstrap_servers, topic).items():
        writer = writer.option(key, value)
    writer.save()
