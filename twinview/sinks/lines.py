"""Click lines to text folders and Kafka topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def kafka_sink_options(servers: str, topic: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Kafka sink options: writes wait for all replicas, unless ``options`` say otherwise, which
    are passed on as they are (kafka.client.id, security settings)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"} | dict(options or {})


def write_lines(
    lines: DataFrame, fmt: str = "text", path: str | None = None,
    servers: str | None = None, topic: str | None = None, options: Mapping[str, str] | None = None,
) -> None:
    """Append column ``value`` to a text folder (``fmt="text"``) or a topic (``fmt="kafka"``)."""
    value = lines.select("value")
    if fmt == "text":
        value.write.mode("append").options(**(options or {})).text(path)
    elif fmt == "kafka":
        value.write.format("kafka").options(**kafka_sink_options(servers, topic, options)).save()
    else:
        raise ValueError(f"fmt is 'text' or 'kafka', not {fmt!r}")
