"""Transaction messages from a Kafka topic."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.schemas import ENVELOPE

# How the broker authenticates its clients.
SECURITY_PROTOCOL = "SASL_SSL"
SASL_MECHANISM = "PLAIN"
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class KafkaSource:
    """A topic and the credentials to read it.

    `extra` holds any further connector options, such as `minPartitions` (more
    tasks than topic partitions) and `maxOffsetsPerTrigger` (bounded batches).
    """

    bootstrap_servers: str
    topic: str
    api_key: str
    api_secret: str = field(repr=False)
    starting_offsets: str = "earliest"
    login_module: str = LOGIN_MODULE
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str, **changes) -> KafkaSource:
        """From the connection details as they are kept in a secret store."""
        names = ("bootstrap_servers", "topic", "api_key", "api_secret")
        details = json.loads(text)
        return cls(**{name: details[name] for name in names}, **changes)

    def options(self) -> dict[str, str]:
        login = (
            f"{self.login_module} required "
            f"username={_quoted(self.api_key)} password={_quoted(self.api_secret)};"
        )
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.security.protocol": SECURITY_PROTOCOL,
            "kafka.sasl.mechanism": SASL_MECHANISM,
            "kafka.sasl.jaas.config": login,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            **self.extra,
        }

    def stream(self, spark: SparkSession) -> DataFrame:
        """Messages as they arrive, with progress kept in the query's checkpoint."""
        return spark.readStream.format("kafka").options(**self.options()).load()

    def batch(self, spark: SparkSession) -> DataFrame:
        """The messages that are in the topic now."""
        return spark.read.format("kafka").options(**self.options()).load()


def envelope(messages: DataFrame, now: Column | None = None, stamped: bool = True) -> DataFrame:
    """Connector columns with key and value as text, and the time of ingestion."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE]
    if stamped:
        stamp = F.current_timestamp() if now is None else now
        columns.append(stamp.alias("ingestion_ts"))
    return messages.select(*columns)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'
