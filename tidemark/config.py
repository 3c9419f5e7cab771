"""Typed settings of one change feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The registered row schema of the sample feed.
_ITEM = T.StructType().add("id", "string").add("type", "string")
SAMPLE_ROW_SCHEMA = (
    T.StructType()
    .add("id", "string")
    .add("type", "string")
    .add("name", "string")
    .add("ppu", "double")
    .add("batters", T.StructType().add("batter", T.ArrayType(_ITEM)))
    .add("topping", T.ArrayType(_ITEM))
)

# Connector settings the feed ships with.
KAFKA_DEFAULTS = {
    "kafka.security.protocol": "PLAINTEXT",
    "kafka.delivery.timeout.ms": "60000",
    "kafka.enable.idempotence": "true",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.linger.ms": "500",
}


@dataclass(frozen=True)
class FeedConfig:
    """Everything a job needs to know about one feed.

    ``keys`` name the merge key columns of the row image, ``order`` the columns that
    put two changes of one key in chronological order: the event's time, and within an instant its
    place in the topic, where a key has one partition. ``alert_after`` is how many replays of an item are
    cause for an alert; ``max_offsets`` bounds a micro-batch. ``versions`` are the schema versions in force beside
    ``row_schema``, which is that of the rows that land and of events that name no version.
    """

    feed: str
    row_schema: T.StructType = field(default_factory=lambda: SAMPLE_ROW_SCHEMA)
    versions: dict[int, T.StructType] = field(default_factory=dict)
    keys: tuple[str, ...] = ("id",)
    order: tuple[str, ...] = ("ts_us", "ts_ns", "msg_offset")
    topic: str = "changes"
    dead_letter_topic: str | None = None
    bootstrap_servers: str | None = None
    starting_offsets: str = "earliest"
    raw_format: str = "parquet"
    trigger_seconds: int = 3
    alert_after: int = 5
    max_offsets: int = 10_000_000
    topic_partitions: int = 4
    kafka_options: dict[str, str] = field(default_factory=lambda: dict(KAFKA_DEFAULTS))

    @property
    def subject(self) -> str:
        """Registry subject of the value schema."""
        return f"{self.topic}-value"

    def read_options(self) -> dict[str, str]:
        """Options of a Kafka subscription: all of the topic, from the first offset on.

        The checkpoint keeps the position, so a restarted query goes on where the last
        finished batch ended.
        """
        return {
            "kafka.bootstrap.servers": self._servers(),
            "kafka.security.protocol": self.kafka_options["kafka.security.protocol"],
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets),
        }

    def write_options(self) -> dict[str, str]:
        """Options of a Kafka sink: ordered, idempotent publishing. Messages name their topic."""
        return {"kafka.bootstrap.servers": self._servers(), **self.kafka_options}

    def _servers(self) -> str:
        if self.bootstrap_servers is None:
            raise ValueError("bootstrap_servers is not set")
        return self.bootstrap_servers
