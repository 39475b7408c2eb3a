"""Topic readers and writers.

A topic is a DataFrame with the columns of :data:`evlake.schema.TOPIC`, batch or
streaming. ``KafkaTopic`` needs Spark's Kafka connector on the class path;
``FileTopic`` keeps the same columns in Parquet files and needs nothing.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evlake.fixed_values import FLUSH_INTERVAL_SECONDS, MAX_FILES, MAX_MESSAGES
from evlake.schema import TOPIC

#: Bytes of a row group, compressed. A file is split between tasks at its row groups only,
#: and with Parquet's own 128 MB a batch of one file would be the work of one task.
GROUP_BYTES = 1024 * 1024

#: ``"earliest"``, ``"latest"`` or the first offset to read per partition.
Start = str | Mapping[int, int]


def next_offsets(messages: DataFrame) -> dict[int, int]:
    """Offset after the last message of each partition; one entry per partition."""
    rows = messages.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()
    return {r["partition"]: r["next"] for r in rows}


def from_offsets(messages: DataFrame, start: Mapping[int, int]) -> DataFrame:
    """Messages at or after the given offsets; unlisted partitions are read whole."""
    if not start:
        return messages
    pairs = [F.lit(v).cast(t) for p, o in sorted(start.items()) for v, t in ((p, "int"), (o, "long"))]
    first = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("partition")), F.lit(0))
    return messages.where(F.col("offset") >= first)


@dataclass(frozen=True)
class KafkaTopic:
    """One Kafka topic; ``client`` holds any client properties, without prefix.

    A batch of the stream holds at most ``max_messages``, the first one too. With
    ``min_messages`` a batch waits until so many are there or ``max_delay`` ("10 seconds")
    has passed since the last one: so many messages or so much time, whichever is first.
    """

    name: str
    servers: str
    client: Mapping[str, str] = field(default_factory=dict)
    start: Start = "earliest"
    max_messages: int | None = MAX_MESSAGES
    min_partitions: int | None = None
    min_messages: int | None = None
    max_delay: str = f"{FLUSH_INTERVAL_SECONDS:g} seconds"

    def read_options(self, streaming: bool) -> dict[str, str]:
        options = {f"kafka.{k}": str(v) for k, v in self.client.items()}
        options["kafka.bootstrap.servers"] = self.servers
        options["subscribe"] = self.name
        # A batch read is a replay of all that is retained, wherever the stream starts.
        start = self.start if streaming else "earliest"
        if not isinstance(start, str):
            start = json.dumps({self.name: {str(p): o for p, o in sorted(start.items())}})
        options["startingOffsets"] = start
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        if not streaming:
            options["endingOffsets"] = "latest"
        if streaming and self.max_messages:
            options["maxOffsetsPerTrigger"] = str(self.max_messages)
        if streaming and self.min_messages:
            options["minOffsetsPerTrigger"] = str(self.min_messages)
            options["maxTriggerDelay"] = self.max_delay
        return options

    def write_options(self) -> dict[str, str]:
        options = {f"kafka.{k}": str(v) for k, v in self.client.items()}
        return {**options, "kafka.bootstrap.servers": self.servers, "topic": self.name}

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.read_options(streaming=True))
        return reader.load().select(*TOPIC.fieldNames())

    def batch(self, spark: SparkSession) -> DataFrame:
        """Everything retained, for a full replay."""
        reader = spark.read.format("kafka").options(**self.read_options(streaming=False))
        return reader.load().select(*TOPIC.fieldNames())

    def publish(self, messages: DataFrame) -> None:
        messages.select("partition", "value").write.format("kafka").options(
            **self.write_options()
        ).save()


@dataclass(frozen=True)
class FileTopic:
    """A topic kept as Parquet files; each ``publish`` adds files.

    A batch of the stream holds at most ``max_files``, or with ``max_bytes`` as many
    files as have so many bytes together, one at least.
    For ``start="latest"`` pass the offsets of the moment, ``next_offsets(batch)``,
    so that a restart begins where the first run did.
    """

    path: str
    start: Mapping[int, int] = field(default_factory=dict)
    max_files: int | None = MAX_FILES
    max_bytes: int | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(TOPIC)
        # Spark takes one of the two.
        if self.max_bytes:
            reader = reader.option("maxBytesPerTrigger", self.max_bytes)
        elif self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        return from_offsets(reader.parquet(self.path), self.start)

    def batch(self, spark: SparkSession) -> DataFrame:
        return from_offsets(spark.read.schema(TOPIC).parquet(self.path), self.start)

    def publish(self, messages: DataFrame) -> None:
        writer = messages.select(*TOPIC.fieldNames()).write.mode("append")
        writer.option("parquet.block.size", GROUP_BYTES).parquet(self.path)
