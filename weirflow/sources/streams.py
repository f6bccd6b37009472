"""Message sources: a broker topic, or text files with the same ``value`` column."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the settings a deployment passes in.
BROKER_VARIABLE, TOPIC_VARIABLE = "KAFKA_BROKER", "KAFKA_TOPIC"


@dataclass(frozen=True)
class JobConfig:
    """Where a job reads and writes. A backlog is read at once unless ``max_offsets_per_trigger`` is set."""

    broker: str
    topic: str
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    store: str | None = None
    model: str | None = None

    @classmethod
    def from_env(cls) -> JobConfig:
        env = os.environ
        missing = [name for name in (BROKER_VARIABLE, TOPIC_VARIABLE) if not env.get(name)]
        if missing:
            raise ValueError(f"not set: {', '.join(missing)}")
        limit = env.get("MAX_OFFSETS_PER_TRIGGER")
        return cls(
            broker=env[BROKER_VARIABLE],
            topic=env[TOPIC_VARIABLE],
            starting_offsets=env.get("STARTING_OFFSETS", cls.starting_offsets),
            max_offsets_per_trigger=int(limit) if limit else None,
            store=env.get("TELEMETRY_STORE"),
            model=env.get("MODEL_PATH"),
        )


def topic_options(config: JobConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.broker,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
    }
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Unbounded topic. Needs the Kafka connector on the class path (not part of Spark's own jars)."""
    return spark.readStream.format("kafka").options(**topic_options(config)).load()


def read_topic_batch(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The whole topic once, for a replay from the beginning."""
    options = {"kafka.bootstrap.servers": config.broker, "subscribe": config.topic, "startingOffsets": "earliest"}
    return spark.read.format("kafka").options(**options).load()


def read_text_messages(
    spark: SparkSession, path: str, max_files: int | None = None, latest_first: bool = False
) -> DataFrame:
    """Text files as a stream of messages, one per line; ``max_files`` is the rate limit per trigger."""
    reader = spark.readStream.format("text").option("latestFirst", latest_first)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def replay_text_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same files as a batch."""
    return spark.read.text(path)


def spread(messages: DataFrame, partitions: int | None) -> DataFrame:
    """Deals messages over more tasks when the topic has too few partitions for the cluster."""
    return messages.repartition(partitions) if partitions else messages


def bronze_columns(messages: DataFrame) -> DataFrame:
    """Message text untouched, with whatever the source tells about its origin."""
    origin = [c for c in ("key", "topic", "partition", "offset", "timestamp") if c in messages.columns]
    return messages.select(F.col("value").cast("string").alias("value"), *origin)


#: Options that say what a source is; others, such as rate limits, may change from start to start.
_IDENTITY = ("path", "kafka.bootstrap.servers", "subscribe", "subscribePattern", "assign")


def describe(messages: DataFrame) -> str:
    """What a stream reads, the same text in every session."""
    leaves, out = messages._jdf.queryExecution().analyzed().collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.nodeName().startswith("StreamingRelationV2"):
            kind, options = leaf.sourceName(), leaf.extraOptions().asCaseSensitiveMap()
            found = {name: options.get(name) for name in _IDENTITY if options.containsKey(name)}
        elif leaf.nodeName() == "StreamingRelation":
            kind, options = leaf.dataSource().className(), leaf.dataSource().options()
            found = {name: options.get(name).get() for name in _IDENTITY if options.contains(name)}
        else:
            kind, found = leaf.nodeName(), {}
        out.append(" ".join([kind, *(f"{name}={value}" for name, value in found.items())]))
    return "; ".join(out)


def read_keyed_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stored messages with their keys (columns ``key, value``) as a stream."""
    reader = spark.readStream.schema("key string, value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
