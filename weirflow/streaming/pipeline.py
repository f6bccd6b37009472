"""The telemetry stream: messages to bronze, silver and gold tables, latest values and window rollups."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.operators.classify import flag, gold
from weirflow.operators.payloads import CORRUPT, parse
from weirflow.session import discard
from weirflow.sources.streams import JobConfig, bronze_columns, describe, read_topic, spread
from weirflow.streaming import latest, rollups

# Time text inside a message.
MESSAGE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EVENT_TIME = "event_time"
SOURCE_KEY = "source_key"
COMMITS, LATEST, ROLLUPS = "commits", "latest", "rollups"
_COUNTS = "messages long, flagged long, rejected long"
#: Messages of one writing task at most, on average, where a batch comes in more and smaller pieces, such as those of a state store.
MESSAGES_PER_TASK = 100_000
#: A model, what finds one when a batch begins, or none.
ModelSource = PipelineModel | Callable[[SparkSession], PipelineModel | None] | None


def event_time() -> Column:
    return F.try_to_timestamp(F.col("timestamp"), F.lit(MESSAGE_TIME_FORMAT)).alias(EVENT_TIME)


def source_key(messages: DataFrame) -> Column:
    """What tells two messages apart: their place in the topic where the source has one, else key and text."""
    if {"topic", "partition", "offset"} <= set(messages.columns):
        return F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias(SOURCE_KEY)
    return content_key(messages).alias(SOURCE_KEY)


def content_key(messages: DataFrame) -> Column:
    """The same for a message that was sent twice: its key, where there is one, and a digest of its text."""
    text = F.sha2(F.col("value").cast("string"), 256)
    if "key" not in messages.columns:
        return text
    return F.concat_ws(":", F.col("key").cast("string"), text)  # a null key is left out


def without_replays(messages: DataFrame, within: str) -> DataFrame:
    """Messages sent again, with the same event time and content, are dropped as long as their first is remembered.

    State holds one entry per message until the watermark, ``within`` behind the newest event time, has passed it by as much
    again. So it is bounded by the rate of messages; a message later than the watermark is dropped as well. One without a
    readable time has no place in that order and is kept.
    """
    time = F.try_to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp"), F.lit(MESSAGE_TIME_FORMAT))
    told = messages.select("*", time.alias("_time"), content_key(messages).alias("_content"))
    return told.withWatermark("_time", within).dropDuplicatesWithinWatermark(["_time", "_content"]).select(*messages.columns)


def flagged_messages(messages: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Parse, clean, classify, score. Narrow throughout, the same for batch and stream.

    Every record keeps its source's key, and the offset where the source has one.
    """
    origin = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    known = messages.select("value", source_key(messages), *origin)
    return flag(parse(known, [SOURCE_KEY, *origin]), model).select("*", event_time())


def rejected(messages: DataFrame) -> DataFrame:
    """Messages that are no record, or hold a field of a wrong type, with their text."""
    known = messages.select("value", source_key(messages))
    bad = parse(known, [SOURCE_KEY], keep_corrupt=True).filter(F.col(CORRUPT).isNotNull())
    return bad.select(SOURCE_KEY, F.col(CORRUPT).alias("value"))


def layer(root: str, name: str, run: str | None = None, batch_id: int | None = None) -> str:
    """Folder of a layer, or of one batch of one run in it."""
    return f"{root}/{name}" if run is None else f"{root}/{name}/run={run}/batch_id={batch_id}"


def run_identity(messages: DataFrame, root: str, checkpoint: str) -> str:
    """Name of the run a checkpoint belongs to; made with the checkpoint and kept in it, with what the run reads and writes.

    Batch numbers start again with every new checkpoint, so they mean something only together with it. A checkpoint knows how far its
    source was read for its root: under another source, root or schema it would skip or mix data, so that is refused.
    """
    spark, path = messages.sparkSession, f"{checkpoint}/identity"
    here = {"source": describe(messages), "root": root, "schema": messages.schema.simpleString()}
    try:
        known = json.loads(spark.read.text(path).first()["value"])
    except AnalysisException:  # a new checkpoint
        known = {"run": f"run-{uuid.uuid4().hex}", **here}
        spark.createDataFrame([(json.dumps(known),)], "value string").coalesce(1).write.text(path)
    different = [f"{k} {known[k]!r}, not {v!r}" for k, v in here.items() if known[k] != v]
    if different:
        raise ValueError(f"checkpoint {checkpoint} belongs to {'; '.join(different)}")
    return known["run"]


def published(spark: SparkSession, root: str) -> DataFrame:
    """``run, batch_id, messages, flagged, rejected`` of every complete batch."""
    return spark.read.schema(f"{_COUNTS}, run string, batch_id int").parquet(layer(root, COMMITS))


def _is_published(spark: SparkSession, root: str, run: str, batch_id: int) -> bool:
    try:
        return not spark.read.parquet(layer(root, COMMITS, run, batch_id)).isEmpty()
    except AnalysisException:
        return False


def _newest_batch(spark: SparkSession, root: str, run: str) -> int | None:
    try:
        return spark.read.parquet(layer(root, COMMITS) + f"/run={run}").agg(F.max("batch_id")).first()[0]
    except AnalysisException:  # nothing published yet
        return None


def _at_once(spark: SparkSession, *writes: Callable[[], tuple[DataFrame, int]]) -> list[tuple[DataFrame, int]]:
    """Tables of a batch that do not need each other are written side by side."""
    with ThreadPoolExecutor(len(writes)) as threads:
        return [t.result() for t in [threads.submit(inheritable_thread_target(spark)(w)) for w in writes]]


def _writing_tasks(spark: SparkSession, messages: int) -> int:
    """Tasks that write a batch. Each leaves a file per date, so pieces of a state store are too small to be written one by one."""
    return max(spark.sparkContext.defaultParallelism, -(-messages // MESSAGES_PER_TASK))


@contextmanager
def _read_in(spark: SparkSession, pieces: int) -> Iterator[None]:
    """Files are read in so many pieces, in more where Spark's split size divides them further."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(pieces))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def table_writer(root: str, run: str, model: ModelSource = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: executors write, a repeated batch replaces itself, no batch replaces another's.

    The messages are written first and the other layers read them there. So a batch is computed once, and none of it is kept on the
    executors, whose heaps a backlog in one batch would fill.

    A batch owns the folders named after its run and its number. Its last write is a marker with its counts, which are observed
    while the layers are written; readers take marked batches only. A batch that is already marked is not touched again. The
    latest values of the run so far are a small table of their own, merged with every batch and published with its marker; the
    version before the last is removed.
    """
    done: dict[str, list[int | None]] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _is_published(spark, root, run, batch_id):
            return

        def put(rows: DataFrame, name: str, *by: str) -> tuple[DataFrame, int]:
            path, seen = layer(root, name, run, batch_id), Observation(name)
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*by).parquet(path)
            return spark.read.schema(rows.schema).parquet(path), seen.get["n"]

        bronze, received = put(bronze_columns(batch), "bronze")
        if not received:
            discard(spark, layer(root, "bronze", run, batch_id))
            return
        tasks = _writing_tasks(spark, received)
        messages = bronze.coalesce(tasks)
        scorer = model(spark) if callable(model) else model
        stamped = flagged_messages(messages, scorer).select(
            "*", F.to_date(EVENT_TIME).alias("date"), F.current_timestamp().alias("ingested_at")
        )
        with _read_in(spark, tasks):
            (silver, classified), (_, refused) = _at_once(
                spark, lambda: put(stamped, "silver", "date"), lambda: put(rejected(messages), "rejects")
            )
        if "versions" not in done:  # once per start
            done["versions"] = [_newest_batch(spark, root, run)]
        before = done["versions"][-1]
        values = latest.values_of(silver, EVENT_TIME, SOURCE_KEY)
        if before is not None:
            values = latest.merged(values.union(spark.read.schema(values.schema).parquet(layer(root, LATEST, run, before))))
        # These read the batch just written: columnar, nothing is parsed twice.
        parts = rollups.partials(silver, EVENT_TIME)
        _at_once(
            spark, lambda: put(gold(silver), "gold"), lambda: put(parts.coalesce(tasks), ROLLUPS),
            lambda: put(values.coalesce(tasks), LATEST),
        )
        put(spark.createDataFrame([(received, classified, refused)], _COUNTS).coalesce(1), COMMITS)
        done["versions"].append(batch_id)
        for old in done["versions"][:-2]:
            if old is not None:
                discard(spark, layer(root, LATEST, run, old))
        done["versions"] = done["versions"][-2:]

    return write


def start(
    messages: DataFrame, root: str, checkpoint: str, model: ModelSource = None, once: bool = False,
    interval: str | None = None, partitions: int | None = None, replays_within: str | None = None,
) -> StreamingQuery:
    """Starts the job. A checkpoint belongs to one source and root.

    A lost or a second checkpoint is a new run next to the old ones: nothing is overwritten, and
    ``distinct_records`` leaves out what was read twice. ``replays_within`` drops what is sent twice within that time
    before it is written.
    """
    run = run_identity(messages, root, checkpoint)
    if replays_within:
        messages = without_replays(messages, replays_within)
    writer = (
        spread(messages, partitions)
        .writeStream.foreachBatch(table_writer(root, run, model))
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_topic(spark: SparkSession, config: JobConfig, checkpoint: str) -> StreamingQuery:
    """The deployed job: topic in, tables out, scored by the newest published model as each batch begins."""
    from weirflow.operators.learning import newest_model

    if not config.store:
        raise ValueError("no store to write to")
    return start(read_topic(spark, config), config.store, checkpoint, lambda session: newest_model(session, config.model))


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of the published batches of a layer."""
    return spark.read.parquet(layer(root, name)).join(published(spark, root).select("run", "batch_id"), ["run", "batch_id"], "left_semi")


def distinct_records(silver: DataFrame) -> DataFrame:
    """One row per event time and source key, however often the messages were replayed."""
    return silver.dropDuplicates([EVENT_TIME, SOURCE_KEY])


def last_values(spark: SparkSession, root: str) -> DataFrame:
    """Latest value of every series, from the newest version of each run; the history is not read."""
    newest = published(spark, root).groupBy("run").agg(F.max("batch_id").alias("batch_id")).collect()  # a few runs
    versions = spark.read.parquet(*(layer(root, LATEST, r["run"], r["batch_id"]) for r in newest))
    return latest.merged(versions) if len(newest) > 1 else versions


def rollup(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """Partial aggregates of the published batches of one run.

    Sums cannot tell a replay from new data, so where a root holds several runs, one has to be named.
    """
    marked = published(spark, root)
    if run is None:
        runs = [r["run"] for r in marked.select("run").distinct().collect()]
        if len(runs) != 1:
            raise ValueError(f"name one of the runs {runs}")
        run = runs[0]
    parts = spark.read.parquet(layer(root, ROLLUPS) + f"/run={run}")
    return parts.join(marked.filter(F.col("run") == run).select("batch_id"), "batch_id", "left_semi").drop("batch_id")


def compact(spark: SparkSession, root: str, name: str, target: str) -> None:
    """Rewrites the published batches of a layer as few large files per date, replays left out, for history queries.

    The source's key ends the range key, so a busy day or hour is divided too.
    """
    rows = distinct_records(read_layer(spark, root, name)).drop("run", "batch_id")
    dealt = rows.repartitionByRange("date", EVENT_TIME, SOURCE_KEY).sortWithinPartitions("date", EVENT_TIME, SOURCE_KEY)
    dealt.write.mode("errorifexists").partitionBy("date").parquet(target)


def replay(messages: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """The whole log as one batch through the same transforms."""
    return flagged_messages(messages, model)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Delivery report: counts of every published batch of every run, not of the latest triggers only."""
    return published(spark, root).orderBy("run", "batch_id")
