import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.compare import difference
from weirflow.operators import classify as C
from weirflow.plans import catalog
from weirflow.session import scratch_path
from weirflow.sources import streams
from weirflow.streaming import latest, pipeline, rollups, silences, windows


@pytest.fixture(scope="module")
def message_path(spark, sf_dir):
    return catalog.message_files(spark, sf_dir)


def run(spark, path, root, checkpoint, **options):
    source = streams.read_text_messages(spark, path, **options)
    query = pipeline.start(source, root, checkpoint, once=True)
    query.awaitTermination(240)
    return query


def test_stream_equals_replay(spark, message_path):
    root = scratch_path(spark, "tables")
    run(spark, message_path, root, scratch_path(spark, "checkpoint"), max_files=1)
    silver = pipeline.read_layer(spark, root, "silver").drop("run", "batch_id", "date", "ingested_at")
    batch = pipeline.replay(streams.replay_text_messages(spark, message_path))
    assert difference(silver.toPandas(), batch.toPandas()) is None
    bronze = pipeline.read_layer(spark, root, "bronze")
    assert bronze.count() == streams.replay_text_messages(spark, message_path).count()
    gold = pipeline.read_layer(spark, root, "gold")
    assert gold.count() == C.gold(batch).count()
    assert pipeline.progress(spark, root).agg(F.sum("messages")).first()[0] == bronze.count()


def test_restart_continues_and_adds_nothing_twice(spark, message_path):
    root, checkpoint = scratch_path(spark, "tables"), scratch_path(spark, "checkpoint")
    run(spark, message_path, root, checkpoint)
    first = pipeline.read_layer(spark, root, "silver").count()
    run(spark, message_path, root, checkpoint)
    assert pipeline.read_layer(spark, root, "silver").count() == first


def test_a_repeated_batch_replaces_itself(spark, message_path):
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a")
    batch = streams.replay_text_messages(spark, message_path)
    write(batch, 3)
    first = pipeline.read_layer(spark, root, "silver").count()
    write(batch, 3)
    assert pipeline.read_layer(spark, root, "silver").count() == first


def test_a_new_checkpoint_in_the_same_root_loses_nothing(spark, message_path):
    root = scratch_path(spark, "tables")
    messages = streams.replay_text_messages(spark, message_path).count()
    run(spark, message_path, root, scratch_path(spark, "checkpoint"))
    once = pipeline.read_layer(spark, root, "silver").count()
    run(spark, message_path, root, scratch_path(spark, "checkpoint"))
    assert pipeline.read_layer(spark, root, "bronze").count() == 2 * messages
    silver = pipeline.read_layer(spark, root, "silver")
    assert silver.count() == 2 * once and pipeline.distinct_records(silver).count() == once
    target = scratch_path(spark, "compact")
    pipeline.compact(spark, root, "silver", target)
    assert spark.read.parquet(target).count() == once


def test_readers_never_see_half_a_batch(spark, message_path):
    root = scratch_path(spark, "tables")
    batch = streams.replay_text_messages(spark, message_path)
    pipeline.table_writer(root, "run-a")(batch, 0)
    first = pipeline.read_layer(spark, root, "silver").count()
    # The next batch came as far as its data, but not to its marker.
    half = pipeline.read_layer(spark, root, "silver").drop("run", "batch_id")
    half.write.partitionBy("date").parquet(pipeline.layer(root, "silver", "run-a", 1))
    assert pipeline.read_layer(spark, root, "silver").count() == first


def test_corrupt_messages_are_kept_with_their_text(spark, message_path):
    root = scratch_path(spark, "tables")
    bad = spark.createDataFrame([("{broken",), ('{"L_T1": "x"}',)], "value string")
    pipeline.table_writer(root, "run-a")(bad.union(streams.replay_text_messages(spark, message_path).limit(5)), 0)
    rejects = {r["value"] for r in pipeline.read_layer(spark, root, "rejects").collect()}
    assert {"{broken", '{"L_T1": "x"}'} <= rejects and len(rejects) <= 7


def test_the_report_covers_all_batches(spark, message_path):
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a")
    one = streams.replay_text_messages(spark, message_path).limit(1).cache()
    for batch_id in range(105):
        spark.createDataFrame([(7, 7, 0)], pipeline._COUNTS).coalesce(1).write.parquet(
            pipeline.layer(root, pipeline.COMMITS, "run-a", batch_id)
        )
    write(one, 104)  # already marked: untouched
    assert pipeline.progress(spark, root).count() == 105


def test_an_empty_batch_writes_nothing(spark, message_path):
    root = scratch_path(spark, "tables")
    pipeline.table_writer(root, "run-a")(streams.replay_text_messages(spark, message_path).limit(0), 0)
    with pytest.raises(Exception):
        pipeline.read_layer(spark, root, "silver")


def test_transforms_stay_narrow_and_in_the_jvm(spark, message_path):
    plan = pipeline.replay(streams.replay_text_messages(spark, message_path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_closed_windows_only(spark, message_path):
    flagged = pipeline.flagged_messages(streams.read_text_messages(spark, message_path))
    assert flagged.isStreaming
    path = scratch_path(spark, "windows")
    means = windows.windowed_mean(flagged, "L_T1", "1 day", "1 hour")
    windows.start_append(means, path, scratch_path(spark, "checkpoint"), once=True).awaitTermination(240)
    batch = pipeline.replay(streams.replay_text_messages(spark, message_path))
    newest = batch.agg(F.max("event_time")).first()[0]
    assert spark.read.parquet(path).filter(F.col("_time") > F.lit(newest)).count() == 0
    assert spark.read.parquet(path).count() > 100


MESSAGE = '{{"timestamp": "2024-01-{:02d}T{:02d}:00:00Z", {}}}'
READINGS = ", ".join(f'"L_T{k}": {v}' for k, v in enumerate((5.0, 3.0, 3.2, 3.0, 2.5, 3.0, 3.5), 1))


def messages(spark, *rows):
    """Messages (day, hour, level) of otherwise equal records."""
    texts = [MESSAGE.format(day, hour, READINGS.replace("5.0", str(level))) for day, hour, level in rows]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def latest_level(spark, root):
    found = pipeline.last_values(spark, root).filter("field = 'L_T1'").collect()
    return {(str(r["_time"])[8:13], r["value"]) for r in found}


def test_late_and_repeated_batches_change_no_latest_value(spark):
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a")
    write(messages(spark, (3, 10, 4.5), (3, 9, 4.25)), 0)
    assert latest_level(spark, root) == {("03 10", 4.5)}
    late = messages(spark, (2, 23, 4.75))
    write(late, 1)
    write(late, 1)
    assert latest_level(spark, root) == {("03 10", 4.5)}
    write(messages(spark, (3, 11, 4.125)), 2)
    assert latest_level(spark, root) == {("03 11", 4.125)}
    # A second run of the same messages merges into the same values.
    pipeline.table_writer(root, "run-b")(messages(spark, (3, 10, 4.5), (3, 9, 4.25)), 0)
    assert latest_level(spark, root) == {("03 11", 4.125)}


def test_latest_values_continue_after_a_restart_and_need_no_history(spark):
    root = scratch_path(spark, "tables")
    pipeline.table_writer(root, "run-a")(messages(spark, (3, 10, 4.5)), 0)
    write = pipeline.table_writer(root, "run-a")  # a new process
    for k in range(1, 4):
        write(messages(spark, (2, k, 4.75)), k)
    assert latest_level(spark, root) == {("03 10", 4.5)}
    read = pipeline.last_values(spark, root).inputFiles()
    assert read and all("/latest/run=run-a/batch_id=3/" in f for f in read)
    kept = {p.name for p in Path(root, "latest", "run=run-a").iterdir()}
    assert kept == {"batch_id=2", "batch_id=3"}


def test_an_unpublished_version_is_not_read(spark):
    root = scratch_path(spark, "tables")
    pipeline.table_writer(root, "run-a")(messages(spark, (3, 10, 4.5)), 0)
    half = spark.read.parquet(pipeline.layer(root, "latest", "run-a", 0)).withColumn("value", F.lit(9.0))
    half.write.parquet(pipeline.layer(root, "latest", "run-a", 1))
    assert latest_level(spark, root) == {("03 10", 4.5)}


def test_rollups_merge_and_late_rows_correct_a_window(spark):
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a")
    write(messages(spark, (3, 10, 4.5), (3, 11, 4.25), (4, 1, 4.0)), 0)
    write(messages(spark, (3, 10, 4.75)), 1)

    def levels(df):
        return {(str(r["_time"])[5:13], r["value"]) for r in df.filter("field = 'L_T1'").collect()}

    parts = pipeline.rollup(spark, root)
    assert all("/rollups/" in f or "/commits/" in f for f in parts.inputFiles())
    assert levels(rollups.window_mean(parts, ["L_T1"], "1 hour")) == {("01-03 11", 4.625), ("01-03 12", 4.25), ("01-04 02", 4.0)}
    assert levels(rollups.window_mean(parts, ["L_T1"], "1 day")) == {("01-04 00", 4.5), ("01-05 00", 4.0)}
    assert levels(rollups.window_max(parts, ["L_T1"], "1 day")) == {("01-04 00", 4.75), ("01-05 00", 4.0)}
    pipeline.table_writer(root, "run-b")(messages(spark, (3, 10, 4.5)), 0)
    with pytest.raises(ValueError, match="name one"):
        pipeline.rollup(spark, root)
    assert levels(rollups.window_max(pipeline.rollup(spark, root, "run-b"), ["L_T1"], "1 day")) == {("01-04 00", 4.5)}


def test_the_marker_is_filled_while_writing(spark, message_path):
    """The counts of a batch equal its tables, and no layer is read again for them."""
    root = scratch_path(spark, "tables")
    bad = spark.createDataFrame([("{broken",), ('{"L_T1": "x"}',)], "value string")
    pipeline.table_writer(root, "run-a")(bad.union(streams.replay_text_messages(spark, message_path)), 0)
    marker = pipeline.published(spark, root).first()
    counted = {name: pipeline.read_layer(spark, root, name).count() for name in ("bronze", "silver", "rejects")}
    assert (marker["messages"], marker["flagged"], marker["rejected"]) == tuple(counted.values())


def test_a_checkpoint_belongs_to_its_source_root_and_schema(spark, message_path):
    root, checkpoint = scratch_path(spark, "tables"), scratch_path(spark, "checkpoint")
    run(spark, message_path, root, checkpoint)
    with pytest.raises(ValueError, match="root"):
        run(spark, message_path, scratch_path(spark, "tables"), checkpoint)
    other = scratch_path(spark, "messages")
    messages(spark, (3, 1, 4.5)).write.text(other)
    with pytest.raises(ValueError, match="source"):
        run(spark, other, root, checkpoint)
    keyed = scratch_path(spark, "messages")
    spark.createDataFrame([("k", "{}")], "key string, value string").write.parquet(keyed)
    with pytest.raises(ValueError, match="schema"):
        pipeline.start(streams.read_keyed_messages(spark, keyed), root, checkpoint, once=True)
    run(spark, message_path, root, checkpoint, max_files=2)  # a rate limit may change


def test_messages_sent_twice_are_dropped_and_state_is_bounded(spark, tmp_path):
    """Days in files one after the other, every message twice; what the watermark has passed is forgotten."""
    source = str(tmp_path / "in")
    for day in range(1, 13):
        rows = messages(spark, *[(day, hour, 4.5) for hour in range(24)])
        rows.union(rows).coalesce(1).write.mode("append").text(source)
    root = scratch_path(spark, "tables")
    stream = streams.read_text_messages(spark, source, max_files=1)
    query = pipeline.start(stream, root, scratch_path(spark, "checkpoint"), once=True, replays_within="1 day")
    query.awaitTermination(240)
    assert pipeline.read_layer(spark, root, "bronze").count() == 12 * 24
    remembered = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(remembered) >= 12 and max(remembered) <= 4 * 24


def test_unreadable_messages_do_not_move_the_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    bad = spark.createDataFrame([("{broken",)], "value string")
    bad.union(messages(spark, (3, 1, 4.5))).coalesce(1).write.mode("append").text(source)
    messages(spark, (3, 2, 4.5), (3, 1, 4.5)).coalesce(1).write.mode("append").text(source)
    root = scratch_path(spark, "tables")
    stream = streams.read_text_messages(spark, source, max_files=1)
    pipeline.start(stream, root, scratch_path(spark, "checkpoint"), once=True, replays_within="1 day").awaitTermination(240)
    assert pipeline.read_layer(spark, root, "silver").count() == 2 and pipeline.read_layer(spark, root, "rejects").count() == 1


def watch(spark, source, path, checkpoint):
    flagged = pipeline.flagged_messages(streams.read_text_messages(spark, source, max_files=1))
    silences.start(flagged, 180, "30 minutes", path, checkpoint, once=True).awaitTermination(240)
    return sorted((str(r["last_seen"]), str(r["silent_at"])) for r in spark.read.parquet(path).collect())


def test_a_restart_in_the_middle_of_a_gap(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    messages(spark, (3, 1, 4.5), (3, 3, 4.5)).coalesce(1).write.mode("append").text(source)
    messages(spark, (3, 5, 4.5)).coalesce(1).write.mode("append").text(source)
    assert watch(spark, source, path, checkpoint) == []
    # Another series goes on, so time passes; the first is silent from 05:00 on.
    other = messages(spark, (3, 9, 4.5)).select(F.replace("value", F.lit('"L_T4": 3.0'), F.lit('"L_T4": 1.0, "S_PU6": 0')).alias("value"))
    other.coalesce(1).write.mode("append").text(source)
    assert watch(spark, source, path, checkpoint) == [("2024-01-03 05:00:00", "2024-01-03 08:00:00")]
    messages(spark, (3, 20, 4.5)).coalesce(1).write.mode("append").text(source)
    found = watch(spark, source, path, checkpoint)
    assert found == [
        ("2024-01-03 05:00:00", "2024-01-03 08:00:00"), ("2024-01-03 09:00:00", "2024-01-03 12:00:00"),
    ]
    table = pipeline.replay(streams.replay_text_messages(spark, source))
    batch = silences.silences_of(table, 180).collect()
    assert sorted((str(r["last_seen"]), str(r["silent_at"])) for r in batch) == found


def test_an_interval_triggers_batches(spark, tmp_path):
    source, root = str(tmp_path / "in"), scratch_path(spark, "tables")
    messages(spark, (3, 1, 4.5)).coalesce(1).write.mode("append").text(source)
    stream = streams.read_text_messages(spark, source)
    query = pipeline.start(stream, root, scratch_path(spark, "checkpoint"), interval="1 second")
    try:
        deadline = time.monotonic() + 120
        seen = 0
        while time.monotonic() < deadline and seen < 2:
            try:
                seen = pipeline.read_layer(spark, root, "silver").count()
            except AnalysisException:
                seen = 0
            if seen == 1:
                messages(spark, (3, 2, 4.5)).coalesce(1).write.mode("append").text(source)
            time.sleep(1)
        assert seen >= 2 and query.isActive
    finally:
        query.stop()


def test_offsets_tell_messages_of_one_key_apart(spark):
    rows = [("k", '{"timestamp": "2024-01-01T00:00:00Z"}', "t", 0, n) for n in (1, 2)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    assert [r[0] for r in df.select(pipeline.source_key(df)).collect()] == ["t/0/1", "t/0/2"]
    plain = df.drop("offset")
    assert plain.select(pipeline.source_key(plain)).distinct().count() == 1


def test_topic_settings_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("KAFKA_BROKER", "b:1")
    monkeypatch.setenv("KAFKA_TOPIC", "t")
    with pytest.raises(ValueError):
        monkeypatch.delenv("KAFKA_TOPIC")
        streams.JobConfig.from_env()
    monkeypatch.setenv("KAFKA_TOPIC", "t")
    assert "maxOffsetsPerTrigger" not in streams.topic_options(streams.JobConfig.from_env())
    monkeypatch.setenv("MAX_OFFSETS_PER_TRIGGER", "50")
    options = streams.topic_options(streams.JobConfig.from_env())
    assert options == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "50",
    }


def test_spread_over_more_tasks(spark, message_path):
    few = streams.replay_text_messages(spark, message_path).coalesce(1)
    assert streams.spread(few, 6).rdd.getNumPartitions() == 6


def test_latest_values_of_a_batch_stay_with_their_records(spark, message_path):
    """A batch of any size does not go to the tasks of its alert types."""
    silver = pipeline.replay(streams.replay_text_messages(spark, message_path))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = latest.values_of(silver, pipeline.EVENT_TIME, pipeline.SOURCE_KEY)
        plan = values._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def messages_by_file(spark, path):
    return {r["file"]: r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).count().collect()}


def test_a_larger_table_has_more_files_of_messages_and_as_many_batches(spark, sf_dir, monkeypatch):
    few = messages_by_file(spark, catalog.keyed_messages(spark, sf_dir))
    assert len(few) == catalog.MESSAGE_FILES
    monkeypatch.setattr(catalog, "MESSAGES_PER_FILE", 50, raising=False)
    many = messages_by_file(spark, catalog.keyed_messages(spark, sf_dir))
    assert sum(many.values()) == sum(few.values()) == 1_000 and len(many) == 20 and max(many.values()) < 100
    root = scratch_path(spark, "tables")
    catalog.stream_keyed(spark, sf_dir, root)
    batches = [r["messages"] for r in pipeline.progress(spark, root).collect()]
    assert len(batches) == 3 and sum(batches) == 1_000


def test_a_larger_table_sent_twice_is_read_in_as_many_batches(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog, "MESSAGES_PER_FILE", 50, raising=False)
    path = catalog.keyed_messages(spark, sf_dir, copies=2)
    sent = messages_by_file(spark, path)
    assert sum(sent.values()) == 2_000 and len(sent) == 40 and max(sent.values()) < 100
    root = scratch_path(spark, "tables")
    catalog.stream_keyed(spark, sf_dir, root, copies=2, replays_within=catalog.REPLAY_MEMORY)
    kept = pipeline.progress(spark, root).collect()
    cut = 8  # messages without a readable time are kept both times
    assert len(kept) == 6 and sum(r["messages"] for r in kept) == 1_000 + cut


def test_small_pieces_of_a_batch_are_written_together(spark, monkeypatch):
    """Pieces of a state store do not leave a file each per date; a large batch still has as many tasks as it needs."""
    pieces = messages(spark, *[(day, hour, 4.5) for day in (3, 4) for hour in range(24)] * 10).repartition(60)

    def files_per_date():
        root = scratch_path(spark, "tables")
        pipeline.table_writer(root, "run-a")(pieces, 0)
        assert pipeline.published(spark, root).first()["flagged"] == pipeline.read_layer(spark, root, "silver").count() == 480
        found = Path(pipeline.layer(root, "silver", "run-a", 0)).glob("date=*")
        return [len(list(date.glob("*.parquet"))) for date in found]

    few = files_per_date()
    assert len(few) == 2 and max(few) <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(pipeline, "MESSAGES_PER_TASK", 16)  # 30 tasks
    many = files_per_date()
    assert len(many) == 2 and max(few) < min(many) <= max(many) <= 30


def test_no_batch_is_kept_on_the_executors(spark):
    """A backlog in one batch would fill their heaps. Every layer still sees the same messages, though they differ each time."""
    known, kept = {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}, []

    def no_model(session):
        kept.extend(i.id() for i in session.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() not in known)

    rows = messages(spark, *[(3, hour, 4.5) for hour in range(24)])
    told = rows.select(F.replace("value", F.lit('"L_T1"'), F.concat(F.lit('"id": "'), F.uuid(), F.lit('", "L_T1"'))).alias("value"))
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a", no_model)
    write(told, 0)
    bronze, silver = (pipeline.read_layer(spark, root, name) for name in ("bronze", "silver"))
    assert bronze.select(pipeline.source_key(bronze)).exceptAll(silver.select(pipeline.SOURCE_KEY)).isEmpty()
    assert bronze.count() == silver.count() == 24 and kept == []


def test_an_empty_batch_leaves_no_messages(spark):
    root = scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a")
    write(messages(spark, (3, 1, 4.5)), 0)
    write(messages(spark, (3, 2, 4.5)).filter(F.rand() > 2), 1)
    assert pipeline.progress(spark, root).count() == 1 and not Path(pipeline.layer(root, "bronze", "run-a", 1)).exists()


def test_pieces_of_a_batch_follow_its_messages(spark, monkeypatch):
    """Messages that a small file packs densely are still read by as many tasks as they need; the setting is put back."""
    monkeypatch.setattr(pipeline, "MESSAGES_PER_TASK", 16)
    name, tasks = "spark.sql.files.minPartitionNum", 30
    before = spark.conf.get(name, None)
    root = scratch_path(spark, "tables")
    pieces = messages(spark, *[(3, hour, 4.5) for hour in range(24)] * 20).repartition(60)
    pipeline.table_writer(root, "run-a")(pieces, 0)
    found = len(list(Path(pipeline.layer(root, "silver", "run-a", 0)).glob("date=*/*.parquet")))
    assert spark.sparkContext.defaultParallelism < found <= tasks and found > 20
    assert spark.conf.get(name, None) == before
