"""Incremental queries. The events are staged as files, at least one per batch, so that streams run several batches.

A table of more partitions is staged by as many tasks, and a batch then reads its share of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecferry.functions.coerce import FieldSpec
from vecferry.plans.tables import table
from vecferry.session import work_path
from vecferry.sources import target as tg
from vecferry.streaming import changes, keyed, load, progress
from vecferry.streaming import table as kept

BATCHES = 4
EVENT_SPECS = [
    FieldSpec("event_id", "id", "INT64", is_key=True),
    FieldSpec("ts", "at", "VARCHAR", max_length=64),
    FieldSpec("user_id", "user", "INT64"),
    FieldSpec("event_type", "kind", "VARCHAR", max_length=5),
    FieldSpec("props", "props", "JSON"),
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.when(F.col("event_id") % 11 == 0, "{not json").otherwise(F.col("props"))
    return table(spark, sf_dir, "events").withColumn("props", props)


def _files(rows: DataFrame) -> int:
    return max(BATCHES, rows.rdd.getNumPartitions())


def _stage(rows: DataFrame, path: str) -> int:
    """Writes the rows in ranges of their key; returns how many files make a batch."""
    files = _files(rows)
    rows.repartitionByRange(files, "event_id").write.mode("append").parquet(path)
    return -(-files // BATCHES)


def _load(spark, staged, schema, paths, files_per_batch=1, **options):
    stream = load.read_stream(spark, staged, schema, files_per_batch=files_per_batch)
    load.stream_load(stream, EVENT_SPECS, paths, "events", **options)


def q_stream_load(spark, sf_dir):
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    _load(spark, staged, events.schema, paths, _stage(events, staged))
    return load.read_rows(spark, paths)


def q_ledger(spark, sf_dir):
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    _load(spark, staged, events.schema, paths, _stage(events, staged))
    total = events.agg(F.count("*").alias("n"))
    return load.progress(spark, paths, total).select(
        "index_name", "status", "migrated", "rejected", "total", "progress_pct"
    )


def q_stream_resume(spark, sf_dir):
    """Half of the data is loaded, then the rest arrives and the same load is run twice more."""
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.filter(early), events.filter(~early)):
        _load(spark, staged, events.schema, paths, _stage(part, staged))
    _load(spark, staged, events.schema, paths)
    return load.read_rows(spark, paths).groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.sum("user").alias("user_sum")
    )


def q_stream_rejects(spark, sf_dir):
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    _load(spark, staged, events.schema, paths, _stage(events, staged))
    return load.read_rows(spark, paths, "rejected").select("id", F.col("_reject_reason").alias("reason"))


def q_stream_start_over(spark, sf_dir):
    """A load started over stores everything once in its own generation and leaves the earlier one alone."""
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    share = _stage(events, staged)
    generations = [paths, paths.start_over()]
    for generation in generations:
        _load(spark, staged, events.schema, generation, share)
    first, second = (
        load.read_rows(spark, g).groupBy("kind").agg(F.count("*").alias("n_rows")).withColumn("generation", F.lit(n))
        for n, g in enumerate(generations)
    )
    return first.unionByName(second)


def q_ledger_batches(spark, sf_dir):
    """Ledger rows add up to the load; a batch's keys lie between its first and last key."""
    staged, paths = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load"))
    events = _events(spark, sf_dir)
    _load(spark, staged, events.schema, paths, _stage(events, staged))
    return load.read_ledger(spark, paths).groupBy("index_name").agg(
        (F.count_distinct("batch_id") == F.max("batch_id") + 1).alias("gapless"), F.sum("n_accepted").alias("n_accepted"), F.sum("n_rejected").alias("n_rejected"),
        F.min(F.col("first_key").cast("long")).alias("first_key"), F.max(F.col("last_key").cast("long")).alias("last_key"),
    )


def q_stream_progress(spark, sf_dir):
    """What the listener has noted of a load, against its ledger batch by batch."""
    staged, paths, told = work_path(spark, "staged"), load.LoadPaths(work_path(spark, "load")), work_path(spark, "progress")
    events = _events(spark, sf_dir)
    share = _stage(events, staged)
    with progress.recorded(spark, told):
        _load(spark, staged, events.schema, paths, share)
    noted = progress.batches(spark.read.schema(progress.SCHEMA).parquet(told)).select("batch_id", "n_input_rows")
    ledger = load.read_ledger(spark, paths).select("batch_id", (F.col("n_accepted") + F.col("n_rejected")).alias("n_rows"))
    return noted.join(ledger, "batch_id", "full_outer").agg(
        F.sum("n_input_rows").alias("n_read"), F.sum("n_rows").alias("n_written"),
        F.bool_and(F.equal_null("n_input_rows", "n_rows")).alias("agrees"))


CHANGE_COLUMNS = ["user_id", "ts", "event_id", "event_type", "value"]


def _change_stream(spark, sf_dir):
    staged = work_path(spark, "staged")
    feed = table(spark, sf_dir, "events").select(*CHANGE_COLUMNS)
    return load.read_stream(spark, staged, feed.schema, files_per_batch=_stage(feed, staged))


USER, ORDER, DELETED = ["user_id"], ["ts", "event_id"], "event_type = 'error'"


def q_cdc_upsert(spark, sf_dir):
    """Events as changes to one row per user, merged when read; an ``error`` event deletes the row."""
    path = work_path(spark, "users")
    kept.apply_to_table(_change_stream(spark, sf_dir), path, work_path(spark, "checkpoint"), USER, ORDER)
    return kept.table_state(spark, path, USER, ORDER, F.expr(DELETED)).select("user_id", "event_id", "event_type", "value")


def q_cdc_merged(spark, sf_dir):
    """The same with two runs a level and small buckets, so that levels are merged and buckets split; then vacuumed."""
    path = work_path(spark, "users")
    kept.apply_to_table(_change_stream(spark, sf_dir), path, work_path(spark, "checkpoint"), USER, ORDER, fan_in=2, bucket_bytes=32 * 1024)
    kept.vacuum(spark, path)
    return kept.table_state(spark, path, USER, ORDER, F.expr(DELETED)).select("user_id", "event_id", "event_type", "value")


def q_cdc_compacted(spark, sf_dir):
    """The same from a log: half of the changes, a snapshot of them, then the rest; the state reads snapshot and log."""
    staged, log, checkpoint, snapshot = (work_path(spark, n) for n in ("staged", "changes", "checkpoint", "snapshot"))
    feed = table(spark, sf_dir, "events").select(*CHANGE_COLUMNS)
    early = F.col("event_id") % 2 == 0
    for part in (feed.filter(early), feed.filter(~early)):
        stream = load.read_stream(spark, staged, feed.schema, files_per_batch=_stage(part, staged))
        changes.apply_changes(stream, log, checkpoint, ["user_id"], ["ts", "event_id"])
        if not tg.folder_exists(spark, snapshot):
            changes.compact(spark, log, snapshot, ["user_id"], ["ts", "event_id"])
    state = changes.current_state(spark, log, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", snapshot)
    return state.select("user_id", "event_id", "event_type", "value")


def _redelivered(spark, sf_dir):
    """Every event, and all purchases and clicks a second time."""
    events = table(spark, sf_dir, "events").select(*CHANGE_COLUMNS)
    return events, events.filter(F.col("event_type").isin("purchase", "click"))


def q_stream_dedup(spark, sf_dir):
    staged, out = work_path(spark, "staged"), work_path(spark, "deduplicated")
    events, again = _redelivered(spark, sf_dir)
    share = _stage(events, staged) + _stage(again, staged)
    stream = load.read_stream(spark, staged, events.schema, files_per_batch=share)
    unique = changes.deduplicated(stream, "event_id", "ts", "60 days").select("event_id", "user_id", "event_type", "value")
    query = (
        unique.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", work_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def q_stream_append_new(spark, sf_dir):
    staged, out = work_path(spark, "staged"), work_path(spark, "unique")
    events, again = _redelivered(spark, sf_dir)
    share = _stage(events, staged) + _stage(again, staged)
    stream = load.read_stream(spark, staged, events.schema, files_per_batch=share)
    changes.append_new(stream, out, work_path(spark, "checkpoint"), "event_id", ["ts"])
    return changes.stored_rows(spark, out).select("event_id", "user_id", "event_type", "value")


def q_stream_first(spark, sf_dir):
    """The first event of every user, from events that arrive in the order of a hash, purchases and clicks twice."""
    staged, out = work_path(spark, "staged"), work_path(spark, "first")
    events, again = _redelivered(spark, sf_dir)
    files = _files(events)
    events.unionByName(again).repartition(files, F.xxhash64("event_id", "value")).write.parquet(staged)
    stream = load.read_stream(spark, staged, events.schema, files_per_batch=-(-files // BATCHES))
    keyed.keep_first(stream, out, work_path(spark, "checkpoint"), "user_id", ORDER)
    return keyed.first_rows(spark, out, "user_id", ORDER).select("user_id", "event_id", "event_type", "value")


QUERIES = {name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")}

_UNIQUE = "SELECT event_id, user_id, event_type, value FROM events"
_LAST_CHANGE = """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"""
ORACLES = {
    "stream_load": """SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, user_id AS user,
      substring(event_type, 1, 5) AS kind, props FROM events WHERE event_id % 11 <> 0""",
    "ledger": """SELECT 'events' AS index_name, 'completed' AS status, count(*) FILTER (event_id % 11 <> 0) AS migrated,
      count(*) FILTER (event_id % 11 = 0) AS rejected, count(*) AS total,
      round(count(*) FILTER (event_id % 11 <> 0) * 100.0::DOUBLE / count(*), 4) AS progress_pct FROM events""",
    "stream_start_over": """SELECT substring(event_type, 1, 5) AS kind, count(*) AS n_rows, g::INTEGER AS generation
      FROM events, range(2) AS r(g) WHERE event_id % 11 <> 0 GROUP BY 1, 3""",
    "ledger_batches": """SELECT 'events' AS index_name, count(*) > 0 AS gapless, count(*) FILTER (event_id % 11 <> 0) AS n_accepted,
      count(*) FILTER (event_id % 11 = 0) AS n_rejected, min(event_id) FILTER (event_id % 11 <> 0) AS first_key,
      max(event_id) FILTER (event_id % 11 <> 0) AS last_key FROM events""",
    "stream_progress": "SELECT count(*) AS n_read, count(*) AS n_written, true AS agrees FROM events",
    "stream_resume": """SELECT substring(event_type, 1, 5) AS kind, count(*) AS n_rows, count(DISTINCT event_id) AS n_ids,
      CAST(sum(user_id) AS BIGINT) AS user_sum FROM events WHERE event_id % 11 <> 0 GROUP BY 1""",
    "stream_rejects": "SELECT event_id AS id, 'bad value in props' AS reason FROM events WHERE event_id % 11 = 0",
    "cdc_upsert": _LAST_CHANGE,
    "cdc_merged": _LAST_CHANGE,
    "cdc_compacted": _LAST_CHANGE,
    "stream_dedup": _UNIQUE,
    "stream_append_new": _UNIQUE,
    "stream_first": """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
}
