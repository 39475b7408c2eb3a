"""Ingestion, table lifecycle, table queries, reconciliation."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evlake.functions.uris import same_bucket
from evlake.operators.conform import conform, drift_report
from evlake.operators.copies import copy_counts, drop_copies, duplicates
from evlake.operators.decode import decode
from evlake.operators.flatten import flatten
from evlake.operators.offsets import next_offsets
from evlake.plans import reconcile, table_queries
from evlake.registered import inputs
from evlake.registered.entries import micros, query
from evlake.registered.oracle_parts import DAMAGED, MESSAGES, REPLAYED, ROWS, SHOWN
from evlake.registered.topic_entries import ALL_COLUMNS, COORDINATES, all_columns
from evlake.schema import DAY, EVENTS
from evlake.session import new_folder
from evlake.sources.contents import object_records
from evlake.sources.objects import list_objects
from evlake.sources.topic import FileTopic
from evlake.streaming.ingest import Ingest, Retry, Sink, console_sink, shown_payloads
from evlake.streaming.tables import CommitConflict, ParquetTable


def sent():
    """When a message was sent, which the queries take as its ingestion time."""
    return F.col("timestamp")


_DAY_SQL = "CAST(make_timestamp(sent_us) AS DATE)"


def _ingest(spark, topic, table, **options) -> Ingest:
    return Ingest(topic, table, new_folder(spark, "checkpoint"), ingest_time=sent(), **options)


def _copies(rows):
    """How many keys are present once, twice, ..."""
    return copy_counts(rows).groupBy("copies").agg(F.count("*").alias("keys"))


_ONCE = f"{ROWS} SELECT CAST(1 AS BIGINT) AS copies, count(*) AS keys FROM r"
_TWICE = f"{ROWS} SELECT CAST(2 AS BIGINT) AS copies, count(*) AS keys FROM r"

# -- ingestion ----------------------------------------------------------------


@query("snk2_ingested_table", ALL_COLUMNS)
def snk2(spark, sf_dir):
    """The topic streamed into a table until nothing is left (also ING9)."""
    table = inputs.new_table(spark, "ingested")
    _ingest(spark, inputs.topic(spark, sf_dir), table).drain(spark)
    return all_columns(table.read())


@query(
    "snk3_fan_out",
    f"""WITH {MESSAGES} SELECT 'quarantine' AS target, count(*) AS n_rows FROM m WHERE shape IN (7, 8, 19)
    UNION ALL SELECT 'table', (SELECT count(*) FROM ({ROWS} SELECT * FROM r) q)
    UNION ALL SELECT 'by bucket', (SELECT count(*) FROM ({ROWS} SELECT * FROM r WHERE bucket IS NOT NULL) q)""",
)
def snk3(spark, sf_dir):
    """One stream, four targets; the optional one that fails harms no other."""
    bad, extra = new_folder(spark, "quarantine"), new_folder(spark, "extra")

    def broken(rows, decoded, batch_id):
        raise OSError("unreachable")

    def to_files(rows, decoded, batch_id):
        known = rows.where("bucket is not null")
        known.write.mode("overwrite").parquet(f"{extra}/batch_id={batch_id}")

    sinks = [Sink("broken", broken), Sink("extra", to_files, required=True)]
    table = inputs.new_table(spark, "fan-out")
    _ingest(spark, inputs.topic(spark, sf_dir), table, sinks=sinks, bad=bad).drain(spark)
    found = {"table": table.read(), "quarantine": spark.read.parquet(bad), "by bucket": spark.read.parquet(extra)}
    counts = [df.agg(F.lit(n).alias("target"), F.count("*").alias("n_rows")) for n, df in found.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query(
    "snk1_console",
    f"WITH {MESSAGES} SELECT count(*) AS shown, count(DISTINCT CAST(part AS BIGINT) * 1000000000 + off) AS messages FROM m WHERE shape NOT IN (7, 8, 19)",
)
def snk1(spark, sf_dir):
    """Every payload of a stream shown as indented JSON, here to a file."""
    out, table = new_folder(spark, "shown"), inputs.new_table(spark, "console")
    _ingest(spark, inputs.topic(spark, sf_dir), table, sinks=[console_sink(path=out)]).drain(spark)
    shown = shown_payloads(spark, out).count()
    keys = table.read().select("kafka_partition", "kafka_offset").distinct()
    return keys.agg(F.lit(shown).cast("long").alias("shown"), F.count("*").alias("messages"))


@query(
    "snk4_start_all_or_none",
    f"{ROWS} SELECT count(*) - count(*) AS rows_after_refusal, count(*) AS rows_after_start, 'b,a' AS closed FROM r",
)
def snk4(spark, sf_dir):
    """A sink that cannot be opened closes the others and consumes nothing."""
    table, closed, broken = inputs.new_table(spark, "all-or-none"), [], [True]

    def check():
        if broken:
            raise OSError("unreachable")

    def sink(name, **more):
        return Sink(name, lambda *args: None, close=lambda: closed.append(name), **more)

    sinks = [sink("a"), sink("b"), sink("c", check=check)]
    job = _ingest(spark, inputs.topic(spark, sf_dir), table, sinks=sinks)
    try:
        job.drain(spark)
    except OSError:
        pass
    refused = table.row_count().head()[0]
    order = ",".join(n for n in closed if n in "ab")
    broken.clear()
    job.drain(spark)
    return table.row_count().select(
        F.lit(refused).cast("long").alias("rows_after_refusal"), F.col("n_rows").alias("rows_after_start"),
        F.lit(order).alias("closed"),
    )


@query(
    "ing2_time_bound",
    f"""{ROWS} SELECT CAST(sent_us >= {int(inputs.utc(2024, 1, 16).timestamp() * 1_000_000)} AS INTEGER) AS interval,
      count(*) AS added FROM r GROUP BY 1""",
)
def ing2(spark, sf_dir):
    """What arrives between two ticks of the trigger is one commit; idle ticks make none."""
    made, half = inputs.notified(spark, sf_dir), F.lit(inputs.utc(2024, 1, 16))
    topic, table = FileTopic(new_folder(spark, "topic")), inputs.new_table(spark, "ticks")
    topic.publish(made.where(sent() < half))
    query = _ingest(spark, topic, table).start(spark, every=0.5)
    try:
        query.processAllAvailable()
        topic.publish(made.where(sent() >= half))
        query.processAllAvailable()
    finally:
        query.stop()
    number = (F.row_number().over(Window.orderBy("snapshot_id")) - 1).alias("interval")
    return table.history().select(number, "added")


@query("ing10_check_only", f"{ROWS} SELECT count(*) - count(*) AS rows_after_check, count(*) AS rows_after_run FROM r")
def ing10(spark, sf_dir):
    """A check opens everything and consumes nothing; the run after it takes all."""
    table = inputs.new_table(spark, "checked")
    job = _ingest(spark, inputs.topic(spark, sf_dir), table)
    job.check()
    before = table.row_count().head()[0]
    job.drain(spark)
    return table.row_count().select(F.lit(before).alias("rows_after_check"), F.col("n_rows").alias("rows_after_run"))


@query("src3_resume", _ONCE)
def src3(spark, sf_dir):
    """A second run on the same checkpoint takes up where the first stopped."""
    made = inputs.notified(spark, sf_dir)
    topic, table = FileTopic(new_folder(spark, "topic")), inputs.new_table(spark, "resumed")
    job = _ingest(spark, topic, table)
    half = F.lit(inputs.utc(2024, 1, 16))
    for part in (made.where(sent() < half), made.where(sent() >= half)):
        topic.publish(part)
        job.drain(spark)
    return _copies(table.read())


@query("src4_full_replay", _TWICE)
def src4(spark, sf_dir):
    """Reading the retained topic again appends every row again."""
    table, topic = inputs.new_table(spark, "replayed"), inputs.topic(spark, sf_dir)
    for run in ("first", "second"):
        table.append(flatten(decode(topic.batch(spark)), sent()), run, 0)
    return _copies(table.read())


def _fail_first(error: str):
    tries = []

    def fail(batch_id):
        tries.append(batch_id)
        if len(tries) == 1:
            raise RuntimeError(error)

    return fail


def _run_until_done(spark, job: Ingest) -> None:
    try:
        job.drain(spark)
    except Exception:
        job.drain(spark)


@query("ing6_replay_after_failure", _ONCE)
def ing6(spark, sf_dir):
    """A batch that failed after its write is repeated and replaces itself."""
    table = inputs.new_table(spark, "failed-once")
    crash = _fail_first("stopped before the acknowledgement")
    _run_until_done(spark, _ingest(spark, inputs.topic(spark, sf_dir), table, before_ack=crash))
    return _copies(table.read())


@query("ing11_at_least_once", _TWICE)
def ing11(spark, sf_dir):
    """The same with a commit of its own for every try: copies appear."""
    table = inputs.new_table(spark, "appended-twice")
    crash = _fail_first("stopped before the acknowledgement")
    job = _ingest(spark, inputs.topic(spark, sf_dir), table, before_ack=crash, replace_retried=False)
    _run_until_done(spark, job)
    return _copies(table.read())


@query("ing7_bounded_retry", _ONCE)
def ing7(spark, sf_dir):
    """A write that fails twice succeeds at the third try, within one batch."""
    table, failures = inputs.new_table(spark, "retried"), []
    append = table.append

    def unsteady(*args, **kwargs):
        if len(failures) < 2:
            failures.append(1)
            raise OSError("store not reachable")
        append(*args, **kwargs)

    table.append = unsteady
    retry = Retry(attempts=3, sleep=lambda seconds: None)
    _ingest(spark, inputs.topic(spark, sf_dir), table, retry=retry).drain(spark)
    return _copies(table.read())


@query("ing8_admission_bound", f"{ROWS} SELECT least(4, count(*)) AS commits, count(*) AS n_rows FROM r")
def ing8(spark, sf_dir):
    """Four files on the topic, one admitted per batch: four commits."""
    topic = FileTopic(new_folder(spark, "topic"), max_files=1)
    topic.publish(inputs.notified(spark, sf_dir).repartition(4, "partition", "offset"))
    table = inputs.new_table(spark, "bounded")
    _ingest(spark, topic, table).drain(spark)
    return table.history().agg(F.count("*").alias("commits"), F.sum("added").alias("n_rows"))


@query("ing6_failed_repeat", _ONCE)
def ing6_failed(spark, sf_dir):
    """A stored batch whose repeat breaks off keeps its rows."""
    table, rows = inputs.new_table(spark, "failed-repeat"), inputs.rows(spark, sf_dir)
    table.append(rows, "run", 0)
    broken = ParquetTable(spark, table.path.rsplit("/", 2)[0], table.namespace, table.name)

    def lost(*args):
        raise OSError("store not reachable")

    # Even a repeat that gets as far as writing takes nothing away.
    broken._holds, broken._commit = lambda *args: False, lost
    try:
        broken.append(rows, "run", 0)
    except OSError:
        pass
    table.append(rows, "run", 0)
    return _copies(table.read())


@query("ing5_next_offsets", f"{ROWS} SELECT part AS kafka_partition, max(off) + 1 AS next_offset FROM r GROUP BY part")
def ing5(spark, sf_dir):
    return next_offsets(inputs.rows(spark, sf_dir)).drop("kafka_topic")


# -- table lifecycle ----------------------------------------------------------


@query(
    "tbl1_create_and_fill",
    f"""{ROWS} SELECT CAST(13 AS BIGINT) AS columns, count(*) AS n_rows FROM r""",
)
def tbl1(spark, sf_dir):
    """A table made with the explicit schema, then filled."""
    table = inputs.new_table(spark, "created")
    table.append(inputs.rows(spark, sf_dir), "load", 0)
    return table.read().agg(F.lit(len(table.schema)).cast("long").alias("columns"), F.count("*").alias("n_rows"))


@query("tbl2_day_partitions", f"{ROWS} SELECT {_DAY_SQL} AS ingest_time_day, count(*) AS n_rows FROM r GROUP BY 1")
def tbl2(spark, sf_dir):
    """Rows per day folder."""
    return inputs.table(spark, sf_dir).read(with_day=True).groupBy(DAY).agg(F.count("*").alias("n_rows"))


def _foreign_schema():
    """A table someone else made: two columns short, one of its own."""
    kept = [f for f in EVENTS.fields if f.name not in ("object_etag", "event_source")]
    return type(EVENTS)(kept).add("region", "string")


@query(
    "tbl3_schema_drift",
    f"""{ROWS} SELECT 'event_source' AS "column", 'missing' AS status, count(event_source) AS affected FROM r
    UNION ALL SELECT 'object_etag', 'missing', (SELECT count(object_etag) FROM ({ROWS} SELECT * FROM r) q)
    UNION ALL SELECT 'region', 'extra', (SELECT count(*) FROM ({ROWS} SELECT * FROM r) q)""",
)
def tbl3(spark, sf_dir):
    return drift_report(inputs.table(spark, sf_dir).read(), _foreign_schema())


@query(
    "tbl4_conform",
    f"""{ROWS} SELECT {SHOWN}, event_name, bucket, object_key, object_size, CAST(NULL AS VARCHAR) AS region FROM r""",
)
def tbl4(spark, sf_dir):
    """Rows appended to a table with other columns."""
    table = ParquetTable(spark, new_folder(spark, "foreign"), "lake", "object_events").open(schema=_foreign_schema())
    table.append(inputs.rows(spark, sf_dir), "load", 0)
    return table.read().select(*COORDINATES, "event_name", "bucket", "object_key", "object_size", "region")


@query("tbl5_reset", _ONCE)
def tbl5(spark, sf_dir):
    """Filled, emptied and filled again: every row is there once."""
    table = inputs.new_table(spark, "reset")
    rows = inputs.rows(spark, sf_dir)
    table.append(rows, "first", 0)
    table.reset(confirm=True)
    table.append(rows, "second", 0)
    return _copies(table.read())


@query("tbl5_repeat_after_reset", _ONCE)
def tbl5_repeat(spark, sf_dir):
    """A batch stored, withdrawn by a reset and repeated is there again."""
    table, rows = inputs.new_table(spark, "repeat-after-reset"), inputs.rows(spark, sf_dir)
    table.append(rows, "run", 0)
    table.reset(confirm=True)
    table.append(rows, "run", 0)
    return _copies(table.read())


@query("src6_table_load", f"{ROWS} SELECT count(*) AS n_rows, count(DISTINCT {_DAY_SQL}) AS days FROM r")
def src6(spark, sf_dir):
    """The existing table opened by name, without creating anything."""
    known = inputs.table(spark, sf_dir)
    warehouse = known.path.rsplit("/", 2)[0]
    loaded = ParquetTable(spark, warehouse, known.namespace, known.name).open(create=False)
    days = loaded.read(with_day=True).groupBy(DAY).agg(F.count("*").alias("n"))
    return days.agg(F.sum("n").alias("n_rows"), F.count("*").alias("days"))


# -- table queries ------------------------------------------------------------


@query("qry1_row_count", f"{ROWS} SELECT count(*) AS n_rows FROM r")
def qry1(spark, sf_dir):
    return inputs.table(spark, sf_dir).row_count()


@query(
    "qry2_latest_events",
    f"""{ROWS} SELECT sent_us AS ingest_time_us, event_name, bucket, object_key, object_size FROM r
    ORDER BY sent_us DESC, off DESC, part DESC, record_index DESC LIMIT 20""",
)
def qry2(spark, sf_dir):
    latest = table_queries.latest_events(inputs.table(spark, sf_dir).read())
    return latest.select(micros("ingest_time"), "event_name", "bucket", "object_key", "object_size")


@query(
    "qry3_duplicates",
    f"""{REPLAYED} SELECT 'object-notifications' AS kafka_topic, {SHOWN}, count(*) AS copies FROM rp
    GROUP BY part, off, record_index HAVING count(*) > 1""",
)
def qry3(spark, sf_dir):
    return duplicates(inputs.replayed(spark, sf_dir))


@query(
    "qry4_rows_by_region",
    f"""{ROWS} SELECT CASE WHEN shape IN (0, 6, 14, 15, 16, 20, 21, 22, 23) THEN region END AS region,
    count(*) AS n_rows FROM r GROUP BY 1""",
)
def qry4(spark, sf_dir):
    rows = inputs.table(spark, sf_dir).read()
    return table_queries.count_by_path(rows, "$.Records[0].awsRegion", "region")


_FILLED = ["ingest_time", "kafka_topic", "kafka_partition", "kafka_offset", "record_index", "raw_event"]
_AUDITED = {
    **{c: "count(*) - count(*)" for c in _FILLED},
    "event_time": "count(*) - count(event_time_us)",
    **{c: f"count(*) - count({c})" for c in (
        "event_name", "event_source", "bucket", "object_key", "object_size", "object_etag")},
}


@query(
    "qry5_null_audit",
    f"{ROWS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({sql} AS BIGINT) AS nulls FROM r" for c, sql in _AUDITED.items()
    ),
)
def qry5(spark, sf_dir):
    return table_queries.null_audit(inputs.table(spark, sf_dir).read())


# Periods of the three commits as (end in microseconds, batch).
_ENDS = [int(t.timestamp() * 1_000_000) for t in inputs.COMMIT_TIMES]
_BATCH_SQL = f"CASE WHEN sent_us < {_ENDS[0]} THEN 0 WHEN sent_us < {_ENDS[1]} THEN 1 ELSE 2 END"


@query(
    "qry6_commit_history",
    f"""{ROWS} SELECT CAST({_BATCH_SQL} AS BIGINT) AS batch_id,
      CASE {_BATCH_SQL} WHEN 0 THEN {_ENDS[0]} WHEN 1 THEN {_ENDS[1]} ELSE {_ENDS[2]} END AS committed_at_us,
      'append' AS operation, count(*) AS added FROM r GROUP BY 1, 2""",
)
def qry6(spark, sf_dir):
    return inputs.table(spark, sf_dir).history().select("batch_id", micros("committed_at"), "operation", "added")


@query("qry7_commit_count", f"{ROWS} SELECT count(DISTINCT {_BATCH_SQL}) AS commits FROM r")
def qry7(spark, sf_dir):
    return inputs.table(spark, sf_dir).history().agg(F.count("*").alias("commits"))


@query(
    "qry8_data_files",
    f"""{ROWS} SELECT {_DAY_SQL} AS ingest_time_day, CAST(count(*) AS BIGINT) AS record_count,
      count(DISTINCT {_BATCH_SQL}) AS commits, true AS in_day_folder, true AS one_path_each FROM r GROUP BY 1""",
)
def qry8(spark, sf_dir):
    """Records and paths of the data files, added up per day folder."""
    table = inputs.table(spark, sf_dir)
    in_folder = F.col("file_path").contains(F.concat(F.lit(f"/{DAY}="), F.col(DAY).cast("string"), F.lit("/")))
    tries = F.regexp_extract("file_path", "/try=([^/]+)/", 1)
    return table.files().groupBy(DAY).agg(
        F.sum("record_count").alias("record_count"),
        F.count_distinct(tries).alias("commits"),
        F.bool_and(in_folder).alias("in_day_folder"),
        (F.count_distinct("file_path") == F.count("*")).alias("one_path_each"),
    )


@query("qry9_manifest_count", f"{ROWS} SELECT count(DISTINCT {_BATCH_SQL}) AS manifests FROM r")
def qry9(spark, sf_dir):
    """One file of the log per commit."""
    return inputs.table(spark, sf_dir).manifests().agg(F.count("*").alias("manifests"))


@query(
    "qry10_as_of_version",
    f"""{ROWS} SELECT CAST(b AS BIGINT) AS batch_id, count(*) AS n_rows
    FROM r, (VALUES (0), (1), (2)) AS v(b) WHERE {_BATCH_SQL} <= b GROUP BY 1""",
)
def qry10(spark, sf_dir):
    """The table as it was after each of its commits."""
    table = inputs.table(spark, sf_dir)
    counts = [
        table.row_count(version=c.snapshot_id).select(F.lit(c.batch_id).alias("batch_id"), "n_rows")
        for c in table.history().collect()
    ]
    return reduce(DataFrame.unionAll, counts)


@query("qry11_as_of_time", f"{ROWS} SELECT count(*) AS n_rows FROM r WHERE {_BATCH_SQL} <= 1")
def qry11(spark, sf_dir):
    return inputs.table(spark, sf_dir).row_count(at=inputs.utc(2024, 1, 25))


@query(
    "qry12_layout",
    f"{ROWS} SELECT count(DISTINCT {_DAY_SQL}) AS days, true AS in_day_folders, true AS in_warehouse, true AS parquet FROM r",
)
def qry12(spark, sf_dir):
    """Data files lie in day folders inside the warehouse."""
    table = inputs.table(spark, sf_dir)
    path = F.regexp_replace("file_path", "^file:/*", "/")
    return table.files().agg(
        F.count_distinct(DAY).alias("days"),
        F.bool_and(path.contains(f"{DAY}=")).alias("in_day_folders"),
        F.bool_and(path.startswith(table.path)).alias("in_warehouse"),
        F.bool_and(path.endswith(".parquet")).alias("parquet"),
    )


_FROM, _TO = "2024-01-05 06:00:00", "2024-01-07 12:00:00"


@query(
    "qry_ingested_between",
    f"""{ROWS} SELECT {_DAY_SQL} AS ingest_time_day, count(*) AS n_rows FROM r
    WHERE make_timestamp(sent_us) >= TIMESTAMP '{_FROM}' AND make_timestamp(sent_us) < TIMESTAMP '{_TO}' GROUP BY 1""",
)
def qry_between(spark, sf_dir):
    """Rows of a period; only the day folders it touches are read."""
    days = tuple(table_queries.moment(t).date() for t in (_FROM, _TO))
    rows = inputs.table(spark, sf_dir).read(with_day=True, days=days)
    return table_queries.between(rows, _FROM, _TO).groupBy(DAY).agg(F.count("*").alias("n_rows"))


# -- reconciliation -----------------------------------------------------------


@query(
    "rec1_exact_growth",
    f"""{ROWS} SELECT count(*) FILTER ({_BATCH_SQL} < 2) AS rows_before, count(*) AS rows_after,
      count(*) FILTER ({_BATCH_SQL} = 2) AS expected, count(*) FILTER ({_BATCH_SQL} = 2) AS gained, true AS exact FROM r""",
)
def rec1(spark, sf_dir):
    table = inputs.table(spark, sf_dir)
    published = inputs.rows(spark, sf_dir).where(F.col("ingest_time") >= F.lit(inputs.COMMIT_TIMES[1]))
    return reconcile.growth(table.read(at=inputs.utc(2024, 1, 25)), table.read(), published)


@query(
    "rec2_batching",
    f"""{ROWS} SELECT CAST(1 AS BIGINT) AS new_commits, count(*) FILTER ({_BATCH_SQL} = 2) AS rows_gained, true AS batched FROM r""",
)
def rec2(spark, sf_dir):
    table, since = inputs.table(spark, sf_dir), F.lit(inputs.COMMIT_TIMES[1])
    history = table.history()
    gained = table.read().where(F.col("ingest_time") >= since)
    return reconcile.batching_holds(history.where(F.col("committed_at") <= since), history, gained)


@query(
    "rec3_nothing_during_outage",
    f"{ROWS} SELECT count(*) AS rows_before, count(*) AS rows_after, true AS unchanged FROM r",
)
def rec3(spark, sf_dir):
    """A write that breaks off before its commit leaves no visible row."""
    table, rows = inputs.new_table(spark, "outage"), inputs.rows(spark, sf_dir)
    table.append(rows, "before", 0)
    before = table.read()

    def lost(*args):
        raise OSError("catalog not reachable")

    table._commit = lost
    try:
        table.append(rows, "during", 0)
    except OSError:
        pass
    grown = reconcile.growth(before, table.read(), rows.limit(0))
    return grown.select("rows_before", "rows_after", F.col("exact").alias("unchanged"))


_KEYS = "part, off, record_index"


@query(
    "rec4_survival",
    f"""{DAMAGED}, e AS (SELECT {_KEYS}, count(*) AS n FROM r GROUP BY ALL),
    t AS (SELECT {_KEYS}, count(*) AS n FROM dm GROUP BY ALL)
    SELECT CAST(sum(e.n) AS BIGINT) AS published, count(*) FILTER (t.n IS NULL) AS lost,
      CAST(sum(coalesce(t.n, 0) - e.n) FILTER (t.n > e.n) AS BIGINT) AS surplus, false AS all_survived
    FROM e LEFT JOIN t USING ({_KEYS})""",
)
def rec4(spark, sf_dir):
    """Lost rows and copies against a table that has both."""
    return reconcile.survival(inputs.rows(spark, sf_dir), inputs.damaged(spark, sf_dir))


@query(
    "rec4_lost_rows",
    f"{DAMAGED} SELECT 'object-notifications' AS kafka_topic, {SHOWN} FROM r WHERE bucket = 'bucket-1'",
)
def rec4_lost(spark, sf_dir):
    return reconcile.lost_rows(inputs.rows(spark, sf_dir), inputs.damaged(spark, sf_dir))


@query(
    "rec5_acknowledged",
    f"""{ROWS}, d AS (SELECT part, max(off) + 1 AS committed FROM r GROUP BY part),
    a AS (SELECT part, max(off) + 1 AS published FROM m GROUP BY part)
    SELECT part AS partition, published, committed, published = committed AS complete FROM a JOIN d USING (part)""",
)
def rec5(spark, sf_dir):
    done = reconcile.acknowledged(inputs.messages(spark, sf_dir), inputs.table(spark, sf_dir).next_offsets())
    return done.drop("topic")


@query("rec6_separate_buckets", "SELECT event_id, user_id % 7 = event_id % 7 AS feeds_itself FROM events")
def rec6(spark, sf_dir):
    """Would a warehouse address lie in the watched bucket?"""
    watched, warehouse = F.expr("'s3://b-' || (user_id % 7) || '/in'"), F.expr("'s3a://b-' || (event_id % 7) || '/wh'")
    return inputs.events(spark, sf_dir).select("event_id", same_bucket(watched, warehouse).alias("feeds_itself"))


# -- extensions ---------------------------------------------------------------


@query("ext1_one_row_per_key", f"{ROWS} SELECT {SHOWN}, bucket, object_key FROM r")
def ext1(spark, sf_dir):
    """The replayed table without its copies."""
    return drop_copies(inputs.replayed(spark, sf_dir)).select(*COORDINATES, "bucket", "object_key")


@query(
    "ext2_compaction",
    f"""{ROWS} SELECT {_DAY_SQL} AS ingest_time_day, count(*) AS n_rows,
      CASE WHEN {_DAY_SQL} = DATE '2024-01-03' THEN true END AS one_file FROM r GROUP BY 1""",
)
def ext2(spark, sf_dir):
    """Two loads of half the rows each, one day then rewritten into one file."""
    table = _halves(spark, sf_dir, "compacted")
    day = dt.date(2024, 1, 3)
    table.compact(day, 1)
    files = table.files().groupBy(DAY).agg(F.sum("record_count").alias("n_rows"), F.count("*").alias("files"))
    return files.select(
        DAY, "n_rows", F.when(F.col(DAY) == F.lit(day), F.col("files") == 1).alias("one_file")
    )


@query("ext2_overlapping_compactions", _ONCE)
def ext2_overlap(spark, sf_dir):
    """Of two compactions of the same files the second one is refused."""
    table, rows = _halves(spark, sf_dir, "overlapping"), table_of(spark)
    commit = table._commit

    def after_another(*args):
        table._commit = commit
        rows(table).compact()
        commit(*args)

    table._commit = after_another
    _refused(table.compact)
    return _copies(table.read())


@query("ext2_reset_during_compaction", f"{ROWS} SELECT count(*) - count(*) AS n_rows FROM r")
def ext2_reset(spark, sf_dir):
    """A reset that lands during a compaction stands."""
    table, other = _halves(spark, sf_dir, "reset-meanwhile"), table_of(spark)
    commit = table._commit

    def after_reset(*args):
        table._commit = commit
        other(table).reset(confirm=True)
        commit(*args)

    table._commit = after_reset
    _refused(table.compact)
    return table.row_count()


def _halves(spark, sf_dir, name) -> ParquetTable:
    table, rows = inputs.new_table(spark, name), inputs.rows(spark, sf_dir)
    table.append(rows.where("kafka_partition < 2"), "load", 0)
    table.append(rows.where("kafka_partition >= 2"), "load", 1)
    return table


def table_of(spark):
    """The same table as another job would open it."""
    return lambda t: ParquetTable(spark, t.path.rsplit("/", 2)[0], t.namespace, t.name)


def _refused(action) -> None:
    try:
        action()
    except CommitConflict:
        return
    raise AssertionError("the second commit must be refused")


def _notified(spark, store, keep, suffix=".json"):
    """Table rows for notifications about the objects below ``store`` that pass ``keep``."""
    found = list_objects(spark, store, suffix).where(keep)
    key = F.substring_index("path", "/chats/", -1)
    value = F.concat(
        F.lit('{"Records":[{"eventName":"s3:ObjectCreated:Put","s3":{"bucket":{"name":"chats"},"object":{"key":"'),
        F.url_encode(key), F.lit('"}}}]}'),
    )
    messages = found.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.xxhash64("path").alias("offset"),
        value.cast("binary").alias("value"), F.col("modificationTime").alias("timestamp"),
    )
    return flatten(decode(messages), sent())


@query("ext3_csv", "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents WHERE strlen(text) > 0")
def ext3_csv(spark, sf_dir):
    """Documents stored as CSV objects whose columns come in a different order by source."""
    store, docs = new_folder(spark, "store"), inputs.documents(spark, sf_dir)
    coded = docs.select("doc_id", "lang", "source", F.base64(F.col("text").cast("binary")).alias("text"))
    odd = F.xxhash64("source") % 2 == 0
    for part, columns in ((odd, ["doc_id", "lang", "source", "text"]), (~odd, ["text", "source", "doc_id", "lang"])):
        rows = coded.where(part).select(*columns).withColumn("by", F.lit(columns[0]))
        rows.write.mode("append").partitionBy("by").option("header", "true").csv(f"{store}/chats")
    rows = _notified(spark, store, F.lit(True), ".csv")
    records = object_records(spark, rows, store, store, ".csv").where("bad is null")
    fields = F.from_json("record", "doc_id string, lang string, source string, text string")
    read = records.select(fields.alias("r")).select("r.*")
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.md5(F.unbase64("text")).alias("text_md5"))


@query("ext3_json_documents", "SELECT role, count(*) AS turns, count(DISTINCT conv_id) AS conversations FROM conversations GROUP BY role")
def ext3_documents(spark, sf_dir):
    """The turns of each role stored as one document over many lines."""
    store, chats = new_folder(spark, "store"), inputs.conversations(spark, sf_dir)
    said = F.concat(F.lit('{"role": "'), F.col("role"), F.lit('",\n"turns": [\n'),
                    F.array_join(F.collect_list(F.to_json(F.struct("conv_id", "turn"))), ",\n"), F.lit("\n]}"))
    whole = chats.groupBy("role").agg(said.alias("value")).repartition("role")
    # A file of a few lines each, as Spark's text writer puts them.
    whole.select("value", F.col("role").alias("by")).write.partitionBy("by").text(f"{store}/chats")
    rows = _notified(spark, store, F.lit(True), ".txt")
    records = object_records(spark, rows, store, store, ".txt")
    fields = F.from_json("record", "role string, turns array<struct<conv_id: bigint>>")
    read = records.select(fields.alias("r")).select("r.role", F.explode("r.turns.conv_id").alias("conv_id"))
    return read.groupBy("role").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("conversations"))


@query("ext3_parquet", "SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN source END AS source FROM documents")
def ext3_parquet(spark, sf_dir):
    """Documents stored as Parquet objects, half of them with a column more."""
    store, docs = new_folder(spark, "store"), inputs.documents(spark, sf_dir)
    for even, columns in ((True, ["doc_id", "lang", "source"]), (False, ["doc_id", "lang"])):
        docs.where((F.col("doc_id") % 2 == 0) == F.lit(even)).select(*columns).write.mode("append").parquet(f"{store}/chats")
    rows = _notified(spark, store, F.lit(True), ".parquet")
    records = object_records(spark, rows, store, store, ".parquet")
    fields = F.from_json("record", "doc_id bigint, lang string, source string")
    return records.select(fields.alias("r")).select("r.*")


@query(
    "ext3_object_contents",
    "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations WHERE role <> 'system'",
)
def ext3(spark, sf_dir):
    """Conversations stored as JSON objects, those read that an event told of (twice)."""
    store = new_folder(spark, "store")
    chats = inputs.conversations(spark, sf_dir)
    chats.withColumn("by", F.col("role")).write.partitionBy("by").json(f"{store}/chats")
    rows = _notified(spark, store, ~F.col("path").contains("by=system"))
    records = object_records(spark, rows.unionAll(rows), store, store, ".json")
    fields = F.from_json("record", "conv_id bigint, turn bigint, role string, text string")
    return records.select(fields.alias("r")).select("r.conv_id", "r.turn", "r.role", F.md5("r.text").alias("text_md5"))
