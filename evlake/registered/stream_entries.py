"""Running streams: bounds, copies, progress, stopping, sinks in the tasks."""

import json

from pyspark.sql import functions as F

from evlake.operators.copies import new_rows
from evlake.plans import reconcile
from evlake.registered import inputs
from evlake.registered.entries import query
from evlake.registered.oracle_parts import DAMAGED, MESSAGES, REPLAYED, ROWS, SAMPLES, SHOWN
from evlake.registered.table_entries import _copies, _ingest, _notified, _ONCE, sent
from evlake.registered.topic_entries import COORDINATES
from evlake.session import new_folder
from evlake.sources.listing import list_prefixes, sub_prefixes
from evlake.sources.objects import list_objects
from evlake.sources.topic import FileTopic
from evlake.streaming.content_sink import content_sink, loaded_records
from evlake.streaming.ingest import Sink, payload_sink, shown_payloads, stop_mark
from evlake.streaming.progress_log import read_progress, rows_so_far
from evlake.streaming.sample_stream import kept_history, live_rates
from evlake.streaming.task_sink import JsonFolder, JsonFolderWriter, whole_files

PARTS = 4


def _by_partition(spark, sf_dir, **bounds) -> FileTopic:
    """The topic with one file for each of its partitions, published one after another."""
    made, topic = inputs.notified(spark, sf_dir), FileTopic(new_folder(spark, "topic"), **bounds)
    for part in range(PARTS):
        # Made by all tasks, written by one.
        topic.publish(made.where(F.col("partition") == part).repartition(1))
    return topic


def _files_of(spark, topic: FileTopic) -> list[int]:
    """Bytes of the topic's files, in the order they were published."""
    found = list_objects(spark, topic.path, ".parquet").orderBy("modificationTime").select("length")
    return [r.length for r in found.collect()]


# -- bounds and stopping ------------------------------------------------------


@query(
    "ing1_byte_bound",
    f"{ROWS} SELECT CAST(part // 2 AS INTEGER) AS commit_no, count(*) AS added FROM r GROUP BY 1",
)
def ing1_bytes(spark, sf_dir):
    """Batches bounded in bytes: two of the four files fit into one."""
    topic = _by_partition(spark, sf_dir)
    sizes = _files_of(spark, topic)
    bounded = FileTopic(topic.path, max_bytes=max(sizes[0] + sizes[1], sizes[2] + sizes[3]))
    table = inputs.new_table(spark, "byte-bound")
    _ingest(spark, bounded, table).drain(spark)
    return table.history().select((F.col("batch_id")).cast("int").alias("commit_no"), "added")


@query(
    "ing9_stop_and_resume",
    f"""{ROWS} SELECT count(*) FILTER (part < 2) AS rows_at_stop, true AS batch_left, count(*) AS rows_after,
      CAST(4 AS BIGINT) AS commits FROM r""",
)
def ing9(spark, sf_dir):
    """Asked to stop while its second batch runs, the query ends after it; the next run
    takes up the third."""
    topic, table = _by_partition(spark, sf_dir, max_files=1), inputs.new_table(spark, "stopped")
    mark = new_folder(spark, "stop")

    def ask(rows, decoded, batch_id):
        if batch_id == 1:
            spark.range(1).write.mode("overwrite").parquet(mark)

    job = _ingest(spark, topic, table, sinks=[Sink("ask", ask, required=True)])
    ended = job.run(spark, stop_mark(spark, mark), every=0.2, poll=0.1)
    at_stop = table.row_count().head()[0]
    job.drain(spark)
    done = table.history().agg(F.sum("added").alias("rows_after"), F.count("*").alias("commits"))
    return done.select(
        F.lit(at_stop).cast("long").alias("rows_at_stop"), F.lit(ended.left and ended.batches == 2).alias("batch_left"),
        "rows_after", "commits",
    )


# -- copies -------------------------------------------------------------------


@query("ext1_stream", f"{ROWS} SELECT CAST(1 AS BIGINT) AS copies, count(*) AS keys, true AS late_told FROM r")
def ext1_stream(spark, sf_dir):
    """A topic that delivers a part of its messages again, in the next batch and once
    more when it is too late: every row comes once, and what came too late is told."""
    made = inputs.notified(spark, sf_dir).orderBy("timestamp")
    topic, table = FileTopic(new_folder(spark, "topic"), max_files=1), inputs.new_table(spark, "no-copies")
    half = F.lit(inputs.utc(2024, 1, 16))
    first, second = made.where(sent() < half), made.where(~(sent() < half))
    again = first.where(sent() >= F.lit(inputs.utc(2024, 1, 15)))
    too_late = first.where(sent() < F.lit(inputs.utc(2024, 1, 2)))
    for part in (first, again, second, too_late):
        topic.publish(part.coalesce(1))
    progress = new_folder(spark, "progress")
    job = _ingest(spark, topic, table, within="2 days", progress=progress)
    log = _drained(spark, job)
    dropped = log.groupBy("batch_id").agg(F.max("dropped_late").alias("late"))
    told = dropped.agg(F.sum("late")).head()[0] == too_late.count()
    return _copies(table.read()).withColumn("late_told", F.lit(told))


def _drained(spark, job):
    """Drain a job with a progress folder and read what it says."""
    query_ = job.start(spark, every=None)
    query_.awaitTermination()
    job.progress_log.wait()
    return read_progress(spark, job.progress)


@query("ext1_once_at_write", _ONCE)
def ext1_once(spark, sf_dir):
    """The topic ingested, then delivered again from the start under a new checkpoint:
    the second run adds what the first left out and nothing twice."""
    topic, table = inputs.topic(spark, sf_dir), inputs.new_table(spark, "once")
    some = inputs.rows(spark, sf_dir).where("kafka_partition <> 1 or kafka_offset % 3 = 0")
    table.append(some, "load", 0)
    for _ in range(2):
        _ingest(spark, topic, table, once=True).drain(spark)
    return _copies(table.read())


@query(
    "ext1_new_rows",
    f"{REPLAYED} SELECT {SHOWN} FROM r WHERE bucket = 'bucket-2'",
)
def ext1_new(spark, sf_dir):
    """Rows of a batch, copies among them, that a table without one bucket lacks."""
    known = inputs.table(spark, sf_dir).read().where("bucket is null or bucket <> 'bucket-2'")
    return new_rows(inputs.replayed(spark, sf_dir), known).select(*COORDINATES)


# -- progress -----------------------------------------------------------------


@query(
    "met5_live_progress",
    f"""WITH {MESSAGES}, b AS (SELECT CAST(part AS BIGINT) AS batch_id, count(*) AS input_rows FROM m GROUP BY 1)
    SELECT batch_id, input_rows, CAST(sum(input_rows) OVER (ORDER BY batch_id) AS BIGINT) AS rows_so_far FROM b""",
)
def met5_live(spark, sf_dir):
    """How far a running query is, from its own reports: the topic is not read for it."""
    topic, table = _by_partition(spark, sf_dir, max_files=1), inputs.new_table(spark, "progress")
    job = _ingest(spark, topic, table, progress=new_folder(spark, "progress"))
    return rows_so_far(_drained(spark, job)).select("batch_id", "input_rows", "rows_so_far")


def _streamed_samples(spark, sf_dir) -> str:
    """Rates of the samples, in two runs with a restart in between; the checkpoint."""
    samples = inputs.samples(spark, sf_dir)
    source, out, checkpoint = (new_folder(spark, n) for n in ("samples", "rates", "checkpoint"))
    middle = F.lit(float(inputs.utc(2024, 1, 16).timestamp()))
    for part in (samples.where(F.col("t") < middle), samples.where(F.col("t") >= middle)):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(samples.schema).parquet(source)
        rated = live_rates(stream, ["source_objects", "table_rows"])
        rated.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return out, checkpoint


@query(
    "met12_live_rates",
    f"""{SAMPLES}, pr AS (SELECT *, lag(t) OVER o AS t0, lag(source_objects) OVER o AS s0, lag(table_rows) OVER o AS r0
      FROM sm WINDOW o AS (PARTITION BY pipeline ORDER BY t))
    SELECT pipeline, t, CAST(source_objects - s0 AS DOUBLE) / (t - t0) AS source_objects_rate,
      CAST(table_rows - r0 AS DOUBLE) / (t - t0) AS table_rows_rate FROM pr""",
)
def met12_live(spark, sf_dir):
    out, _ = _streamed_samples(spark, sf_dir)
    return spark.read.parquet(out)


@query(
    "met13_live_history",
    f"{SAMPLES} SELECT pipeline, t, source_objects FROM sm QUALIFY row_number() OVER (PARTITION BY pipeline ORDER BY t DESC) <= 72",
)
def met13_live(spark, sf_dir):
    """The newest samples as the query's state holds them."""
    _, checkpoint = _streamed_samples(spark, sf_dir)
    return kept_history(spark, checkpoint).select("pipeline", "t", "source_objects")


# -- listing, contents, sinks -------------------------------------------------


@query(
    "src5_listing_by_prefix",
    """SELECT 'user-' || (user_id % 40) AS prefix, count(DISTINCT CAST(ts AS DATE)) AS objects, true AS as_listed
    FROM events GROUP BY 1""",
)
def src5_prefixes(spark, sf_dir):
    """A store of many objects listed prefix by prefix in the tasks."""
    store = new_folder(spark, "store")
    made = inputs.events(spark, sf_dir).select(
        F.concat(F.lit("user-"), (F.col("user_id") % 40).cast("string")).alias("prefix"),
        F.col("ts").cast("date").alias("day"), F.col("event_id").cast("string").alias("value"),
    )
    made.repartition("prefix").sortWithinPartitions("prefix", "day").write.partitionBy("prefix", "day").text(store)
    listed = list_prefixes(spark, sub_prefixes(spark, store), ".txt")
    plain = F.regexp_replace("path", "^file:/*", "/")
    other = list_objects(spark, store, ".txt").select(plain.alias("path"), F.col("length").alias("n"))
    both = listed.select(plain.alias("path"), "length").join(other, "path", "full")
    return both.groupBy(F.regexp_extract("path", "prefix=([^/]+)", 1).alias("prefix")).agg(
        F.count("*").alias("objects"), F.bool_and(F.col("length").eqNullSafe(F.col("n"))).alias("as_listed")
    )


@query(
    "ext3_loaded_contents",
    """SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations WHERE role <> 'system'""",
)
def ext3_loaded(spark, sf_dir):
    """Contents loaded with the batches that tell of them; one object is told of in both
    batches, another twice in one, and the second batch is repeated after a failure."""
    store, target = new_folder(spark, "store"), new_folder(spark, "contents")
    chats = inputs.conversations(spark, sf_dir)
    chats.withColumn("by", F.col("role")).write.partitionBy("by").json(f"{store}/chats")
    users, others = F.col("path").contains("by=user"), ~F.col("path").contains("by=system")
    topic, table = FileTopic(new_folder(spark, "topic"), max_files=1), inputs.new_table(spark, "told")
    one = _told(spark, store, users, 0)
    topic.publish(one.unionAll(one.withColumn("partition", F.lit(1))).coalesce(1))
    topic.publish(_told(spark, store, others, 2).coalesce(1))
    tries = []

    def break_once(batch_id):
        tries.append(batch_id)
        if tries.count(1) == 1 and batch_id == 1:
            raise RuntimeError("stopped before the acknowledgement")

    job = _ingest(
        spark, topic, table, sinks=[content_sink(store, store, target, ".json")], before_ack=break_once
    )
    try:
        job.drain(spark)
    except Exception:
        job.drain(spark)
    fields = F.from_json("record", "conv_id bigint, turn bigint, role string, text string")
    read = loaded_records(spark, target).select(fields.alias("r"))
    return read.select("r.conv_id", "r.turn", "r.role", F.md5("r.text").alias("text_md5"))


def _told(spark, store, keep, partition):
    """Messages that tell of the stored objects that pass ``keep``."""
    rows = _notified(spark, store, keep)
    return rows.select(
        F.col("kafka_topic").alias("topic"), F.lit(partition).alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("raw_event").cast("binary").alias("value"), F.col("ingest_time").alias("timestamp"),
    )


class _BreaksOnce(JsonFolderWriter):
    """Fails in one task of its first try."""

    def __init__(self, address: str, mark: str):
        super().__init__(address)
        self.mark = mark

    def write(self, iterator):
        import os

        staged = super().write(iterator)
        if staged.rows and not os.path.exists(self.mark):
            with open(self.mark, "w"):
                pass
            raise OSError("the target closed the connection")
        return staged


class _Unsteady(JsonFolder):
    @classmethod
    def name(cls) -> str:
        return "unsteady_json_folder"

    def streamWriter(self, schema, overwrite):
        return _BreaksOnce(self.options["path"], self.options["mark"])


@query("snk3_task_sink", f"{ROWS} SELECT {SHOWN}, bucket FROM r")
def snk3_tasks(spark, sf_dir):
    """Rows written to a target outside Spark by the tasks. One of them fails, the batch
    is aborted, and its repeat brings every row once."""
    from evlake.operators.decode import decode
    from evlake.operators.flatten import flatten

    spark.dataSource.register(_Unsteady)
    target, mark, checkpoint = (new_folder(spark, n) for n in ("target", "mark", "checkpoint"))

    def run():
        rows = flatten(decode(inputs.topic(spark, sf_dir).stream(spark)), sent()).select(*COORDINATES, "bucket")
        writer = rows.writeStream.format("unsteady_json_folder").option("mark", mark)
        query_ = writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query_.awaitTermination()

    try:
        run()
    except Exception:
        run()
    shape = "kafka_partition int, kafka_offset bigint, record_index int, bucket string"
    return spark.read.schema(shape).json(whole_files(target))


@query(
    "snk1_payload_files",
    f"WITH {MESSAGES} SELECT count(*) AS shown, true AS indented FROM m WHERE shape NOT IN (7, 8, 19)",
)
def snk1_files(spark, sf_dir):
    """Every payload as indented JSON in text files, written by the tasks."""
    out, table = new_folder(spark, "payloads"), inputs.new_table(spark, "payloads")
    _ingest(spark, inputs.topic(spark, sf_dir), table, sinks=[payload_sink(out)]).drain(spark)
    shown = shown_payloads(spark, out)
    # More than one line wherever there is more than one member.
    lines = F.regexp_count("value", F.lit("\n"))
    inner = F.col("value").rlike(r"(?s)^[{\[].*[^{}\[\]\s]")
    return shown.agg(F.count("*").alias("shown"), F.bool_and(~inner | (lines > 0)).alias("indented"))


# -- reconciliation -----------------------------------------------------------

_STRETCH = 500


@query(
    "rec4_differing_stretches",
    f"""{DAMAGED}, e AS (SELECT part, off // {_STRETCH} AS stretch, count(*) AS n FROM r GROUP BY ALL),
    t AS (SELECT part, off // {_STRETCH} AS stretch, count(*) AS n,
          count(*) FILTER (bucket = 'bucket-0') AS twice FROM dm GROUP BY ALL),
    g AS (SELECT part, off // {_STRETCH} AS stretch, count(*) FILTER (bucket IN ('bucket-0', 'bucket-1')) AS hurt FROM r GROUP BY ALL)
    SELECT part AS kafka_partition, stretch, e.n AS expected, coalesce(t.n, 0) AS present
    FROM e LEFT JOIN t USING (part, stretch) JOIN g USING (part, stretch) WHERE g.hurt > 0""",
)
def rec4_stretches(spark, sf_dir):
    """The stretches of offsets a damaged table differs in, from sums of hashes."""
    marks = [reconcile.range_marks(df, _STRETCH) for df in (inputs.rows(spark, sf_dir), inputs.damaged(spark, sf_dir))]
    return reconcile.differing_stretches(*marks).drop("kafka_topic")


@query(
    "rec4_survival_by_stretch",
    f"""{DAMAGED} SELECT 'object-notifications' AS kafka_topic, {SHOWN} FROM r WHERE bucket = 'bucket-1' AND part = 2""",
)
def rec4_by_stretch(spark, sf_dir):
    """Lost rows found where the marks of one damaged partition differ, with the marks
    of both sides kept batch by batch and added up."""
    expected, hurt = inputs.rows(spark, sf_dir), inputs.damaged(spark, sf_dir)
    whole = expected.where("kafka_partition <> 2")
    present = whole.unionAll(hurt.where("kafka_partition = 2"))
    cut = F.lit(inputs.utc(2024, 1, 16))

    def kept(df):
        parts = (df.where(F.col("ingest_time") < cut), df.where(~(F.col("ingest_time") < cut)))
        return reconcile.added_marks(
            reconcile.range_marks(parts[0], _STRETCH).unionAll(reconcile.range_marks(parts[1], _STRETCH))
        )

    balance = reconcile.survival_by_stretch(expected, present, _STRETCH, (kept(expected), kept(present)))
    return balance.where("present < expected").select("kafka_topic", *COORDINATES)
