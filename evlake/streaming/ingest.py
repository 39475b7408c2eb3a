"""Continuous ingestion: topic -> decode -> flatten -> table, batch by batch.

Spark tracks the offsets. A batch counts as done only after
:meth:`Ingest.process` returned, so nothing is acknowledged before it is stored;
a failed batch is repeated with the same number and stored once.
"""

import json
import logging
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from evlake import fixed_values as fixed
from evlake.functions.uris import masked
from evlake.operators.copies import MESSAGE_KEY, drop_copies_streaming, new_rows
from evlake.operators.decode import counted, decode, quarantine
from evlake.operators.flatten import flatten
from evlake.plans.reconcile import separate_buckets
from evlake.streaming.progress_log import ProgressLog

LOG = logging.getLogger("evlake.ingest")

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Retry:
    """Bounded retry: the wait doubles from ``base`` up to ``cap`` seconds."""

    attempts: int = fixed.MAX_WRITE_ATTEMPTS
    base: float = fixed.RETRY_BASE_SECONDS
    cap: float = fixed.RETRY_CAP_SECONDS
    sleep: Callable[[float], None] = time.sleep

    def wait_after(self, failures: int) -> float:
        return min(self.base * 2 ** (failures - 1), self.cap)

    def run(self, action: Callable[[], None], what: str) -> None:
        for failures in range(1, self.attempts + 1):
            try:
                return action()
            except Exception as e:
                if failures == self.attempts:
                    raise
                wait = self.wait_after(failures)
                LOG.error("%s failed (try %d of %d), next in %.0f s: %s",
                          what, failures, self.attempts, wait, masked(str(e)))
                self.sleep(wait)


@dataclass(frozen=True)
class Sink:
    """A further target for each batch.

    ``write(rows, decoded, batch_id)`` gets the table rows and the decoded
    messages. The failure of a required sink stops the query; that of any other
    is logged. ``check`` runs before the query starts and may raise, ``close``
    undoes it.
    """

    name: str
    write: Callable[[DataFrame, DataFrame, int], None]
    required: bool = False
    check: Callable[[], None] | None = None
    close: Callable[[], None] | None = None


def console_sink(
    n: int | None = None, show: Callable[[str], None] = print, path: str | None = None
) -> Sink:
    """Shows the payloads of each batch as indented JSON, all or the first ``n``.

    With ``path`` they are shown in text files there, as :func:`payload_sink` writes
    them, by the tasks and required. Without it they pass the driver one partition at a
    time; for looking at small topics.
    """

    def write(rows: DataFrame, decoded: DataFrame, batch_id: int) -> None:
        payloads = indented(decoded.where("is_json"))
        if n is not None:
            payloads = payloads.limit(n)
        if path is not None:
            _write_payloads(payloads, path, batch_id)
            return
        for (text,) in payloads.toLocalIterator():
            show(text + "\n")

    return Sink("console", write, required=path is not None)


def indented(decoded: DataFrame) -> DataFrame:
    """Each payload as JSON over several lines, in the column ``value``."""

    def pretty(batches):
        for batch in batches:
            texts = [json.dumps(json.loads(raw), indent=2) for raw in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    return decoded.select("raw").mapInArrow(pretty, "value string")


def payload_sink(path: str) -> Sink:
    """Every payload as indented JSON in text files, written by the tasks into a folder
    per run and batch; a blank line follows each."""

    def write(rows: DataFrame, decoded: DataFrame, batch_id: int) -> None:
        _write_payloads(indented(decoded.where("is_json")), path, batch_id)

    return Sink("payloads", write, required=True)


def _write_payloads(shown: DataFrame, path: str, batch_id: int) -> None:
    target = f"{path}/run_id={query_id(shown.sparkSession)}/batch_id={batch_id}"
    shown.write.mode("overwrite").option("lineSep", "\n\n").text(target)


def shown_payloads(spark: SparkSession, path: str) -> DataFrame:
    """What the sinks above have written below ``path``, a row per payload: indented JSON
    has no blank line inside."""
    return spark.read.option("lineSep", "\n\n").text(f"{path}/*/*").where("value <> ''")


def quarantine_sink(path: str) -> Sink:
    """Keeps messages that give no row, in a folder per run and batch, and logs how
    many there were and where. A repeated batch replaces its own folder only."""

    def write(rows: DataFrame, decoded: DataFrame, batch_id: int) -> None:
        seen = Observation(f"decoded-{batch_id}")
        target = f"{path}/run_id={query_id(decoded.sparkSession)}/batch_id={batch_id}"
        quarantine(counted(decoded, seen)).write.mode("overwrite").parquet(target)
        found = seen.get
        if found["no_payload"] or found["not_json"]:
            first, last = ("{topic}[{partition}]@{offset}".format(**found[k].asDict()) for k in ("first", "last"))
            LOG.warning(
                "batch %d: %d of %d messages give no row (%d without payload, %d not JSON), %s to %s, kept in %s",
                batch_id, found["no_payload"] + found["not_json"], found["messages"], found["no_payload"],
                found["not_json"], first, last, masked(target),
            )

    return Sink("quarantine", write, required=True)


class StopRequested(RuntimeError):
    """The query was asked to stop; this batch was not begun."""


@dataclass(frozen=True)
class Stopped:
    """How a run ended: batches it finished, and whether one that was planned is left
    for the next run."""

    batches: int
    left: bool


def stop_mark(spark: SparkSession, path: str) -> Callable[[], bool]:
    """Asks to stop as long as something lies at ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return lambda: files.exists(target)


def query_id(spark: SparkSession) -> str:
    """The id Spark keeps in the checkpoint: a new checkpoint starts again at batch 0
    and must not meet the batches of an earlier one."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("this must run inside a streaming query")
    return query


@dataclass
class Ingest:
    """A topic-to-table job.

    ``replace_retried=False`` gives every try of a batch its own commit: a crash
    between the append and its acknowledgement then leaves copies in the table.
    ``bad`` is where messages go that give no row, by default beside the checkpoint;
    ``bad=None`` drops them. ``watched`` is the address whose events the topic tells
    of: a table in the same bucket is refused, because it would feed itself.

    Copies: ``within`` ("10 minutes") leaves out messages delivered again within that
    time, by a state that ends with the watermark (later messages are dropped and
    counted). ``once`` leaves out rows whose keys the table has, whenever they came, by
    reading the part of it that the batch's offsets fall into.

    ``progress`` is a folder that gets a file per batch with what Spark knows of it, see
    :mod:`evlake.streaming.progress_log`.
    """

    topic: object
    table: object
    checkpoint: str
    sinks: Sequence[Sink] = ()
    retry: Retry = field(default_factory=Retry)
    ingest_time: Column | None = None
    epoch_event_time: bool = False
    create_table: bool = True
    replace_retried: bool = True
    before_ack: Callable[[int], None] | None = None
    bad: str | None = ""
    watched: str | None = None
    within: str | None = None
    once: bool = False
    progress: str | None = None

    def __post_init__(self):
        self._stopping = threading.Event()
        self._finished = 0
        self.progress_log: ProgressLog | None = None
        if self.bad == "":
            self.bad = f"{self.checkpoint.rstrip('/')}-quarantine"
        if self.bad is not None:
            self.sinks = [quarantine_sink(self.bad), *self.sinks]

    def check(self) -> dict[str, list[str]]:
        """Open the table and every sink without consuming anything; returns the
        differences between the table's columns and the written ones."""
        opened = []
        if self.watched is not None:
            separate_buckets(self.watched, getattr(self.table, "path", ""))
        try:
            self.table.open(create=self.create_table)
            for sink in self.sinks:
                if sink.check:
                    sink.check()
                opened.append(sink)
        except Exception:
            for sink in reversed(opened):
                if sink.close:
                    sink.close()
            raise
        drift = self.table.drift()
        if drift["missing"]:
            LOG.warning("table lacks columns, their values are lost: %s", drift["missing"])
        if drift["extra"]:
            LOG.warning("table has columns never written: %s", drift["extra"])
        return drift

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """Store one batch. Raises when the table or a required sink gave up."""
        if self._stopping.is_set():
            raise StopRequested(f"batch {batch_id} is left for the next run")
        decoded = decode(messages)
        if self.sinks:
            # Read and parsed once for all targets.
            decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = flatten(decoded, self.ingest_time, self.epoch_event_time)
            run_id = self._run_id(messages.sparkSession)
            stored = new_rows(rows, self.table.read()) if self.once else rows
            self.retry.run(lambda: self.table.append(stored, run_id, batch_id), "append")
            for sink in self.sinks:
                self._feed(sink, rows, decoded, batch_id)
            if self.before_ack:
                self.before_ack(batch_id)
            self._finished += 1
        finally:
            if self.sinks:
                decoded.unpersist()

    def _feed(self, sink: Sink, rows: DataFrame, decoded: DataFrame, batch_id: int) -> None:
        if sink.required:
            # Like the table: a hiccup is no reason to stop.
            self.retry.run(lambda: sink.write(rows, decoded, batch_id), f"sink '{sink.name}'")
            return
        try:
            sink.write(rows, decoded, batch_id)
        except Exception as e:
            LOG.error("sink '%s' failed on batch %d: %s", sink.name, batch_id, masked(str(e)))

    def _run_id(self, spark: SparkSession) -> str:
        query = query_id(spark)
        return query if self.replace_retried else f"{query}-{time.time_ns()}"

    def start(self, spark: SparkSession, every: float | None = fixed.FLUSH_INTERVAL_SECONDS):
        """Start the query; ``every=None`` takes what is there and stops."""
        self.check()
        self._stopping.clear()
        self._finished = 0
        trigger = {"availableNow": True} if every is None else {"processingTime": f"{every} seconds"}
        messages = self.topic.stream(spark)
        if self.within:
            # Keys of a long time do not fit the heap.
            spark.conf.set(_STATE_STORE, _ROCKSDB)
            messages = drop_copies_streaming(messages, self.within, "timestamp", MESSAGE_KEY)
        log = self.progress_log = ProgressLog(spark, self.progress).attach() if self.progress else None
        query = (
            messages.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .start()
        )
        if log:
            log.follow(query)
        return query

    def drain(self, spark: SparkSession) -> None:
        """Ingest everything available, then stop; raises if a batch stayed unwritten."""
        self.start(spark, every=None).awaitTermination()

    def run(
        self,
        spark: SparkSession,
        stop: Callable[[], bool],
        every: float | None = fixed.FLUSH_INTERVAL_SECONDS,
        poll: float = 1.0,
    ) -> Stopped:
        """Ingest until ``stop()`` says so (see :func:`stop_mark`). The batch at hand is
        finished and acknowledged; one planned after it is left, whole, for the next run."""
        query = self.start(spark, every)
        try:
            while not query.awaitTermination(poll):
                if not stop():
                    continue
                # From here on no batch begins: a busy query ends at its next batch, an
                # idle one is ended.
                self._stopping.set()
                while query.isActive and query.status["isTriggerActive"]:
                    query.awaitTermination(poll / 10)
                query.stop()
                break
            error = query.exception()
        except StreamingQueryException as e:
            error = e
        if error is not None and StopRequested.__name__ not in str(error):
            raise error
        return Stopped(self._finished, error is not None)
