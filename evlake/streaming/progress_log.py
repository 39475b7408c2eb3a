"""What a running query tells of its batches, kept as a table.

Spark reports, after each batch, where every topic partition stood before and after it
and where the topic ended. A listener writes that report, one file a batch, into a
folder; reading the folder gives lag, position and end of every topic partition without
reading the topic or the data. Topics whose source tells no offsets per partition (files
do not) have one row a batch with the source's own position.
"""

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LOG = logging.getLogger("evlake.progress")

#: One row per batch, source and topic partition.
PROGRESS = (
    "query_id string, run_id string, batch_id long, at timestamp, source string, topic string, partition int,"
    " start_offset long, end_offset long, latest_offset long, input_rows long, dropped_late long, dropped_copies long"
)


def _offsets(value) -> dict[tuple[str | None, int | None], int]:
    """Offsets by topic and partition from a source's report, if it has any."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return {}
    if isinstance(value, int):
        return {(None, None): value}
    if not isinstance(value, dict):
        return {}
    found = {}
    for name, inner in value.items():
        if isinstance(inner, dict):
            found.update({(name, int(p)): o for p, o in inner.items() if isinstance(o, int)})
        elif isinstance(inner, int):
            found[None, None] = inner
    return found


def progress_rows(report: dict) -> list[dict]:
    """The rows of one report, as Spark gives it in JSON."""
    states = report.get("stateOperators") or []
    head = {
        "query_id": report["id"], "run_id": report["runId"], "batch_id": report["batchId"], "at": report["timestamp"],
        "dropped_late": sum(s.get("numRowsDroppedByWatermark") or 0 for s in states),
        "dropped_copies": sum((s.get("customMetrics") or {}).get("numDroppedDuplicateRows") or 0 for s in states),
    }
    rows = []
    for source in report.get("sources") or []:
        start, end, latest = (_offsets(source.get(k)) for k in ("startOffset", "endOffset", "latestOffset"))
        places = sorted({*start, *end, *latest}, key=str) or [(None, None)]
        for topic, partition in places:
            at = (topic, partition)
            rows.append({
                **head, "source": source["description"], "topic": topic, "partition": partition,
                "start_offset": start.get(at), "end_offset": end.get(at), "latest_offset": latest.get(at),
                # Told of the source as a whole: counted once.
                "input_rows": source["numInputRows"] if at == places[0] else 0,
            })
    return rows


class ProgressLog(StreamingQueryListener):
    """Writes the reports of one query below ``path``, a file per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._run_id: str | None = None
        self._ended = threading.Event()
        self._early: list = []
        self._lock = threading.Lock()

    def attach(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def follow(self, query) -> None:
        """Keep the reports of this query and no other, those already given included."""
        with self._lock:
            self._run_id = str(query.runId)
            early, self._early = self._early, []
        for event in early:
            self._take(event)

    def wait(self, seconds: float = 30) -> bool:
        """Wait until the query has ended and its last report is written."""
        return self._ended.wait(seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._take(event)

    def onQueryTerminated(self, event) -> None:
        self._take(event)

    def _take(self, event) -> None:
        with self._lock:
            if self._run_id is None:
                self._early.append(event)
                return
        try:
            if hasattr(event, "progress"):
                report = json.loads(event.progress.json)
                if report["runId"] == self._run_id and report.get("numInputRows"):
                    self._write(report)
            elif str(event.runId) == self._run_id:
                self.spark.streams.removeListener(self)
                self._ended.set()
        except Exception:
            # A lost report must not disturb the query.
            LOG.exception("a batch's progress was not kept")

    def _write(self, report: dict) -> None:
        fs = self.spark._jvm.org.apache.hadoop.fs
        target = fs.Path(f"{self.path}/{report['runId']}-{report['batchId']:012d}.json")
        text = "".join(json.dumps(row) + "\n" for row in progress_rows(report))
        out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(text.encode()))
        out.close()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path)


def latest_progress(progress: DataFrame) -> DataFrame:
    """The newest row of each query, source and topic partition. One partial aggregate;
    the folder's rows are few."""
    place = ["query_id", "source", "topic", "partition"]
    newest = F.max_by(F.struct("batch_id", "at", "start_offset", "end_offset", "latest_offset"), F.struct("batch_id", "at"))
    return progress.groupBy(*place).agg(newest.alias("last"), F.sum("input_rows").alias("rows_in_all")).select(
        *place, "last.*", "rows_in_all"
    )


def live_marks(progress: DataFrame) -> DataFrame:
    """Per topic partition: how far the query is, where the topic ends and the lag, as
    of its last batch. The columns are those of the offset operators."""
    newest = latest_progress(progress).where("topic is not null")
    return newest.select(
        "topic", "partition", F.col("end_offset").alias("committed"), F.col("latest_offset").alias("high"),
        F.greatest(F.lit(0), F.col("latest_offset") - F.col("end_offset")).alias("lag"),
    )


def live_lag(progress: DataFrame) -> DataFrame:
    """End offset, committed total, lag and partitions of each topic."""
    return live_marks(progress).groupBy("topic").agg(
        F.sum("high").alias("end_offset"), F.sum("committed").alias("committed"), F.sum("lag").alias("lag"),
        F.count("*").alias("partitions"),
    )


def rows_so_far(progress: DataFrame) -> DataFrame:
    """Messages of every batch and of all up to it, per query."""
    batches = progress.groupBy("query_id", "batch_id").agg(F.sum("input_rows").alias("input_rows"))
    upto = Window.partitionBy("query_id").orderBy("batch_id")
    return batches.withColumn("rows_so_far", F.sum("input_rows").over(upto))
