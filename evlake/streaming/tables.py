"""The object-event table: created with an explicit schema, partitioned by
ingestion day, appended to one commit at a time, readable as of any commit.

``ParquetTable`` needs nothing but a folder. Every try of a write has a data folder of
its own, and becomes visible with one new file of the commit log
(:mod:`evlake.streaming.commits`), which names its files. A try that fails leaves
nothing visible and takes nothing away. A batch that is in the table already is not
stored again; a commit that withdraws files fails if another withdrew them first.
Readers open exactly the files the log lists. ``IcebergTable`` hands the same calls to
an Iceberg catalog, whose connector has to be on the class path.
"""

import datetime as dt
import logging
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.fixed_values import PROTECTED_NAMESPACES
from evlake.operators.conform import conform, schema_drift
from evlake.schema import DAY, EVENTS, utc_day
from evlake.streaming.commits import FOLD_EVERY, CommitLog, moment

LOG = logging.getLogger("evlake.tables")

#: Bytes a compacted file is to have.
TARGET_BYTES = 256 * 1024 * 1024

_OFFSETS = ["kafka_topic", "kafka_partition", "kafka_offset"]


class CommitConflict(RuntimeError):
    """Files to be withdrawn are no longer part of the table."""


class TableMissing(RuntimeError):
    """The table does not exist and was not to be created."""


def check_name(namespace: str, table: str) -> None:
    """Refuse names a reset must never touch."""
    plain = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_-]*")
    if namespace in PROTECTED_NAMESPACES or not plain.fullmatch(namespace):
        raise ValueError(f"refusing to reset a table in namespace {namespace!r}")
    if not plain.fullmatch(table):
        raise ValueError(f"refusing to reset table {table!r}")


class ParquetTable:
    def __init__(self, spark: SparkSession, warehouse: str, namespace: str, name: str, fold_every: int = FOLD_EVERY):
        self.spark, self.namespace, self.name = spark, namespace, name
        self.path = f"{warehouse.rstrip('/')}/{namespace}/{name}"
        self.commits = CommitLog(spark, f"{self.path}/metadata", fold_every)

    # -- lifecycle ----------------------------------------------------------

    def _stored_schema(self) -> T.StructType | None:
        try:
            return self.spark.read.parquet(f"{self.path}/metadata/schema").schema
        except AnalysisException as e:
            # Anything but "not there" (an unreachable store, say) is an error.
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def exists(self) -> bool:
        return self._stored_schema() is not None

    def open(self, create: bool = True, schema: T.StructType = EVENTS) -> "ParquetTable":
        """Use the existing table, else create it, else raise."""
        if not self.exists():
            if not create:
                raise TableMissing(f"table {self.namespace}.{self.name} does not exist")
            empty = self.spark.createDataFrame([], schema).coalesce(1)
            empty.write.mode("overwrite").parquet(f"{self.path}/metadata/schema")
        return self

    @property
    def schema(self) -> T.StructType:
        """The table's own schema; it wins over what a writer brings."""
        stored = self._stored_schema()
        if stored is None:
            raise TableMissing(f"table {self.namespace}.{self.name} does not exist")
        return stored

    def drift(self) -> dict[str, list[str]]:
        return schema_drift(self.schema)

    def reset(self, confirm: bool = False) -> bool:
        """Empty the table. Without ``confirm`` nothing happens. Earlier versions
        stay readable; no file is deleted."""
        check_name(self.namespace, self.name)
        if confirm:
            # Whatever is live when the number is free goes, so this cannot conflict.
            self._commit(f"reset-{uuid.uuid4().hex}", 0, "delete", [], lambda: self._paths(self.live()))
        return confirm

    # -- writing ------------------------------------------------------------

    def append(
        self,
        rows: DataFrame,
        run_id: str,
        batch_id: int,
        committed_at: dt.datetime | None = None,
        gather_days: bool = False,
    ) -> None:
        """Write one commit. A (run, batch) whose rows are in the table is not stored
        again, compacted or not; after a reset it is.

        Rows are written where they are. For a load spanning many days
        ``gather_days`` brings each day together first, so that not every task
        writes a file per day; adaptive execution splits a day that is too big.
        """
        if self._holds(run_id, batch_id):
            LOG.info("batch %s/%d is in the table already", run_id, batch_id)
            return
        files, offsets = self._write(rows, gather_days)
        self._commit(run_id, batch_id, "append", files, None, offsets, committed_at)

    def _write(self, rows: DataFrame, gather_days: bool = False) -> tuple[list[dict], list[dict]]:
        """Data files of a new try, and the next offset of each topic partition."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/try={name}"
        dated = conform(rows, self.schema).withColumn(DAY, utc_day(F.col("ingest_time")))
        if gather_days and self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
            dated = dated.hint("rebalance", DAY)
        dated.write.partitionBy(DAY).parquet(folder)
        # Counts and offsets in one look at what was written.
        fields = {f.name: f for f in self.schema.fields}
        placed = set(_OFFSETS) <= set(fields)
        known = [fields[c] for c in _OFFSETS] if placed else []
        written = self.spark.read.schema(T.StructType([*known, T.StructField(DAY, T.DateType())])).parquet(folder)
        place = F.substring_index("_metadata.file_path", f"/try={name}/", -1)
        end = (F.max("kafka_offset") + 1 if placed else F.lit(None)).cast("long")
        counted = written.groupBy(place.alias("path"), F.col(DAY).alias("day"), *(_OFFSETS[:2] if placed else ())).agg(
            F.count("*").alias("n_rows"), F.first("_metadata.file_size").alias("n_bytes"), end.alias("next_offset")
        )
        files: dict[str, dict] = {}
        ends: dict[tuple, int] = {}
        for r in counted.collect():  # a row per file and topic partition in it
            file = files.setdefault(r.path, {"path": f"try={name}/{r.path}", "day": str(r.day), "n_rows": 0, "n_bytes": r.n_bytes})
            file["n_rows"] += r.n_rows
            if r.next_offset is not None:
                at = (r.kafka_topic, r.kafka_partition)
                ends[at] = max(ends.get(at, 0), r.next_offset)
        return list(files.values()), [dict(zip((*_OFFSETS[:2], "next_offset"), (*at, n), strict=True)) for at, n in ends.items()]

    def _paths(self, live: DataFrame) -> list[tuple[str, str, int, int]]:
        return [tuple(r) for r in live.select("path", F.col("day").cast("string"), "n_rows", "n_bytes").collect()]

    def _holds(self, run_id: str, batch_id: int) -> bool:
        """Whether the batch was stored and not emptied since."""
        known = self.commits.read().where("action = 'commit'")
        own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
        stored, emptied = known.agg(
            F.max(F.when(own, F.col("snapshot_id"))),
            F.max(F.when(F.col("operation") == "delete", F.col("snapshot_id"))),
        ).head()
        return stored is not None and (emptied is None or emptied < stored)

    def _commit(self, run_id, batch_id, operation, files, withdrawn=None, offsets=(), committed_at=None) -> None:
        """Make the next free number of the log this commit.

        ``withdrawn`` gives the files to withdraw, asked again for every number tried.
        """
        if operation != "delete" and not files:
            return
        number = self.commits.last()
        while True:
            number += 1
            gone = withdrawn() if withdrawn else []
            before = self.commits.read().agg(F.max("committed_at")).head()[0]
            # When it lands, and never before the commit it follows.
            now = dt.datetime.now(dt.timezone.utc)
            if before is not None:
                now = max(now, before.astimezone(dt.timezone.utc))
            head = {
                "snapshot_id": number, "committed_at": moment(committed_at or now), "operation": operation,
                "run_id": run_id, "batch_id": batch_id,
            }
            rows = [{**head, "action": "commit", "next_offsets": list(offsets)}]
            rows += [{**head, "action": "add", **f} for f in files]
            names = ("path", "day", "n_rows", "n_bytes")
            rows += [{**head, "action": "remove", **dict(zip(names, g, strict=True))} for g in gone]
            if self.commits.create(number, rows):
                break
            if operation == "append" and self._holds(run_id, batch_id):
                return
        if number % self.commits.fold_every == 0:
            self.commits.fold(number)

    def compact(
        self,
        day: dt.date | None = None,
        files: int | None = None,
        committed_at: dt.datetime | None = None,
        target_bytes: int = TARGET_BYTES,
    ) -> None:
        """Rewrite one day, or all days with more than one file, into files of about
        ``target_bytes``, or one day into ``files`` files.

        A commit that lands meanwhile is not touched: exactly the files read here are
        withdrawn, in the same commit that adds the new ones. If another commit
        withdrew one of them first, nothing changes and :class:`CommitConflict` is
        raised.
        """
        old = self.live()
        if day is not None:
            old = old.where(F.col("day") == F.lit(day))
        else:
            many = old.groupBy("day").agg(F.count("*").alias("n")).where("n > 1")
            old = old.join(many, "day", "left_semi")
        taken = self._paths(old)
        if not taken:
            return
        rows = self._open([t[0] for t in taken]).drop("try")
        if files is None:
            parts = {}
            for _, of_day, _, size in taken:
                parts[of_day] = parts.get(of_day, 0) + size
            split = [F.lit(x) for d, size in sorted(parts.items()) for x in (d, -(-size // target_bytes))]
            n = F.element_at(F.create_map(*split), F.col(DAY).cast("string"))
            # A hash of the row deals it out, so a repeated task deals it the same way.
            deal = F.pmod(F.xxhash64(*[c for c in rows.columns if c != DAY]), n).alias("deal")
            total = sum(-(-size // target_bytes) for size in parts.values())
            rows = rows.withColumn("deal", deal).repartition(total, DAY, "deal").drop("deal")
        else:
            rows = rows.repartition(files)
        made, _ = self._write(rows.drop(DAY))

        def still_there():
            live = {r[0] for r in self._paths(self.live())}
            if not {t[0] for t in taken} <= live:
                raise CommitConflict("another commit withdrew files of this compaction")
            return taken

        self._commit(f"compaction-{uuid.uuid4().hex}", 0, "replace", made, still_there, (), committed_at)

    # -- reading ------------------------------------------------------------

    def ledger(self) -> DataFrame:
        return self.commits.read()

    def live(self, version: int | None = None, at: dt.datetime | None = None) -> DataFrame:
        """Files in force now, after the commit ``version``, or at the time ``at``."""
        known = self.commits.read(version)
        if at is not None:
            known = known.where(F.col("committed_at") <= F.lit(at))
        gone = known.where("action = 'remove'").select("path")
        files = known.where("action = 'add'").join(gone, "path", "left_anti")
        return files.withColumn("n_files", F.lit(1).cast("long"))

    def _open(self, paths: list[str]) -> DataFrame:
        """The rows of the given files, days included."""
        fields = [f for f in self.schema.fields if f.name != DAY]
        shape = T.StructType(fields + [T.StructField("try", T.StringType()), T.StructField(DAY, T.DateType())])
        if not paths:
            return self.spark.createDataFrame([], shape)
        data = f"{self.path}/data"
        # Files of a folder come and go together, so naming the folders is enough and
        # keeps the list short.
        folders = sorted({p.rpartition("/")[0] for p in paths})
        reader = self.spark.read.schema(shape).option("basePath", data)
        return reader.parquet(*[f"{data}/{f}" for f in folders])

    def read(
        self,
        version: int | None = None,
        at: dt.datetime | None = None,
        with_day: bool = False,
        days: tuple[dt.date, dt.date] | None = None,
    ) -> DataFrame:
        """The table now, after the commit ``version``, or as of the time ``at``; with
        ``days`` only the files of these days, first to last."""
        if version is not None and self.history().where(F.col("snapshot_id") == version).isEmpty():
            raise ValueError(f"no commit {version}")
        files = self.live(version, at)
        if days is not None:
            files = files.where(F.col("day").between(F.lit(days[0]), F.lit(days[1])))
        rows = self._open([r.path for r in files.select("path").collect()]).drop("try")
        return rows if with_day else rows.drop(DAY)

    def row_count(self, version: int | None = None, at: dt.datetime | None = None) -> DataFrame:
        """The number of rows, from the log alone."""
        return self.live(version, at).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))

    def next_offsets(self, at: dt.datetime | None = None) -> DataFrame:
        """Offset to resume from per topic partition, from the log alone."""
        known = self.commits.read().where("action = 'commit'")
        if at is not None:
            known = known.where(F.col("committed_at") <= F.lit(at))
        each = known.select(F.inline("next_offsets"))
        return each.groupBy("kafka_topic", "kafka_partition").agg(F.max("next_offset").alias("next_offset"))

    def history(self) -> DataFrame:
        """One row per commit with the rows and files it added and the table's rows
        after it."""
        added, removed = F.col("action") == "add", F.col("action") == "remove"
        known = self.commits.read().groupBy("snapshot_id", "committed_at", "operation", "run_id", "batch_id")
        commits = known.agg(
            F.coalesce(F.sum(F.when(added, F.col("n_rows"))), F.lit(0)).alias("added"),
            F.coalesce(F.sum(F.when(removed, F.col("n_rows"))), F.lit(0)).alias("withdrawn"),
            F.count_if(added).alias("added_files"),
        )
        return commits.orderBy("snapshot_id")

    def files(self) -> DataFrame:
        """Path, day, rows and bytes of every live data file, from the log alone."""
        path = F.concat(F.lit(f"{self.path}/data/"), F.col("path"))
        return self.live().select(
            path.alias("file_path"), F.col("day").alias(DAY), F.col("n_rows").alias("record_count"), "n_bytes"
        )

    def manifests(self) -> DataFrame:
        """The commits of the log, this table's counterpart of a manifest list."""
        return self.commits.read().groupBy("snapshot_id").agg(F.count("*").alias("entries"))


class IcebergTable:
    """The same table in an Iceberg catalog; every call is one Spark statement."""

    def __init__(self, spark: SparkSession, catalog: str, namespace: str, name: str):
        self.spark, self.namespace, self.name = spark, namespace, name
        self.catalog, self.identifier = catalog, f"{catalog}.{namespace}.{name}"

    def create_statements(self) -> list[str]:
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in EVENTS.fields
        )
        return [
            f"CREATE NAMESPACE IF NOT EXISTS {self.catalog}.{self.namespace}",
            f"CREATE TABLE IF NOT EXISTS {self.identifier} ({columns}) "
            "USING iceberg PARTITIONED BY (days(ingest_time))",
        ]

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.identifier)

    def open(self, create: bool = True) -> "IcebergTable":
        if not self.exists():
            if not create:
                raise TableMissing(f"table {self.identifier} does not exist")
            for statement in self.create_statements():
                self.spark.sql(statement)
        return self

    @property
    def schema(self) -> T.StructType:
        return self.spark.table(self.identifier).schema

    def drift(self) -> dict[str, list[str]]:
        return schema_drift(self.schema)

    def reset(self, confirm: bool = False) -> bool:
        check_name(self.namespace, self.name)
        if confirm:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.identifier}")
            self.open()
        return confirm

    def append(self, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """One snapshot, marked with its batch; a batch already there is not repeated."""
        self.spark.catalog.refreshTable(self.identifier)
        mark = f"{run_id}/{batch_id}"
        known = self.spark.table(f"{self.identifier}.snapshots")
        if not known.where(F.col("summary")["evlake.batch"] == mark).isEmpty():
            return
        writer = conform(rows, self.schema).writeTo(self.identifier)
        writer.option("snapshot-property.evlake.batch", mark).append()

    def read(self, version: int | None = None, at: dt.datetime | None = None) -> DataFrame:
        reader = self.spark.read
        if version is not None:
            reader = reader.option("snapshot-id", version)
        if at is not None:
            reader = reader.option("as-of-timestamp", int(at.timestamp() * 1000))
        return reader.table(self.identifier)

    def history(self) -> DataFrame:
        return self.spark.table(f"{self.identifier}.snapshots").selectExpr(
            "snapshot_id", "committed_at", "operation", "cast(summary['added-records'] as bigint) AS added"
        ).orderBy("committed_at")

    def files(self) -> DataFrame:
        return self.spark.table(f"{self.identifier}.files").select("file_path", "record_count")

    def manifests(self) -> DataFrame:
        return self.spark.table(f"{self.identifier}.manifests")

    def compact(self) -> None:
        self.spark.sql(f"CALL {self.catalog}.system.rewrite_data_files('{self.namespace}.{self.name}')")
