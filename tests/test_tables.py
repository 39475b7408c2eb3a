"""Table lifecycle: create, adopt, append, travel, compact, reset."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.operators.conform import drift_report
from evlake.plans import table_queries
from evlake.schema import EVENTS
from evlake.streaming.tables import CommitConflict, ParquetTable, TableMissing, check_name

DAYS = [dt.datetime(2026, 1, d, 12) for d in (1, 2, 3)]


def at(day, minute=0):
    return dt.datetime(2026, 2, day, 0, minute, tzinfo=dt.timezone.utc)


@pytest.fixture
def table(spark, tmp_path):
    return ParquetTable(spark, str(tmp_path / "wh"), "ns", "events").open()


def rows(spark, start, n):
    data = spark.range(start, start + n).select(
        F.element_at(F.array(*[F.lit(d) for d in DAYS]), (F.col("id") % 3 + 1).cast("int")).alias("ingest_time"),
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"),
        F.lit(0).alias("record_index"), F.lit("{}").alias("raw_event"),
    )
    return data


def test_create_and_schema(spark, table):
    assert table.exists() and table.read().count() == 0 and table.history().count() == 0
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in EVENTS]
    assert table.read().schema.fieldNames() == EVENTS.fieldNames()
    assert table.drift() == {"missing": [], "extra": []}


def test_missing_table_is_an_error_when_not_to_be_created(spark, tmp_path):
    with pytest.raises(TableMissing):
        ParquetTable(spark, str(tmp_path), "ns", "none").open(create=False)


def test_unreachable_store_is_not_a_missing_table(spark):
    with pytest.raises(Exception) as e:
        ParquetTable(spark, "nosuchscheme://x", "ns", "t").open()
    assert not isinstance(e.value, TableMissing)


def test_history_and_time_travel(spark, table):
    table.append(rows(spark, 0, 25), "r", 0, at(1))
    table.append(rows(spark, 25, 15), "r", 1, at(1, 5))
    history = table.history().collect()
    assert [(h.added, h.operation) for h in history] == [(25, "append"), (15, "append")]
    assert table.read(version=history[0].snapshot_id).count() == 25
    assert table.read(version=history[1].snapshot_id).count() == 40
    assert [table.read(at=t).count() for t in (at(1) - dt.timedelta(1), at(1), at(1, 4), at(1, 5))] == [0, 25, 25, 40]
    with pytest.raises(ValueError):
        table.read(version=3)
    assert table.files().agg(F.sum("record_count")).head()[0] == 40
    assert table.manifests().count() == 2


def test_repeated_batch_is_stored_once(spark, table):
    table.append(rows(spark, 0, 25), "r", 0)
    table.append(rows(spark, 0, 25), "r", 0)
    assert table.read().count() == 25 and table.history().count() == 1


def test_failed_repeat_takes_nothing_away(spark, table, monkeypatch):
    table.append(rows(spark, 0, 25), "r", 0)
    before = table.read()

    def lost(*args):
        raise OSError("down")

    monkeypatch.setattr(table, "_holds", lambda *args: False)
    monkeypatch.setattr(table.commits, "create", lost)
    with pytest.raises(OSError):
        table.append(rows(spark, 0, 25), "r", 0)
    assert table.read().count() == 25 and before.count() == 25


def test_repeat_after_reset_and_after_compaction(spark, table):
    table.append(rows(spark, 0, 3), "r", 0)
    table.reset(confirm=True)
    table.append(rows(spark, 0, 3), "r", 0)
    assert table.read().count() == 3
    table.append(rows(spark, 3, 3), "r", 1)
    table.compact()
    table.append(rows(spark, 0, 3), "r", 0)
    assert sorted(r.kafka_offset for r in table.read().collect()) == list(range(6))


@pytest.mark.parametrize("meanwhile,left", [("compact", 30), ("reset", 0)])
def test_conflicting_withdrawals_are_refused(spark, table, meanwhile, left):
    table.append(rows(spark, 0, 15), "r", 0)
    table.append(rows(spark, 15, 15), "r", 1)
    other, commit = ParquetTable(spark, table.path.rsplit("/", 2)[0], "ns", "events"), table._commit

    def late(*args):
        other.compact() if meanwhile == "compact" else other.reset(confirm=True)
        commit(*args)

    table._commit = late
    with pytest.raises(CommitConflict):
        table.compact()
    assert table.read().count() == left


def test_two_writers_take_different_numbers(spark, table, monkeypatch):
    other, last = ParquetTable(spark, table.path.rsplit("/", 2)[0], "ns", "events"), table.commits.last

    def stale():
        monkeypatch.undo()
        other.append(rows(spark, 5, 5), "other", 0)
        return 0

    monkeypatch.setattr(table.commits, "last", stale)
    table.append(rows(spark, 0, 5), "r", 0)
    assert last() == 2 and table.read().count() == 10
    assert table.row_count().head()[0] == 10


def test_folded_log(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path), "ns", "folded", fold_every=2).open()
    for i in range(5):
        table.append(rows(spark, 3 * i, 3), "r", i, at(i + 1))
    assert table.commits.last_fold() == 4 and table.commits.numbers() == [3, 4, 5]
    assert table.read().count() == 15 and table.read(version=3).count() == 9 and table.history().count() == 5
    table.append(rows(spark, 0, 3), "r", 0)
    assert table.row_count().head()[0] == 15


def test_every_version_of_a_folded_log(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path), "ns", "versions", fold_every=3).open()
    for i in range(10):
        table.append(rows(spark, i, 1), "r", i, at(i + 1))
    assert table.commits.last_fold() == 9 and table.commits.numbers() == [7, 8, 9, 10]
    for version in range(1, 11):
        assert table.commits.read(version).agg(F.max("snapshot_id")).head()[0] == version
        assert table.read(version=version).count() == version


def test_empty_table(spark, table):
    assert table.files().count() == 0 and table.manifests().count() == 0 and table.row_count().head()[0] == 0
    table.reset(confirm=True)
    assert table.read().count() == 0 and table.next_offsets().count() == 0


def test_offsets_and_commit_time_come_from_the_log(spark, table):
    started = dt.datetime.now(dt.timezone.utc)
    table.append(rows(spark, 0, 7), "r", 0)
    assert [tuple(r) for r in table.next_offsets().collect()] == [("t", 0, 7)]
    assert table.history().head().committed_at.astimezone(dt.timezone.utc) >= started


def test_read_is_one_scan_of_live_folders(spark, table):
    table.append(rows(spark, 0, 9), "gone", 0)
    table.reset(confirm=True)
    table.append(rows(spark, 9, 9), "r", 0)
    table.append(rows(spark, 18, 9), "r", 1)
    read = table.read()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    live = {r.path.split("/")[0] for r in table.live().collect()}
    assert {f.split("/try=")[1].split("/")[0] for f in read.inputFiles()} == {x.split("=")[1] for x in live}
    assert len(live) == 2


def test_uncommitted_data_is_invisible(spark, table):
    table.append(rows(spark, 0, 5), "r", 0)
    rows(spark, 5, 5).withColumn("ingest_time_day", F.lit("2026-01-01")).write.partitionBy("ingest_time_day").parquet(
        f"{table.path}/data/try=broken"
    )
    assert table.read().count() == 5


def test_empty_batch_makes_no_commit(spark, table):
    table.append(rows(spark, 0, 0), "r", 0)
    assert table.read().count() == 0 and table.history().count() == 0


def test_compaction_keeps_rows_and_versions(spark, table):
    table.append(rows(spark, 0, 30).repartition(3), "r", 0, at(1))
    table.append(rows(spark, 30, 30).repartition(3), "r", 1, at(2))
    before = {r.kafka_offset for r in table.read().collect()}
    table.compact(DAYS[0].date(), 1, at(3))
    assert [r.kafka_offset for r in table.read().orderBy("kafka_offset").collect()] == sorted(before)
    assert table.files().where(F.col("ingest_time_day") == F.lit(DAYS[0].date())).count() == 1
    assert table.read(at=at(1)).count() == 30 and table.read(at=at(2)).count() == 60
    table.append(rows(spark, 60, 3), "r", 2, at(4))
    assert table.read().count() == 63
    assert [h.operation for h in table.history().collect()] == ["append", "append", "replace", "append"]


def test_a_commit_during_compaction_survives(spark, table):
    table.append(rows(spark, 0, 30), "r", 0, at(1))
    commit = table._commit

    def late(*args):
        table._commit = commit
        table.append(rows(spark, 30, 3), "r", 1, at(2))
        commit(*args)

    table._commit = late
    table.compact(DAYS[0].date(), 1, at(3))
    assert table.read().count() == 33


def test_reset(spark, table):
    table.append(rows(spark, 0, 5), "r", 0, at(1))
    assert table.reset() is False and table.read().count() == 5
    assert table.reset(confirm=True) is True and table.read().count() == 0
    assert table.read(at=at(1)).count() == 5
    table.append(rows(spark, 0, 4), "r", 1)
    assert table.read().count() == 4
    table.reset(confirm=True)
    assert table.read().count() == 0


@pytest.mark.parametrize("namespace,name", [("", "t"), ("default", "t"), ("system", "t"), ("*", "t"), ("a b", "t"), ("ns", ""), ("ns", "*"), ("ns", "a;b")])
def test_reset_refuses_names(namespace, name):
    with pytest.raises(ValueError):
        check_name(namespace, name)


def test_foreign_schema_wins(spark, tmp_path):
    own = T.StructType([f for f in EVENTS.fields if f.name != "raw_event"]).add("region", "string")
    table = ParquetTable(spark, str(tmp_path), "ns", "foreign").open(schema=own)
    assert table.drift() == {"missing": ["raw_event"], "extra": ["region"]}
    table.append(rows(spark, 0, 6), "r", 0)
    stored = table.read()
    assert stored.columns == own.fieldNames() and stored.where("region is null").count() == 6
    report = {(r.column, r.status): r.affected for r in drift_report(rows(spark, 0, 6), own).collect()}
    assert report[("raw_event", "missing")] == 6 and report[("region", "extra")] == 6


def test_period_reads_only_its_day_folders(spark, table):
    table.append(rows(spark, 0, 30), "r", 0)
    day = DAYS[1].date()
    some = table_queries.between(
        table.read(with_day=True, days=(day, day)), "2026-01-02 00:00:00", "2026-01-02 23:59:59"
    )
    assert some.count() == 10
    assert all("ingest_time_day=2026-01-02" in f for f in some.inputFiles())


@pytest.mark.parametrize("zone", ["+00:00", "+02:00", "-05:00", "+14:00"])
def test_period_with_a_zone(spark, table, zone):
    table.append(rows(spark, 0, 9), "r", 0)
    hours = dt.datetime.fromisoformat("2026-01-01T00:00:00" + zone).utcoffset()
    start, end = ((DAYS[1] + hours + dt.timedelta(hours=h)).isoformat(" ") + zone for h in (-1, 1))
    counts = {table_queries.between(table.read(with_day=d), start, end).count() for d in (True, False)}
    assert counts == {3}
