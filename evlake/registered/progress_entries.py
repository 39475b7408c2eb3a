"""Pipeline progress: object listing, offsets, table metrics, sampled history."""

from pyspark.sql import functions as F

from evlake.fixed_values import SCALE_STOPS
from evlake.functions import progress_math as pm
from evlake.operators.offsets import consumer_lag, topic_totals, watermarks
from evlake.plans import progress
from evlake.registered import inputs
from evlake.registered.entries import micros, query
from evlake.registered.oracle_parts import LISTING, MESSAGES, ROWS, SAMPLES
from evlake.sources import objects
from evlake.sources.objects import list_objects

# -- store and topic ----------------------------------------------------------


@query(
    "met1_source_totals",
    f"{LISTING} SELECT count(*) AS objects, CAST(sum(length) AS BIGINT) AS bytes FROM l WHERE path NOT LIKE '%/'",
)
def met1(spark, sf_dir):
    return objects.totals(objects.only_objects(inputs.listing(spark, sf_dir)))


@query(
    "met2_latest_objects",
    f"""{LISTING} SELECT path, length, changed_us AS "modificationTime_us" FROM l WHERE path NOT LIKE '%/'
    ORDER BY changed_us DESC, path DESC LIMIT 6""",
)
def met2(spark, sf_dir):
    latest = objects.latest(objects.only_objects(inputs.listing(spark, sf_dir)))
    return latest.select("path", "length", micros("modificationTime"))


@query(
    "met3_newest_data_file",
    f"{LISTING} SELECT path AS newest_path FROM l WHERE path LIKE '%.parquet' ORDER BY changed_us DESC, path DESC LIMIT 1",
)
def met3(spark, sf_dir):
    return objects.newest(objects.only_objects(inputs.listing(spark, sf_dir), ".parquet"))


_MARKS = f"""WITH {MESSAGES}, w AS (SELECT part, min(off) AS low, max(off) + 1 AS high FROM m GROUP BY part)"""


@query(
    "met4_retained_messages",
    f"""{_MARKS} SELECT CAST(sum(high) AS BIGINT) AS end_offset, CAST(sum(high - low) AS BIGINT) AS retained,
      count(*) AS partitions FROM w""",
)
def met4(spark, sf_dir):
    return topic_totals(watermarks(inputs.messages(spark, sf_dir))).drop("topic")


@query(
    "met5_consumer_lag",
    f"""{ROWS}, w AS (SELECT part, max(off) + 1 AS high FROM m GROUP BY part),
    c AS (SELECT part, max(off) + 1 AS done FROM r WHERE {{}} GROUP BY part)
    SELECT CAST(sum(high) AS BIGINT) AS end_offset, CAST(sum(done) AS BIGINT) AS committed,
      CAST(greatest(0, sum(high) - sum(done)) AS BIGINT) AS lag FROM w LEFT JOIN c USING (part)""".format(
        f"sent_us < {int(inputs.COMMIT_TIMES[1].timestamp() * 1_000_000)}"
    ),
)
def met5(spark, sf_dir):
    """How far the first two commits are behind the topic."""
    marks = watermarks(inputs.messages(spark, sf_dir))
    # What was committed stands in the log; no row of the table is read.
    committed = inputs.table(spark, sf_dir).next_offsets(at=inputs.utc(2024, 1, 25))
    return consumer_lag(marks, committed).select("end_offset", "committed", "lag")


# -- table --------------------------------------------------------------------


@query(
    "met7_table_metrics",
    f"""{ROWS} SELECT count(*) AS table_rows, count(DISTINCT CASE WHEN sent_us < {int(inputs.COMMIT_TIMES[0].timestamp() * 1_000_000)} THEN 0
        WHEN sent_us < {int(inputs.COMMIT_TIMES[1].timestamp() * 1_000_000)} THEN 1 ELSE 2 END) AS table_commits,
      count(*) FILTER (sent_us >= {int(inputs.COMMIT_TIMES[1].timestamp() * 1_000_000)}) AS last_added,
      CAST(3600 AS DOUBLE) AS last_commit_age_s, count(*) > 0 AS table_files FROM r""",
)
def met7(spark, sf_dir):
    table = inputs.table(spark, sf_dir)
    now = inputs.utc(2024, 3, 1, 1)
    found = progress.table_metrics(table.live(), table.history(), now)
    return found.withColumn("table_files", F.col("table_files") > 0)


@query(
    "met8_warehouse_files",
    f"""{ROWS}, d AS (SELECT count(DISTINCT CAST(make_timestamp(sent_us) AS DATE)) AS days,
      count(DISTINCT CASE WHEN sent_us < {int(inputs.COMMIT_TIMES[0].timestamp() * 1_000_000)} THEN 0
        WHEN sent_us < {int(inputs.COMMIT_TIMES[1].timestamp() * 1_000_000)} THEN 1 ELSE 2 END) AS commits FROM r)
    SELECT days AS day_folders, commits AS log_files, days >= 1 AS data_files_match, days >= 1 AS newest_is_parquet FROM d""",
)
def met8(spark, sf_dir):
    """The files found in the table's folder against those its log knows."""
    table = inputs.table(spark, sf_dir)
    listing = list_objects(spark, table.path)
    known = table.live().agg(F.sum("n_files")).head()[0]
    counted = progress.warehouse_counts(listing)
    days = listing.agg(
        F.count_distinct(F.nullif(F.regexp_extract("path", "ingest_time_day=([^/]+)", 1), F.lit(""))).alias("day_folders"),
        F.count_if(F.col("path").rlike(r"/log/\d+\.json$")).alias("log_files"),
    ).head()
    return counted.select(
        F.lit(days.day_folders).alias("day_folders"),
        F.lit(days.log_files).alias("log_files"),
        (F.col("data_files") == known).alias("data_files_match"),
        F.col("newest_data_file").endswith(".parquet").alias("newest_is_parquet"),
    )


@query(
    "met8_records_by_day",
    f"""{ROWS} SELECT CAST(make_timestamp(sent_us) AS DATE) AS day, CAST(count(*) AS BIGINT) AS records,
      count(DISTINCT CASE WHEN sent_us < {int(inputs.COMMIT_TIMES[0].timestamp() * 1_000_000)} THEN 0
        WHEN sent_us < {int(inputs.COMMIT_TIMES[1].timestamp() * 1_000_000)} THEN 1 ELSE 2 END) AS tries FROM r GROUP BY 1""",
)
def met8_days(spark, sf_dir):
    """Per day, what the log says of the files that are really there: their records and
    the commits they came with."""
    table = inputs.table(spark, sf_dir)
    name = F.regexp_extract("path", "(try=[^/]+/.*)$", 1).alias("path")
    there = list_objects(spark, f"{table.path}/data", ".parquet").select(name)
    known = table.live().join(there, "path", "left_semi")
    return known.groupBy("day").agg(
        F.sum("n_rows").alias("records"), F.count_distinct(F.substring_index("path", "/", 1)).alias("tries")
    )


@query(
    "met9_partial_failure",
    f"""{ROWS} SELECT 'demo' AS pipeline, count(*) AS table_rows, (SELECT count(*) FROM m) AS topic_retained,
      CAST(NULL AS BIGINT) AS source_objects, 'source' AS failed FROM r""",
)
def met9(spark, sf_dir):
    """One sample of three stages, one of which cannot be reached."""
    table, messages = inputs.table(spark, sf_dir), inputs.messages(spark, sf_dir)
    topic = topic_totals(watermarks(messages)).withColumnsRenamed(
        {"end_offset": "topic_end", "retained": "topic_retained", "partitions": "topic_partitions"}
    )
    stages = {
        "source": lambda: objects.totals(list_objects(spark, f"{sf_dir}/no-such-folder")),
        "topic": lambda: topic,
        "table": lambda: progress.table_metrics(table.live(), table.history(), inputs.utc(2024, 3, 1)),
    }
    sample = progress.take_sample(spark, "demo", 0.0, stages)
    failed = F.array_join(F.map_keys("errors"), ",").alias("failed")
    return sample.select("pipeline", "table_rows", "topic_retained", "source_objects", failed)


# -- history of samples -------------------------------------------------------

_ON_TOPIC = "coalesce(topic_retained, topic_end)"
_BEHIND = f"CASE WHEN table_rows IS NOT NULL THEN greatest(0, {_ON_TOPIC} - table_rows) END"


def _gaps(spark, sf_dir, *columns):
    return progress.stage_gaps(inputs.samples(spark, sf_dir), 25).select("pipeline", "t", *columns)


@query("met6_topic_count", f"{SAMPLES} SELECT pipeline, t, {_ON_TOPIC} AS on_topic FROM sm")
def met6(spark, sf_dir):
    return _gaps(spark, sf_dir, "on_topic")


@query(
    "met10_stage_gaps",
    f"{SAMPLES} SELECT pipeline, t, greatest(0, source_objects - {_ON_TOPIC}) AS topic_behind, {_BEHIND} AS table_behind FROM sm",
)
def met10(spark, sf_dir):
    return _gaps(spark, sf_dir, "topic_behind", "table_behind")


@query("met11_lag_fallback", f"{SAMPLES} SELECT pipeline, t, coalesce(topic_lag, {_BEHIND}) AS lag FROM sm")
def met11(spark, sf_dir):
    return _gaps(spark, sf_dir, "lag")


@query(
    "met12_rates",
    f"""{SAMPLES}, pr AS (SELECT *, lag(t) OVER o AS t0, lag(source_objects) OVER o AS s0, lag(table_rows) OVER o AS r0
      FROM sm WINDOW o AS (PARTITION BY pipeline ORDER BY t))
    SELECT pipeline, t, CAST(source_objects - s0 AS DOUBLE) / (t - t0) AS source_objects_rate,
      CAST(table_rows - r0 AS DOUBLE) / (t - t0) AS table_rows_rate FROM pr""",
)
def met12(spark, sf_dir):
    rated = progress.rates(inputs.samples(spark, sf_dir), ["source_objects", "table_rows"])
    return rated.select("pipeline", "t", "source_objects_rate", "table_rows_rate")


@query(
    "met13_history_window",
    f"{SAMPLES} SELECT pipeline, t, source_objects FROM sm QUALIFY row_number() OVER (PARTITION BY pipeline ORDER BY t DESC) <= 72",
)
def met13(spark, sf_dir):
    return progress.history_window(inputs.samples(spark, sf_dir)).select("pipeline", "t", "source_objects")


@query(
    "met14_rows_per_file",
    f"{SAMPLES} SELECT pipeline, t, CASE WHEN data_files > 0 THEN CAST(table_rows AS DOUBLE) / data_files END AS rows_per_file FROM sm",
)
def met14(spark, sf_dir):
    return _gaps(spark, sf_dir, "rows_per_file")


@query("met15_buffering", f"{SAMPLES} SELECT pipeline, t, {_BEHIND} > 0 AND {_BEHIND} < 25 AS buffering FROM sm")
def met15(spark, sf_dir):
    return _gaps(spark, sf_dir, "buffering")


@query(
    "met16_levels",
    f"""{SAMPLES}, lw AS (SELECT * FROM sm QUALIFY row_number() OVER (PARTITION BY pipeline ORDER BY t DESC) <= 20),
    mm AS (SELECT *, min(table_rows) OVER (PARTITION BY pipeline) AS lo, max(table_rows) OVER (PARTITION BY pipeline) AS hi FROM lw)
    SELECT pipeline, t, table_rows, CASE WHEN table_rows IS NULL THEN NULL WHEN hi <= lo THEN 4
      ELSE CAST(round_even(CAST(table_rows - lo AS DOUBLE) / (hi - lo) * 7, 0) AS INTEGER) END AS level FROM mm""",
)
def met16(spark, sf_dir):
    """The last 20 table sizes per group on a scale of eight steps."""
    return progress.levels(inputs.samples(spark, sf_dir), "table_rows", 20, 8)


_STOPS = " ".join(f"WHEN v <= {s} THEN {s}" for s in SCALE_STOPS)


@query(
    "met17_nice_scale",
    f"""SELECT event_id, CASE {_STOPS} ELSE CAST(floor(v * 1.05) AS BIGINT) + 1 END AS scale
    FROM (SELECT event_id, CAST(floor(value * 100) AS DOUBLE) * (1 + event_id % 100) AS v FROM events) s""",
)
def met17(spark, sf_dir):
    value = F.expr("cast(floor(value * 100) as double) * (1 + event_id % 100)")
    return inputs.events(spark, sf_dir).select("event_id", pm.axis_top(value).alias("scale"))
