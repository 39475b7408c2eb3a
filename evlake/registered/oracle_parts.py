"""Building blocks of the check SQL.

The expected rows are stated per payload shape straight from ``events``; no JSON
is parsed here, so the check does not lean on the code it checks.
"""

from evlake.sources.notifications import PARTITIONS, SHAPES, payload_sql

#: One row per message with everything its payload is made of.
MESSAGES = f"""m AS (
  SELECT event_id AS id, event_id % {SHAPES} AS shape,
    CAST((event_id // {SHAPES}) % {PARTITIONS} AS INTEGER) AS part,
    (event_id // {SHAPES * PARTITIONS}) * {SHAPES} + event_id % {SHAPES} AS off,
    'bucket-' || (user_id % 7) AS bucket,
    'ingest/object-' || event_id || '.dat' AS key,
    CAST(floor(value * 100) AS BIGINT) AS size,
    md5(CAST(event_id AS VARCHAR)) AS etag,
    'aws:s3' AS source,
    CASE user_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1' ELSE 'ap-south-1' END AS region,
    's3:ObjectCreated:' || event_type AS name,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS time_text,
    strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00' AS time_east,
    epoch_us(ts) AS t_us, epoch_us(ts) + 60000000 AS sent_us
  FROM events)"""

#: The same with the payload text as a reader sees it.
PAYLOADS = f"""{MESSAGES},
p AS (
  SELECT *, CASE WHEN shape = 16 THEN replace(body, '?', chr(65533)) ELSE body END AS raw
  FROM (SELECT *, {payload_sql()} AS body FROM m))"""

_FULL = "(0, 6, 11, 14, 15, 16, 17, 20, 21, 22, 23)"
_PARTIAL = "(4, 5, 12, 13)"


def _rows(source: str, raw: str) -> str:
    return f"""r AS (
  SELECT part, off, i AS record_index, sent_us, {raw} id, region, shape,
    CASE WHEN shape IN {_FULL} OR shape IN {_PARTIAL} THEN name
         WHEN shape = 2 THEN 's3:TestEvent' END AS event_name,
    CASE WHEN shape IN {_FULL} OR shape IN (2, 4, 12, 13) THEN t_us END AS event_time_us,
    CASE WHEN shape IN {_FULL} THEN source WHEN shape = 2 THEN 'Amazon S3' END AS event_source,
    CASE WHEN shape IN {_FULL} OR shape IN {_PARTIAL} OR shape = 2 THEN bucket END AS bucket,
    CASE WHEN shape = 0 THEN key || CASE i WHEN 0 THEN '-left' ELSE '-right' END
         WHEN shape = 6 THEN 'maps/east wing v-' || id
         WHEN shape = 15 THEN 'odd/100%-' || id
         WHEN shape = 16 THEN 'bytes/' || id || '-' || chr(65533)
         WHEN shape IN {_FULL} OR shape IN {_PARTIAL} THEN key END AS object_key,
    CASE WHEN shape IN {_FULL} OR shape = 5 THEN size END AS object_size,
    CASE WHEN shape IN {_FULL} THEN etag END AS object_etag
  FROM (SELECT *, CASE shape WHEN 0 THEN 2 WHEN 18 THEN 3 WHEN 7 THEN 0 WHEN 8 THEN 0
                             WHEN 19 THEN 0 ELSE 1 END AS n FROM {source}) s,
       (VALUES (0), (1), (2)) AS idx(i)
  WHERE i < n)"""


ROWS = f"WITH {MESSAGES},\n{_rows('m', '')}"
ROWS_RAW = f"WITH {PAYLOADS},\n{_rows('p', 'raw,')}"

#: The replayed and damaged tables of the inputs.
REPLAYED = f"{ROWS}, rp AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE bucket = 'bucket-0')"
DAMAGED = f"{REPLAYED}, dm AS (SELECT * FROM rp WHERE bucket IS NULL OR bucket <> 'bucket-1')"

LISTING = """WITH l AS (
  SELECT 's3://store/' || event_type || '/object-' || event_id
      || CASE WHEN event_id % 50 = 0 THEN '/' WHEN event_id % 3 = 0 THEN '.parquet' ELSE '.dat' END AS path,
    CAST(floor(value * 100) AS BIGINT) AS length, epoch_us(ts) AS changed_us
  FROM events)"""

SAMPLES = """WITH h AS (
  SELECT 'group-' || (user_id % 5) AS pipeline, epoch_us(date_trunc('hour', ts)) // 3600000000 AS hour,
    count(*) AS s, count(*) FILTER (event_type <> 'error') AS k,
    count(*) FILTER (event_type IN ('click', 'view')) AS r, count(*) FILTER (event_type = 'purchase') AS f
  FROM events GROUP BY 1, 2),
w AS (
  SELECT pipeline, hour,
    CAST(sum(s) OVER o AS BIGINT) AS s, CAST(sum(k) OVER o AS BIGINT) AS k,
    CAST(sum(r) OVER o AS BIGINT) AS r, CAST(sum(f) OVER o AS BIGINT) AS f
  FROM h WINDOW o AS (PARTITION BY pipeline ORDER BY hour)),
sm AS (
  SELECT pipeline, CAST(hour * 3600 AS DOUBLE) AS t, s AS source_objects, k AS topic_end,
    CASE WHEN hour % 7 <> 0 THEN k - 3 END AS topic_retained,
    CASE WHEN hour % 5 <> 0 THEN k - r END AS topic_lag,
    CASE WHEN hour % 11 <> 0 THEN r END AS table_rows,
    f AS data_files
  FROM w)"""

#: Table rows as the queries print them.
SHOWN = """part AS kafka_partition, off AS kafka_offset, CAST(record_index AS INTEGER) AS record_index"""
