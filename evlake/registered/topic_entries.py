"""Sources, decoding, flattening, scalar functions."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from evlake.functions import times, uris
from evlake.operators.decode import counted, decode, quarantine, usable
from evlake.operators.flatten import find_records, flatten, unnest
from evlake.registered import inputs
from evlake.registered.entries import micros, query
from evlake.registered.oracle_parts import MESSAGES, PAYLOADS, ROWS, ROWS_RAW, SHOWN
from evlake.session import new_folder
from evlake.sources import objects
from evlake.sources.notifications import generated
from evlake.sources.topic import from_offsets, next_offsets
from evlake.streaming.ingest import Ingest

COORDINATES = ["kafka_partition", "kafka_offset", "record_index"]

# -- sources ------------------------------------------------------------------


def _per_partition(messages):
    return messages.groupBy("partition").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


_PER_PARTITION = "count(*) AS messages, min(off) AS first_offset, max(off) AS last_offset"


@query("src1_topic_stream", f"WITH {MESSAGES} SELECT part AS partition, {_PER_PARTITION} FROM m GROUP BY part")
def src1(spark, sf_dir):
    """The topic read as a stream to its end, written to files and read back."""
    out, checkpoint = new_folder(spark, "copy"), new_folder(spark, "checkpoint")
    stream = inputs.topic(spark, sf_dir).stream(spark)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return _per_partition(spark.read.parquet(out))


@query(
    "src2_start_position",
    f"""WITH {MESSAGES}, h AS (SELECT part, (max(off) + 1) // 2 AS start FROM m GROUP BY part)
    SELECT part AS partition, {_PER_PARTITION} FROM m JOIN h USING (part) WHERE off >= start GROUP BY part""",
)
def src2(spark, sf_dir):
    """Reading from given offsets on, here from the middle of each partition."""
    messages = inputs.messages(spark, sf_dir)
    start = {p: n // 2 for p, n in next_offsets(messages).items()}
    return _per_partition(from_offsets(messages, start))


@query(
    "src5_object_listing",
    """SELECT 'type=' || event_type AS folder, CAST(1 AS BIGINT) AS objects, sum(strlen(user_id) + 1)::BIGINT AS bytes
    FROM (SELECT event_type, CAST(user_id AS VARCHAR) AS user_id FROM events) e GROUP BY event_type""",
)
def src5(spark, sf_dir):
    """Objects written from the events, one per kind, listed with their sizes."""
    store = new_folder(spark, "listed")
    lines = inputs.events(spark, sf_dir).select(
        F.col("event_type").alias("type"), F.col("user_id").cast("string").alias("value")
    )
    lines.repartition("type").write.partitionBy("type").text(store)
    found = objects.list_objects(spark, store, ".txt")
    folder = F.regexp_extract("path", "/(type=[^/]+)/", 1).alias("folder")
    return found.groupBy(folder).agg(F.count("*").alias("objects"), F.sum("length").alias("bytes"))


@query(
    "snk5_publish",
    f"WITH {PAYLOADS} SELECT part AS partition, off AS \"offset\", sent_us AS timestamp_us, strlen(body) AS n_bytes FROM p",
)
def snk5(spark, sf_dir):
    """Messages as published: coordinates, time and size."""
    return inputs.messages(spark, sf_dir).select(
        "partition", "offset", micros("timestamp"), F.octet_length("value").alias("n_bytes")
    )


@query(
    "snk6_generator",
    """WITH g AS (SELECT event_id AS id, event_id % 7 AS pick,
        CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 7) AS BIGINT) % 1000 < 200 AS awkward FROM events)
    SELECT id % 4 AS kafka_partition, id // 4 AS kafka_offset, CAST(i AS INTEGER) AS record_index,
      CASE WHEN awkward AND pick = 4 THEN 's3:TestEvent' WHEN awkward AND pick IN (5, 6) THEN NULL
        ELSE 's3:ObjectCreated:Put' END AS event_name,
      CASE WHEN NOT awkward OR pick < 4 THEN CASE WHEN awkward AND pick = 0 THEN NULL ELSE 1 + id % 5000000 END END AS object_size
    FROM g, (VALUES (0), (1)) AS v(i) WHERE i = 0 OR (awkward AND pick = 2)""",
)
def snk6(spark, sf_dir):
    """Messages generated for the event ids, one in five awkward, flattened."""
    made = generated(inputs.events(spark, sf_dir).select(F.col("event_id").alias("id")))
    return flatten(decode(made), F.col("timestamp")).select(*COORDINATES, "event_name", "object_size")


# -- decoding -----------------------------------------------------------------


@query(
    "dec1_null_payload",
    f"""WITH {MESSAGES} SELECT part AS partition, off AS "offset", count(*) OVER () AS no_payload,
      (SELECT count(*) FROM m) AS messages, (SELECT count(*) FROM m WHERE shape IN (7, 19)) AS not_json
    FROM m WHERE shape = 8""",
)
def dec1(spark, sf_dir):
    """Messages without a payload, next to what the job counts while they pass."""
    seen = Observation("decoded")
    found = new_folder(spark, "null-payload")
    watched = counted(decode(inputs.messages(spark, sf_dir)), seen)
    watched.where("raw is null").select("partition", "offset").write.parquet(found)
    counts = {k: F.lit(seen.get[k]) for k in ("messages", "no_payload", "not_json")}
    return spark.read.parquet(found).withColumns(counts)


@query("dec2_lossy_text", f"WITH {PAYLOADS} SELECT part AS partition, off AS \"offset\", md5(raw) AS text_md5 FROM p")
def dec2(spark, sf_dir):
    decoded = decode(inputs.messages(spark, sf_dir))
    return decoded.select("partition", "offset", F.md5("raw").alias("text_md5"))


@query(
    "dec3_quarantine",
    f"""WITH {PAYLOADS} SELECT part AS partition, off AS "offset", strlen(body) AS n_bytes,
      CASE shape WHEN 8 THEN 'no payload' ELSE 'not JSON' END AS reason, substr(raw, 1, 500) AS preview,
      md5(body) AS value_md5, sent_us AS timestamp_us
    FROM p WHERE shape IN (7, 8, 19)""",
)
def dec3(spark, sf_dir):
    """What is kept of messages that give no row: all of it."""
    kept = quarantine(decode(inputs.messages(spark, sf_dir)))
    return kept.select(
        "partition", "offset", "n_bytes", "reason", "preview", F.md5("value").alias("value_md5"), micros("timestamp")
    )


@query(
    "dec3_two_runs",
    f"""WITH {PAYLOADS} SELECT part AS partition, CAST(2 AS BIGINT) AS runs, 2 * count(*) AS kept
    FROM p WHERE shape IN (7, 8, 19) GROUP BY part""",
)
def dec3_two(spark, sf_dir):
    """Two jobs, each with a checkpoint of its own, keep their messages side by side."""
    bad, topic = new_folder(spark, "quarantine"), inputs.topic(spark, sf_dir)
    for run in ("one", "two"):
        table = inputs.new_table(spark, f"run-{run}")
        Ingest(topic, table, new_folder(spark, "checkpoint"), ingest_time=F.col("timestamp"), bad=bad).drain(spark)
    kept = spark.read.parquet(bad)
    return kept.groupBy("partition").agg(F.count_distinct("run_id").alias("runs"), F.count("*").alias("kept"))


@query(
    "dec4_payload_bytes",
    f"""WITH {PAYLOADS} SELECT part AS partition, count(*) AS messages, sum(strlen(body)) AS bytes,
      max(strlen(body)) AS largest FROM p WHERE shape NOT IN (7, 8, 19) GROUP BY part""",
)
def dec4(spark, sf_dir):
    return (
        usable(decode(inputs.messages(spark, sf_dir)))
        .groupBy("partition")
        .agg(
            F.count("*").alias("messages"),
            F.sum("n_bytes").alias("bytes"),
            F.max("n_bytes").alias("largest"),
        )
    )


# -- flattening ---------------------------------------------------------------


@query("flt1_record_unnest", f"{ROWS} SELECT {SHOWN} FROM r")
def flt1(spark, sf_dir):
    return inputs.rows(spark, sf_dir).select(*COORDINATES)


_ORIGIN = f"""WITH {MESSAGES}
    SELECT part AS partition, off AS "offset",
      CASE WHEN shape = 1 THEN 'empty list' WHEN shape = 2 THEN 'connectivity test'
           WHEN shape IN (3, 9, 10, 17) THEN 'payload' ELSE 'list' END AS origin,
      CASE shape WHEN 0 THEN 2 WHEN 18 THEN 3 ELSE 1 END AS n_records
    FROM m WHERE shape NOT IN (7, 8, 19)"""


@query("flt2_record_origin", _ORIGIN)
def flt2(spark, sf_dir):
    """Where the records of each message were found."""
    found = find_records(usable(decode(inputs.messages(spark, sf_dir))))
    return found.select("partition", "offset", "origin", F.size("records").alias("n_records"))


@query("flt3_empty_list", f"{ROWS} SELECT {SHOWN}, true AS no_fields FROM r WHERE shape = 1")
def flt3(spark, sf_dir):
    """The one row an empty record list stands for."""
    found = unnest(decode(inputs.messages(spark, sf_dir))).where("origin = 'empty list'")
    return found.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "record_index",
        F.col("record").isNull().alias("no_fields"),
    )


@query(
    "flt4_connectivity_test",
    f"""{ROWS} SELECT {SHOWN}, event_name, event_source, event_time_us, bucket, object_key
    FROM r WHERE event_name = 's3:TestEvent'""",
)
def flt4(spark, sf_dir):
    rows = inputs.rows(spark, sf_dir).where("event_name = 's3:TestEvent'")
    return rows.select(
        *COORDINATES, "event_name", "event_source", micros("event_time"), "bucket", "object_key"
    )


_SECTIONS = [
    ('{}', True), ('null', True), ('false', True), ('0', True), ('""', True), ('[]', True), ('0.0', True),
    ('"text"', False), ('[1]', False), ('{"x":1}', False), ('true', False), ('7', False),
]
_SECTION_SQL = "CASE event_id % 12 " + " ".join(
    f"WHEN {i} THEN '{first}'" for i, (first, _) in enumerate(_SECTIONS)
) + " END"
_SECTION_HIDDEN = ", ".join(str(i) for i, (_, shown) in enumerate(_SECTIONS) if not shown)


@query(
    "flt5_section_lookup",
    f"""SELECT event_id AS kafka_offset,
      CASE WHEN event_id % 12 NOT IN ({_SECTION_HIDDEN}) THEN 'b-' || user_id END AS bucket,
      'k-' || event_id AS object_key FROM events""",
)
def flt5(spark, sf_dir):
    """An empty first spelling gives way to the second, any other value hides it."""
    sql = f"""'{{"s3":{{"bucket":' || {_SECTION_SQL} || ',"Bucket":{{"name":"b-' || user_id
      || '"}},"object":{{"key":"k-' || event_id || '"}}}}}}'"""
    return inputs.payload_rows(spark, sf_dir, sql).select("kafka_offset", "bucket", "object_key")


_ANY_SECTION = _SECTION_SQL.replace("event_id %", "event_id div 3 %")
_ANY_HIDDEN = f"(event_id // 3) % 12 IN ({_SECTION_HIDDEN})"


@query(
    "flt5_every_section",
    f"""SELECT event_id AS kafka_offset,
      CASE WHEN NOT ({_ANY_HIDDEN} AND event_id % 3 IN (0, 1)) THEN 'b-' || user_id END AS bucket,
      CASE WHEN NOT ({_ANY_HIDDEN} AND event_id % 3 IN (0, 2)) THEN 'k-' || event_id END AS object_key FROM events""",
)
def flt5_every(spark, sf_dir):
    """The same for each of the sections: s3, and the bucket and the object inside it."""
    bucket, obj = """{"name":"b-' || user_id || '"}""", """{"key":"k-' || event_id || '"}"""
    first = f"' || {_ANY_SECTION} || '"
    sql = f"""CASE event_id % 3
      WHEN 0 THEN '{{"s3":{first},"S3":{{"bucket":{bucket},"object":{obj}}}}}'
      WHEN 1 THEN '{{"s3":{{"bucket":{first},"Bucket":{bucket},"object":{obj}}}}}'
      ELSE '{{"s3":{{"bucket":{bucket},"object":{first},"Object":{obj}}}}}' END"""
    return inputs.payload_rows(spark, sf_dir, sql).select("kafka_offset", "bucket", "object_key")


# Value as written in the payload (X stands for the event id), expected text.
_TEXTS = [
    ('"name-X"', "'name-' || event_id"), ('"  name-X "', "'name-' || event_id"), ('"   "', "'other'"),
    ('""', "'other'"), ('null', "'other'"), ('true', "'other'"), ('{"a":1}', "'other'"), ('[1]', "'other'"),
    ('X', "CAST(event_id AS VARCHAR)"), ('X.5', "event_id || '.5'"), ('X.0', "event_id || '.0'"),
    ('-X', "CASE event_id WHEN 0 THEN '0' ELSE '-' || event_id END"), ('"true"', "'true'"),
]
_WHOLES = [
    ('X', "event_id"), ('-X', "-event_id"), ('" X "', "event_id"), ('"+X"', "event_id"), ('X.0', "event_id"),
    ('X.5', "-1"), ('Xe2', "event_id * 100"), ('true', "-1"), ('null', "-1"), ('"large"', "-1"), ('[X]', "-1"),
    ('1180591620717411303424', "-1"), ('"1_000"', "1000"), ('"X.0"', "-1"), ('"9223372036854775808"', "-1"),
    ('9223372036854775807', "9223372036854775807"), ('""', "-1"),
]


def _written(cases):
    """The payload value of an event as SQL text."""
    parts = []
    for i, (text, _) in enumerate(cases):
        parts.append(f"WHEN {i} THEN '" + text.replace("X", "' || event_id || '") + "'")
    return f"CASE event_id % {len(cases)} " + " ".join(parts) + " END"


def _expected(cases):
    return f"CASE event_id % {len(cases)} " + " ".join(
        f"WHEN {i} THEN {value}" for i, (_, value) in enumerate(cases)
    ) + " END"


@query("flt6_first_text", f"SELECT event_id AS kafka_offset, {_expected(_TEXTS)} AS event_name FROM events")
def flt6(spark, sf_dir):
    """Values of every JSON type where text is wanted, with a second spelling."""
    sql = f"""'{{"eventName":' || {_written(_TEXTS)} || ',"EventName":"other"}}'"""
    return inputs.payload_rows(spark, sf_dir, sql).select("kafka_offset", "event_name")


@query("flt7_first_whole", f"SELECT event_id AS kafka_offset, {_expected(_WHOLES)} AS object_size FROM events")
def flt7(spark, sf_dir):
    """Values of every JSON type where an integer is wanted, with a second spelling."""
    sql = f"""'{{"s3":{{"object":{{"size":' || {_written(_WHOLES)} || ',"objectSize":-1}}}}}}'"""
    return inputs.payload_rows(spark, sf_dir, sql).select("kafka_offset", "object_size")


def _spelling(names: str) -> str:
    names = names.split()
    return f"CASE event_id % {len(names)} " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)
    ) + " END"


@query(
    "flt8_spellings",
    """SELECT event_id AS kafka_offset, event_type AS event_name, epoch_us(ts) // 1000000 * 1000000 AS event_time_us,
      'src' AS event_source, 'b-' || user_id AS bucket, 'k-' || event_id AS object_key,
      event_id AS object_size, 'e-' || event_id AS object_etag FROM events""",
)
def flt8(spark, sf_dir):
    """Every accepted spelling of every field."""
    sql = f"""'{{"' || {_spelling("eventName EventName event_name eventType")} || '":"' || event_type
      || '","' || {_spelling("eventTime EventTime event_time eventTimestamp")} || '":"'
      || date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || 'Z","' || {_spelling("eventSource EventSource event_source")}
      || '":"src","' || {_spelling("s3 S3")} || '":{{"' || {_spelling("bucket Bucket")} || '":{{"'
      || {_spelling("name Name bucketName")} || '":"b-' || user_id || '"}},"' || {_spelling("object Object")}
      || '":{{"' || {_spelling("key Key objectKey")} || '":"k-' || event_id || '","'
      || {_spelling("size objectSize Size contentLength")} || '":' || event_id || ',"'
      || {_spelling("eTag etag ETag")} || '":"e-' || event_id || '"}}}}}}'"""
    rows = inputs.payload_rows(spark, sf_dir, sql)
    return rows.select(
        "kafka_offset", "event_name", micros("event_time"), "event_source", "bucket",
        "object_key", "object_size", "object_etag",
    )


# Spark pattern or literal, expected microseconds.
_TIMES = [
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z'", "epoch_us(ts)"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || 'z'", "epoch_us(ts) // 1000000 * 1000000"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '987+02:00'", "epoch_us(ts) - 7200000000"),
    ("date_format(ts, \"yyyy-MM-dd HH:mm:ss.SSSSSS\")", "epoch_us(ts)"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || '.5-05:30'", "epoch_us(ts) // 1000000 * 1000000 + 19800500000"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm\")", "epoch_us(ts) // 60000000 * 60000000"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm\") || '+00:00'", "epoch_us(ts) // 60000000 * 60000000"),
    ("'  ' || date_format(ts, 'yyyy-MM-dd') || ' '", "epoch_us(date_trunc('day', ts))"),
    ("'yesterday'", "NULL"), ("'now'", "NULL"), ("'2026'", "NULL"), ("'T09:03'", "NULL"), ("'   '", "NULL"),
    ("'2026-13-45T99:99:99Z'", "NULL"), ("'2026-02-30'", "NULL"),
    ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || '.Z'", "NULL"),
]


@query("flt9_text_time", f"SELECT event_id, {_expected(_TIMES)} AS parsed_us FROM events")
def flt9(spark, sf_dir):
    cases = " ".join(f"WHEN {i} THEN {sql}" for i, (sql, _) in enumerate(_TIMES))
    text = F.expr(f"CASE event_id % {len(_TIMES)} {cases} END")
    parsed = times.from_text(text)
    return inputs.events(spark, sf_dir).select("event_id", F.unix_micros(parsed).alias("parsed_us"))


@query(
    "flt10_epoch_time",
    """SELECT event_id, CASE event_id % 3 WHEN 2 THEN -(epoch_us(ts) // 1000000) * 1000000
      WHEN 1 THEN epoch_us(ts) // 1000 * 1000 ELSE epoch_us(ts) // 1000000 * 1000000 END AS parsed_us FROM events""",
)
def flt10(spark, sf_dir):
    """Seconds and milliseconds told apart by size."""
    us = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    number = F.expr(
        f"CASE event_id % 3 WHEN 2 THEN -({us} div 1000000) WHEN 1 THEN {us} div 1000 ELSE {us} div 1000000 END"
    )
    parsed = times.from_epoch(number)
    return inputs.events(spark, sf_dir).select("event_id", F.unix_micros(parsed).alias("parsed_us"))


@query("flt11_key_decoding", "SELECT doc_id, md5(text) AS key_md5, md5('100% ' || text) AS stray_md5 FROM documents")
def flt11(spark, sf_dir):
    """Whole document texts, URL-encoded, come back as they were."""
    encoded = F.url_encode("text")
    stray = F.concat(F.lit("100%+"), encoded)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        F.md5(uris.decode_key(encoded)).alias("key_md5"),
        F.md5(uris.decode_key(stray)).alias("stray_md5"),
    )


@query(
    "flt12_lineage",
    f"""{ROWS_RAW} SELECT 'object-notifications' AS kafka_topic, {SHOWN}, sent_us AS ingest_time_us,
      md5(raw) AS raw_md5 FROM r""",
)
def flt12(spark, sf_dir):
    rows = inputs.rows(spark, sf_dir)
    return rows.select("kafka_topic", *COORDINATES, micros("ingest_time"), F.md5("raw_event").alias("raw_md5"))


def all_columns(rows):
    """The 13 table columns, timestamps as numbers."""
    return rows.select(
        micros("ingest_time"), "kafka_topic", *COORDINATES, "event_name", micros("event_time"),
        "event_source", "bucket", "object_key", "object_size", "object_etag", "raw_event",
    )


ALL_COLUMNS = f"""{ROWS_RAW} SELECT sent_us AS ingest_time_us, 'object-notifications' AS kafka_topic, {SHOWN},
  event_name, event_time_us, event_source, bucket, object_key, object_size, object_etag, raw AS raw_event FROM r"""


@query("flt13_flatten", ALL_COLUMNS)
def flt13(spark, sf_dir):
    return all_columns(inputs.rows(spark, sf_dir))


# -- scalar functions ---------------------------------------------------------

_URIS = """CASE event_id % 8 WHEN 0 THEN 's3://b-' || user_id || '/k/' || event_id
  WHEN 1 THEN 's3a://b-' || user_id || '//k/' || event_id WHEN 2 THEN '  s3://b-' || user_id || ' '
  WHEN 3 THEN 's3://b-' || user_id || '/' WHEN 4 THEN 'http://b-' || user_id || '/k'
  WHEN 5 THEN 's3:///k/' || event_id WHEN 6 THEN 's3://' ELSE 'b-' || user_id END"""


@query(
    "scl1_parse_uri",
    """SELECT event_id, CASE WHEN event_id % 8 < 4 THEN 'b-' || user_id END AS bucket,
      CASE WHEN event_id % 8 < 2 THEN 'k/' || event_id WHEN event_id % 8 < 4 THEN '' END AS key FROM events""",
)
def scl1(spark, sf_dir):
    parsed = inputs.events(spark, sf_dir).select("event_id", uris.parse_uri(F.expr(_URIS)).alias("u"))
    return parsed.select("event_id", F.col("u.bucket").alias("bucket"), F.col("u.key").alias("key"))


@query(
    "scl2_join_key",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type || '/' || event_id
      WHEN 1 THEN event_type || '/x/' || event_id ELSE CAST(event_id AS VARCHAR) END AS joined,
      'wh-' || user_id AS bucket, 'base/lake/' || event_type || '/data/' AS data_prefix FROM events""",
)
def scl2(spark, sf_dir):
    first = F.expr("CASE event_id % 3 WHEN 0 THEN event_type || '//' WHEN 1 THEN '/' || event_type END")
    second = F.expr("CASE event_id % 3 WHEN 1 THEN 'x' ELSE '' END")
    prefix = uris.table_prefix(
        F.expr("'s3://wh-' || user_id || '/base/'"), F.lit("lake"), F.col("event_type"), "data"
    )
    made = inputs.events(spark, sf_dir).select(
        "event_id",
        uris.join_key(first, second, F.expr("'/' || event_id")).alias("joined"),
        prefix.alias("p"),
    )
    return made.select("event_id", "joined", F.col("p.bucket").alias("bucket"), F.col("p.prefix").alias("data_prefix"))


@query(
    "scl3_redact_uri",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'https://u-' || user_id || ':<redacted>@host/' || event_id
      WHEN 1 THEN 'https://u-' || user_id || '@host/' || event_id ELSE 'https://host:80/' || event_id END AS safe
    FROM events""",
)
def scl3(spark, sf_dir):
    uri = F.expr(
        """CASE event_id % 3 WHEN 0 THEN 'https://u-' || user_id || ':pw-' || event_id || '@host/' || event_id
        WHEN 1 THEN 'https://u-' || user_id || '@host/' || event_id ELSE 'https://host:80/' || event_id END"""
    )
    return inputs.events(spark, sf_dir).select("event_id", uris.redact_uri(uri).alias("safe"))


@query(
    "scl4_redact_properties",
    """SELECT event_id, 'v-' || event_id AS endpoint, '<redacted>' AS secret, '<redacted>' AS key_id,
      '<redacted>' AS token, event_type AS kind FROM events""",
)
def scl4(spark, sf_dir):
    value = F.expr("'v-' || event_id")
    names = {"endpoint": "s3.endpoint", "secret": "s3.SECRET-access-key", "key_id": "s3.access-key-id",
             "token": "oauth2.Token"}
    pairs = [c for n in names.values() for c in (F.lit(n), value)]
    properties = F.create_map(*pairs, F.lit("kind"), F.col("event_type"))
    safe = inputs.events(spark, sf_dir).select("event_id", uris.redact_properties(properties).alias("p"))
    shown = [F.col("p")[n].alias(a) for a, n in {**names, "kind": "kind"}.items()]
    return safe.select("event_id", *shown)


@query("scl5_base_name", "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")
def scl5(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", uris.base_name(F.col("url")).alias("name"))
