"""Topic-shaped notifications made from any table with an id column.

Used to publish test messages. A fixed share of the ids gets one of several
awkward payloads, so a run is reproducible without a random generator. Payloads
are built by string concatenation only; the SQL texts below hold on any engine
with CASE and ||, so an outside engine can rebuild the very same messages.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOPIC_NAME = "object-notifications"
PARTITIONS = 4

#: Number of payload shapes; ``shape`` is the id modulo this.
SHAPES = 24

_EVENT = """'{"eventVersion":"2.2","eventSource":"' || source || '","awsRegion":"' || region
  || '","eventTime":"' || time_text || '","eventName":"' || name || '",' """
_BUCKET = """'"bucket":{"name":"' || bucket || '","arn":"arn:aws:s3:::' || bucket || '"}'"""
_TAIL = """',"size":' || size || ',"eTag":"' || etag || '"}}}'"""


def _full(key: str = "key", time: str = "time_text", s3: str = "s3") -> str:
    event = _EVENT.replace("time_text", time)
    return f"""{event} || '"{s3}":{{' || {_BUCKET} || ',"object":{{"key":"' || {key} || '"' || {_TAIL}"""


def _small(body: str) -> str:
    return f"""'{{"Records":[{{"eventName":"' || name || '","eventTime":"' || time_text || '","s3":{{' || {_BUCKET} || ',"object":{{"key":"' || key || '"{body}}}}}}}]}}'"""


#: Payload text by shape, over the columns of :data:`BASE_COLUMNS`.
PAYLOADS = {
    0: f"""'{{"Records":[' || {_full("key || '-left'")} || ',' || {_full("key || '-right'")} || ']}}'""",
    1: """'{"Records":[]}'""",
    2: """'{"Service":"Amazon S3","Event":"s3:TestEvent","Time":"' || time_text || '","Bucket":"'
       || bucket || '","Note":"' || id || '","Mark":"' || etag || '"}'""",
    3: """'{"lamp":"on","watt":' || id || '}'""",
    4: _small(""),
    5: """'{"Records":[{"eventName":"' || name || '","eventTime":"around noon","s3":{' || """
    + _BUCKET
    + """ || ',"object":{"key":"' || key || '","size":" ' || size || ' "}}}]}'""",
    6: f"""'{{"Records":[' || {_full("'maps/east+wing%20v-' || id")} || ']}}'""",
    7: """'plain words, number ' || id""",
    9: """'[1,2,' || id || ']'""",
    10: """'{"Records":"later","ticket":' || id || '}'""",
    11: """'{"records":[{"EventName":"' || name || '","EventTime":"' || time_text
        || '","EventSource":"' || source || '","S3":{"Bucket":{"Name":"' || bucket
        || '"},"Object":{"Key":"' || key || '","objectSize":' || size || ',"etag":"' || etag || '"}}}]}'""",
    12: _small(',"size":true'),
    13: _small(',"size":1180591620717411303424'),
    14: f"""'{{"Records":[' || {_full(time="time_east")} || ']}}'""",
    15: f"""'{{"Records":[' || {_full("'odd/100%-' || id")} || ']}}'""",
    16: f"""'{{"Records":[' || {_full("'bytes/' || id || '-?'")} || ']}}'""",
    17: _full(),
    18: """'{"Records":["loose end",' || id || ',null]}'""",
    19: f"""{_full()} || ' ' || {_full()}""",
    20: f"""'{{"Records":[{{"s3":{{}},' || substr({_full(s3="S3")}, 2) || ']}}'""",
}
# Shapes from 21 on.
WELL_FORMED = f"""'{{"Records":[' || {_full()} || ']}}'"""

#: Shape 8 carries no value at all; in shape 16 the '?' becomes a stray byte.
NULL_SHAPE = 8
BYTES_SHAPE = 16


def payload_sql() -> str:
    """Payload text of a message as one SQL expression."""
    cases = "\n".join(f"WHEN {n} THEN {sql}" for n, sql in PAYLOADS.items())
    return f"CASE shape WHEN {NULL_SHAPE} THEN NULL\n{cases}\nELSE {WELL_FORMED} END"


def _micros(ts: str) -> str:
    return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})"


#: Message contents by column, from the events table.
BASE_COLUMNS = {
    "id": "event_id",
    "shape": f"event_id % {SHAPES}",
    "part": f"cast((event_id div {SHAPES}) % {PARTITIONS} as int)",
    "off": f"(event_id div {SHAPES * PARTITIONS}) * {SHAPES} + event_id % {SHAPES}",
    "bucket": "'bucket-' || (user_id % 7)",
    "key": "'ingest/object-' || event_id || '.dat'",
    "size": "cast(floor(value * 100) as bigint)",
    "etag": "md5(cast(event_id as string))",
    "source": "'aws:s3'",
    "region": "CASE user_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1' ELSE 'ap-south-1' END",
    "name": "'s3:ObjectCreated:' || event_type",
    "time_text": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z'",
    "time_east": "date_format(ts + INTERVAL '2' HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+02:00'",
    "sent": f"timestamp_micros({_micros('ts')} + 60000000)",
}


def notifications(events: DataFrame) -> DataFrame:
    """One topic message per row of ``events``, offsets dense per partition."""
    base = events.selectExpr(*[f"{sql} AS {name}" for name, sql in BASE_COLUMNS.items()])
    text = base.withColumn("text", F.expr(payload_sql()))
    stray = F.concat(
        F.substring_index("text", "?", 1).cast("binary"),
        F.lit(b"\xff"),
        F.substring_index("text", "?", -1).cast("binary"),
    )
    return text.select(
        F.lit(TOPIC_NAME).alias("topic"),
        F.col("part").alias("partition"),
        F.col("off").alias("offset"),
        F.when(F.col("shape") == BYTES_SHAPE, stray)
        .otherwise(F.col("text").cast("binary"))
        .alias("value"),
        F.col("sent").alias("timestamp"),
    )


def generated(ids: DataFrame, awkward_ratio: float = 0.2, seed: str = "") -> DataFrame:
    """Test messages for a table with an ``id`` column.

    The share ``awkward_ratio`` of the ids, spread by a hash that ``seed``
    varies, gets one of the seven awkward shapes in turn; all others are well
    formed.
    """
    awkward = [4, 5, 0, 6, 2, 1, 3]
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), 1, 7)
    slot = F.conv(digits, 16, 10).cast("bigint") % 1000
    shape = F.when(
        slot < int(awkward_ratio * 1000),
        F.element_at(F.array(*[F.lit(s) for s in awkward]), (F.pmod("id", F.lit(7)) + 1).cast("int")),
    ).otherwise(F.lit(SHAPES - 1))
    day = "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 86400)"
    base = ids.select(
        "id",
        shape.alias("shape"),
        F.pmod("id", F.lit(PARTITIONS)).cast("int").alias("part"),
        F.floor(F.col("id") / PARTITIONS).alias("off"),
        F.expr("'bucket-' || (id % 7)").alias("bucket"),
        F.expr("'ingest/object-' || id || '.dat'").alias("key"),
        F.expr("1 + id % 5000000").alias("size"),
        F.md5(F.col("id").cast("string")).alias("etag"),
        F.lit("aws:s3").alias("source"),
        F.lit("us-east-1").alias("region"),
        F.lit("s3:ObjectCreated:Put").alias("name"),
        F.expr(f"date_format({day}, \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z'").alias("time_text"),
        F.expr(f"date_format({day}, \"yyyy-MM-dd'T'HH:mm:ss\") || '+02:00'").alias("time_east"),
        F.expr(f"timestamp_micros({_micros(day)})").alias("sent"),
    )
    return base.select(
        F.lit(TOPIC_NAME).alias("topic"),
        F.col("part").alias("partition"),
        F.col("off").alias("offset"),
        F.expr(payload_sql()).cast("binary").alias("value"),
        F.col("sent").alias("timestamp"),
    )
