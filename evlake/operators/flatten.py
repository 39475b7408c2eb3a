"""One table row per notification record, whatever shape the payload has.

Narrow steps, no UDF and no shuffle: find the records of a payload, explode
them, read the fields of each.
"""

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evlake import fixed_values as fixed
from evlake.functions import json_values as jv
from evlake.functions import times
from evlake.functions.uris import decode_key
from evlake.operators.decode import PAYLOAD
from evlake.schema import EVENTS

_RECORD_FIELDS = fixed.NAME_FIELDS + fixed.TIME_FIELDS + fixed.SOURCE_FIELDS + ["s3", "S3"]
_ENVELOPE_FIELDS = ["Records", "records", "Event", "Service", "Time", "Bucket"]
_SECTIONS = ["bucket", "Bucket", "object", "Object"]


def _built_once(build: Callable):
    """Keep the expressions of a session: composing hundreds of them through the
    JVM bridge takes longer than planning the query."""
    built = {}

    def get():
        context = SparkContext._active_spark_context
        session = context.applicationId if context else None
        if session not in built:
            built.clear()
            built[session] = build()
        return built[session]

    return get


def _record_list(name: str) -> Column:
    """The list under a payload member, each element opened as a record."""
    opened = f"array<{jv.members(_RECORD_FIELDS)}>"
    renamed = f"array<{jv.slots(_RECORD_FIELDS)}>"
    return F.try_variant_get("parsed", f"{PAYLOAD}.{name}", opened).cast(renamed)


def _is_connectivity_test(envelope: Column) -> Column:
    """The message a store sends to prove a new notification works."""
    return F.coalesce(
        jv.member(envelope, "Records").isNull()
        & jv.member(envelope, "records").isNull()
        & (jv.strip(jv.string_only(jv.member(envelope, "Event"))) != "")
        & F.lower(jv.string_only(jv.member(envelope, "Service"))).contains("s3"),
        F.lit(False),
    )


def _test_as_record(envelope: Column) -> Column:
    """A connectivity test in the form of an ordinary record."""
    bucket = F.struct(jv.string_only(jv.member(envelope, "Bucket")).alias("name"))
    values = {
        "eventName": jv.member(envelope, "Event"),
        "eventSource": jv.member(envelope, "Service"),
        "eventTime": jv.member(envelope, "Time"),
        "s3": F.to_variant_object(F.struct(bucket.alias("bucket"))),
    }
    absent = F.lit(None).cast("variant")
    return F.struct(*[values.get(n, absent).alias(jv.slot(n)) for n in _RECORD_FIELDS])


def find_records(decoded: DataFrame) -> DataFrame:
    """Add ``origin`` and ``records``, an array of structs.

    A list under ``Records``, else one under ``records``. An empty list stands
    for one record without fields. Without a list the payload itself is the
    record, after rewriting if it is a connectivity test. What is no object
    gives a null struct and so a row of nulls. Both columns are null for a
    message that is not JSON, and only then.
    """
    found = decoded.select("*", _listed().alias("_listed"))
    opened = found.select("*", *[c.alias(n) for n, c in _origin_columns().items()])
    return opened.select(*decoded.columns, "origin", _records().alias("records"))


@_built_once
def _listed() -> Column:
    return F.when(F.col("is_json"), F.coalesce(_record_list("Records"), _record_list("records")))


@_built_once
def _origin_columns() -> dict[str, Column]:
    listed = F.col("_listed")
    envelope = F.when(
        F.col("is_json") & listed.isNull(),
        jv.open_object(F.col("parsed"), _ENVELOPE_FIELDS, PAYLOAD),
    )
    origin = (
        F.when(~F.col("is_json"), F.lit(None))
        .when(F.size(listed) > 0, "list")
        .when(F.size(listed) == 0, "empty list")
        .when(_is_connectivity_test(envelope), "connectivity test")
        .otherwise("payload")
    )
    return {"_envelope": envelope, "origin": origin}


@_built_once
def _records() -> Column:
    origin = F.col("origin")
    return (
        F.when(origin == "list", F.col("_listed"))
        .when(origin == "empty list", F.array(F.lit(None).cast(jv.slots(_RECORD_FIELDS))))
        .when(origin == "connectivity test", F.array(_test_as_record(F.col("_envelope"))))
        .when(origin == "payload", F.array(jv.open_object(F.col("parsed"), _RECORD_FIELDS, PAYLOAD)))
    )


def unnest(decoded: DataFrame) -> DataFrame:
    """One row per record with its position: ``record_index``, ``record``.

    Messages that are not JSON drop out here, by their null array, and not in a
    filter before: a filter would be pushed below the parsing and parse again.
    For the same reason the explode is an outer one, followed by a filter on its
    output; an inner one makes Spark test the array's size in a filter below.
    """
    found = find_records(decoded)
    keep = [c for c in found.columns if c not in ("records", "parsed", "is_json")]
    exploded = found.select(*keep, F.posexplode_outer("records").alias("record_index", "record"))
    return exploded.where("record_index is not null")


def open_sections(records: DataFrame) -> DataFrame:
    """Add the ``bucket_info`` and ``object_info`` structs of each record."""
    s3, infos = _section_columns()
    opened = records.select("*", s3.alias("_s3"))
    return opened.select(*records.columns, *[c.alias(n) for n, c in infos.items()])


@_built_once
def _section_columns() -> tuple[Column, dict[str, Column]]:
    record, s3 = F.col("record"), F.col("_s3")
    bucket = jv.either(jv.member(s3, "bucket"), jv.member(s3, "Bucket"))
    obj = jv.either(jv.member(s3, "object"), jv.member(s3, "Object"))
    object_fields = fixed.KEY_FIELDS + fixed.SIZE_FIELDS + fixed.ETAG_FIELDS
    return (
        jv.open_object(jv.either(jv.member(record, "s3"), jv.member(record, "S3")), _SECTIONS),
        {
            "bucket_info": jv.open_object(bucket, fixed.BUCKET_FIELDS),
            "object_info": jv.open_object(obj, object_fields),
        },
    )


@_built_once
def _time_text() -> Column:
    return jv.first_text(F.col("record"), fixed.TIME_FIELDS)


@_built_once
def _field_columns() -> dict[str, Column]:
    record, bucket, obj = F.col("record"), F.col("bucket_info"), F.col("object_info")
    return {
        "event_name": jv.first_text(record, fixed.NAME_FIELDS),
        "event_time": times.from_text(F.col("time_text")),
        "event_source": jv.first_text(record, fixed.SOURCE_FIELDS),
        "bucket": jv.first_text(bucket, fixed.BUCKET_FIELDS),
        "object_key": decode_key(jv.first_text(obj, fixed.KEY_FIELDS)),
        "object_size": jv.first_whole(obj, fixed.SIZE_FIELDS),
        "object_etag": jv.first_text(obj, fixed.ETAG_FIELDS),
    }


def _epoch_event_time() -> Column:
    fields = [jv.member(F.col("record"), n) for n in fixed.TIME_FIELDS]
    numbers = [
        F.when(jv.kind(f).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(f, "$", "double"))
        for f in fields
    ]
    return times.from_epoch(F.coalesce(*numbers))


def flatten(
    decoded: DataFrame, ingest_time: Column | None = None, epoch_event_time: bool = False
) -> DataFrame:
    """Table rows of decoded messages; every JSON message gives at least one.

    ``ingest_time`` defaults to the time of the batch. A numeric event time is
    null unless ``epoch_event_time`` asks for it to be read as an epoch.
    """
    fields = dict(_field_columns())
    if epoch_event_time:
        fields["event_time"] = F.coalesce(fields["event_time"], _epoch_event_time())
    fields["ingest_time"] = ingest_time if ingest_time is not None else F.current_timestamp()
    fields["kafka_topic"] = F.col("topic")
    fields["kafka_partition"] = F.col("partition")
    fields["kafka_offset"] = F.col("offset")
    fields["record_index"] = F.col("record_index")
    fields["raw_event"] = F.col("raw")
    records = open_sections(unnest(decoded)).select("*", _time_text().alias("time_text"))
    return records.select(*[fields[name].alias(name) for name in EVENTS.fieldNames()])
