"""From topic messages to JSON payloads, with a quarantine for the rest."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from evlake.fixed_values import PAYLOAD_PREVIEW

#: Where the payload sits inside the ``parsed`` column.
PAYLOAD = "$[0]"


def lossy_utf8(value: Column) -> Column:
    """Bytes as text, each undecodable sequence replaced by U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))


def whole_json(text: Column, mark: Column) -> Column:
    """``[payload, mark]`` as VARIANT if ``text`` is one JSON value, else null.

    ``try_parse_json`` stops after the first value and ignores what follows, so
    the text is parsed as the first of two array elements. The mark, a hash of
    the text, only comes back in second place when nothing trailed the value.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))


def decode(messages: DataFrame) -> DataFrame:
    """Add ``raw`` (text), ``n_bytes``, ``parsed`` and ``is_json`` to messages.

    ``raw`` is null for a message without a value, ``value`` for one that is JSON. Narrow: no row is dropped and
    nothing is shuffled. The payload is at :data:`PAYLOAD` in ``parsed``.
    """
    text = messages.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        lossy_utf8(F.col("value")).alias("raw"),
        F.octet_length("value").alias("n_bytes"),
        "value",
    )
    mark = F.xxhash64("raw")
    read = text.withColumn("parsed", whole_json(F.col("raw"), mark)).withColumn(
        "is_json",
        F.coalesce(F.try_variant_get("parsed", "$[1]", "bigint") == mark, F.lit(False)),
    )
    # The bytes themselves matter only where the text gives no row.
    return read.withColumn("value", F.when(~F.col("is_json"), F.col("value")))


def usable(decoded: DataFrame) -> DataFrame:
    return decoded.where("is_json")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Messages that give no row, whole and with the reason; ``preview`` is the start
    of the payload as text."""
    return decoded.where("not is_json").select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        "n_bytes",
        "value",
        F.when(F.col("raw").isNull(), "no payload").otherwise("not JSON").alias("reason"),
        F.substring("raw", 1, PAYLOAD_PREVIEW).alias("preview"),
    )


def counted(decoded: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; the observation counts those that give no row while they pass,
    and remembers the first and last coordinates of them."""
    bad = ~F.col("is_json")
    place = F.when(bad, F.struct("topic", "partition", "offset"))
    return decoded.observe(
        observation,
        F.count("*").alias("messages"),
        F.count_if(bad & F.col("raw").isNull()).alias("no_payload"),
        F.count_if(bad & F.col("raw").isNotNull()).alias("not_json"),
        F.min(place).alias("first"),
        F.max(place).alias("last"),
    )
