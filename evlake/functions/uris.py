"""Object-store addresses: parsing, joining, redacting."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from evlake.fixed_values import REDACTED, SECRET_NAME_PARTS
from evlake.functions.json_values import strip

_ADDRESS = r"(?s)^s3a?://([^/]+)/*(.*)$"


def parse_uri(uri: Column) -> Column:
    """``struct(bucket, key)`` of an s3:// or s3a:// address, null when it is none."""
    clean = strip(uri)
    return F.when(
        clean.rlike(_ADDRESS),
        F.struct(
            F.regexp_extract(clean, _ADDRESS, 1).alias("bucket"),
            F.regexp_extract(clean, _ADDRESS, 2).alias("key"),
        ),
    )


def same_bucket(uri: Column, other: Column) -> Column:
    """Whether two addresses name the same bucket; false when either names none."""
    return F.coalesce(parse_uri(uri)["bucket"] == parse_uri(other)["bucket"], F.lit(False))


def join_key(*parts: Column) -> Column:
    """Parts joined by single slashes, empty parts left out."""
    trimmed = [F.btrim(F.coalesce(p, F.lit("")), F.lit("/")) for p in parts]
    return F.concat_ws("/", F.filter(F.array(*trimmed), lambda p: p != ""))


def table_prefix(warehouse: Column, namespace: Column, table: Column, part: str) -> Column:
    """``struct(bucket, prefix)`` of a table's ``data`` or ``metadata`` files."""
    parsed = parse_uri(warehouse)
    prefix = join_key(parsed["key"], namespace, table, F.lit(part))
    return F.when(
        parsed.isNotNull(),
        F.struct(parsed["bucket"].alias("bucket"), F.concat(prefix, F.lit("/")).alias("prefix")),
    )


def redact_uri(uri: Column) -> Column:
    """A URI with the password of ``user:password@`` masked."""
    return F.regexp_replace(uri, r"(?s)^(.*?://[^:@]*):[^@]*@", f"$1:{REDACTED}@")


#: Any of the tell-tale parts, wherever it stands in a name.
_SECRET = "(?i)" + "|".join(re.escape(part) for part in SECRET_NAME_PARTS)


def names_a_secret(name: Column) -> Column:
    return name.rlike(_SECRET)


def redact_properties(properties: Column) -> Column:
    """A string map with the values of secret-looking names masked."""
    return F.transform_values(
        properties, lambda k, v: F.when(names_a_secret(k), F.lit(REDACTED)).otherwise(v)
    )


def base_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def decode_key(key: Column) -> Column:
    """URL-decoded object key: ``+`` is a space, stray ``%`` stays as it is."""
    return F.try_url_decode(F.regexp_replace(key, r"%(?![0-9A-Fa-f]{2})", "%25"))


def masked(text: str) -> str:
    """Text for a log line: passwords in addresses and values of secret names hidden."""
    text = re.sub(r"(://[^:@/\s]*):[^@\s]*@", rf"\1:{REDACTED}@", text)
    return re.sub(rf"({_SECRET[4:]})([\w.-]*[\"']?\s*[=:]\s*[\"']?)[^\s,;\"'}}]+", rf"\1\2{REDACTED}", text, flags=re.I)
