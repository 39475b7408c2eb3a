"""Results depend on each of them being exactly this."""

# Field spellings, tried from left to right.
SIZE_FIELDS = ["size", "objectSize", "Size", "contentLength"]
ETAG_FIELDS = ["eTag", "etag", "ETag"]
KEY_FIELDS = ["key", "Key", "objectKey"]
BUCKET_FIELDS = ["name", "Name", "bucketName"]
NAME_FIELDS = ["eventName", "EventName", "event_name", "eventType"]
TIME_FIELDS = ["eventTime", "EventTime", "event_time", "eventTimestamp"]
SOURCE_FIELDS = ["eventSource", "EventSource", "event_source"]

# Epoch numbers above this magnitude are milliseconds, below it seconds.
EPOCH_MILLIS_ABOVE = 1e11

# Longest part of an undecodable payload shown in the quarantine.
PAYLOAD_PREVIEW = 500

# Name parts that mark a property value as secret, and what replaces it.
SECRET_NAME_PARTS = ["secret", "password", "token", "credential", "access-key-id", "access_key_id"]
REDACTED = "<redacted>"

# Batching and retry defaults.
BATCH_SIZE = 100
MAX_MESSAGES = 1_000_000
MAX_FILES = 1000
FLUSH_INTERVAL_SECONDS = 10.0
MAX_WRITE_ATTEMPTS = 5
RETRY_BASE_SECONDS = 5.0
RETRY_CAP_SECONDS = 60.0

# Progress report: samples kept, objects and commits shown, scale stops.
HISTORY_SAMPLES = 72
LATEST_OBJECTS = 6
LATEST_COMMITS = 5
SCALE_STOPS = [
    10, 20, 50, 100, 200, 500, 1000, 2000, 5000,
    10000, 20000, 50000, 100000, 200000, 500000, 1000000,
]

# Rows shown by the latest-events report.
LATEST_EVENTS = 20

# Namespaces a table reset refuses to touch.
PROTECTED_NAMESPACES = ["", "default", "information_schema", "system", "*"]

# Characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
