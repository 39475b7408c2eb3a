"""Session settings the lake relies on, and where it may put files."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime settings; all can be changed on a running session.
SETTINGS = {
    # A repeated key in a JSON object is legal: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_local_folders: dict[str, str] = {}
_session_folders: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without the
    setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="evlake-")
        folder = _local_folders[context.applicationId]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's part of the shared folder; nothing is created
    yet. That part is deleted when the session's driver ends."""
    context = spark.sparkContext
    own = f"{shared_folder(spark)}/session-{context.applicationId}"
    if own not in _session_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _session_folders.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"
