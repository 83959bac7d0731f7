"""Where a session's jobs may leave files that all machines reach, and how they go again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}
_given: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: ``spark.checkpoint.dir``.

    Only where the session has none and is local (tests, a single machine) a temporary folder stands in:
    on a cluster, files of one machine's folder would be missing on the others, so that is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-ledgerloom-")
    return _own[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``remove_landed`` knows of it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def landed_so_far(spark: SparkSession) -> int:
    """How many paths the session has given out: a mark for ``remove_landed``."""
    return len(_given.get(spark.sparkContext.applicationId, []))


def remove_landed(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete what the session's jobs have left since a mark, but for the paths to keep.

    Results that still read those files must have been written elsewhere by then.
    """
    given = _given.get(spark.sparkContext.applicationId, [])
    gone, given[since:] = [x for x in given[since:] if x not in keep], [x for x in given[since:] if x in keep]
    for path in gone:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
