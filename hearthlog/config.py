"""Session settings and tunables shared by the batch and streaming jobs."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

#: Dictionaries measured at or below this size are broadcast; larger ones are shuffled.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

#: Ways a hot (product, fault) pair of a stream is split when the dictionary is too big to
#: broadcast. A batch leaves that to adaptive execution, which splits only what is skewed.
STREAM_SALTS = 16


def configure_session(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Set the two session options the results depend on.

    ``time_zone`` decides where one day ends and the next begins. LAST_WIN lets
    ``payload_map`` keep the last of several equal keys instead of failing.
    """
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    All folders of an application lie in one that bears its id. What is in it is scratch:
    the application owns it, and it can be removed as a whole once that has ended.

    Only a local session without that setting (tests, smoke runs) falls back to a
    temporary folder of this machine, and says so; on a cluster that would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="hearthlog-")
        log.warning("spark.checkpoint.dir is not set: scratch data goes to %s", root)
    application = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/{application}/{name}-{uuid.uuid4()}"
