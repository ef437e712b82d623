"""Session helpers: sane defaults for the library and the shared checkpoint folder.

The library never builds its own cluster settings into query code. Queries take the
session they are given; these helpers exist for tests, the bench and local runs.
"""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query here relies on. Time zone UTC keeps event-time windows on the
# epoch grid and makes batch and stream results comparable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # merge a hot key's rows into partial sessions inside each partition before the
    # shuffle of a streaming session window
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "rillflow", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (``local[cores]``). As all of it runs on one machine
    a new temporary folder serves as the shared one, unless ``RILLFLOW_CHECKPOINT_DIR`` or
    ``extra`` names another."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RILLFLOW_DRIVER_MEMORY", "4g")
    conf["spark.checkpoint.dir"] = os.environ.get("RILLFLOW_CHECKPOINT_DIR") or _own_folder()
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="rillflow-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the context; the
    session is not changed. Only where neither is set and all of Spark is one process on this
    machine (a ``local`` master, as in tests) a temporary folder serves; elsewhere there would
    be no place that all executors share, and this raises."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") \
        or sc.getCheckpointDir()
    if not d:
        if re.match(r"local(\[|$)", sc.master):
            return _own_folder()
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return d.rstrip("/")


def require_utc(spark: SparkSession) -> None:
    """Event times without a zone are read as UTC. A session in another zone would move them, and
    merge two of them where its clock is set back, so it is refused."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.removeprefix("Etc/") not in ("UTC", "GMT", "UCT", "Zulu", "Universal", "Z", "+00:00", "GMT0", "Greenwich"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir (streaming checkpoints,
    sink output, snapshot tables)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base, "rillflow", *parts, uuid.uuid4().hex])
