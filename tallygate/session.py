"""Session helpers: the pins the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Local wall-clock timestamps are TIMESTAMP_NTZ.  A few Spark functions route NTZ values through
# the session zone (date_trunc, timestampdiff); UTC has no gaps, so that detour is the identity.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Adaptive execution re-plans joins from measured sizes: small sides become broadcasts, hot
# partitions are split, tiny ones are merged.  No operator forces a broadcast of its own.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tallygate", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**PINNED, **ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the pins to a session somebody else created (they are runtime settings)."""
    for key, value in PINNED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A private temporary folder, removed at exit, is used only where the setting is absent and the master is local,
    i.e. in tests; on a cluster a missing setting is an error, because a machine-local folder does
    not survive the loss of its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.conf.get("spark.app.id", "local")
    if application not in _LOCAL_FOLDERS:
        folder = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_FOLDERS[application] = folder
    return _LOCAL_FOLDERS[application]
