"""Intermediate tables: who made them, when they go, and tables that several queries share.

Every intermediate lies in ``tallygate/<application id>/`` of the shared checkpoint folder.  Inside
``with intermediates(spark):`` the tables made there are deleted when the block ends, also after a
failure; what the block returns must be written elsewhere by then.  All others are deleted by
``release_intermediates`` or when the application ends.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallygate.session import checkpoint_folder

_made: dict[str, list[str]] = {}
_shared: dict[tuple, tuple[str, StructType]] = {}
_sessions: dict[str, SparkSession] = {}


def _application(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "local")


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder for one intermediate table, to be deleted later."""
    application = _application(spark)
    folder = f"{checkpoint_folder(spark)}/tallygate/{application}/{name}-{uuid.uuid4().hex}"
    if application not in _made:
        _made[application] = []
        _sessions[application] = spark
        atexit.register(_at_exit, application)
    _made[application].append(folder)
    return folder


def delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        fs, place = _at(spark, folder)
        fs.delete(place, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables made in the block are deleted when it ends; shared tables stay."""
    before = set(_made.get(_application(spark), ()))
    try:
        yield
    finally:
        own = _made.get(_application(spark), [])
        shared = {folder for folder, _ in _shared.values()}
        gone = [f for f in own if f not in before and f not in shared]
        delete(spark, gone)
        own[:] = [f for f in own if f not in gone]


def release_intermediates(spark: SparkSession) -> None:
    """Delete every intermediate of the application, shared ones included."""
    folders = _made.get(_application(spark), [])
    for key in [k for k, (folder, _) in _shared.items() if folder in set(folders)]:
        del _shared[key]
    delete(spark, folders)
    folders.clear()


def _at_exit(application: str) -> None:
    # works for a stopped session too: only the file system is needed
    spark, folders = _sessions.pop(application), _made.pop(application, [])
    try:
        delete(spark, folders)
    except Exception:  # noqa: BLE001 - the JVM may be gone before the interpreter ends
        pass


def identity(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """(file, bytes, time of last change) of every file below the paths: what a copy was made of."""
    found = []
    for path in paths:
        fs, place = _at(spark, path)
        files = fs.listFiles(place, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def shared_table(
    spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """The table ``build`` gives, written once for an application and a state of its sources.

    Queries that start from the same stage read one copy.  A changed, added or removed source file
    makes it anew; so does a copy that somebody deleted.
    """
    key = (_application(spark), name, identity(spark, sources))
    if key in _shared:
        folder, schema = _shared[key]
        fs, place = _at(spark, folder)
        if fs.exists(place):
            return spark.read.schema(schema).parquet(folder)
    df = build()
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    _shared[key] = (folder, df.schema)
    return spark.read.schema(df.schema).parquet(folder)
