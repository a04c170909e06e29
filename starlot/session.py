"""Session settings and the shared folder used between jobs."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Applied only where the cluster has not set its own value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next join must shuffle again for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# Settings this process has made already, which a user may have changed since.
_DEFAULTED: set[str] = set()


def build_session(app: str = "starlot", **conf: str) -> SparkSession:
    """A session; keyword pairs use ``__`` for dots.

    The defaults above are set afterwards and only where neither the call, the cluster
    nor the session has a value: settings of a builder would win over the cluster's.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    own = {key for key, _ in spark.sparkContext.getConf().getAll()} | _DEFAULTED
    for key, value in DEFAULTS.items():
        if key not in own:
            spark.conf.set(key, value)
            _DEFAULTED.add(key)
    return spark


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the cluster's ``spark.checkpoint.dir``.

    Where that is unset only a local master may fall back to a folder of this
    machine, because executors elsewhere could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="starlot-")
    path = f"{base.rstrip('/')}/starlot-{purpose}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


_FOLDERS: list[str] = []
_TABLES: list[str] = []


def bucketed_table() -> str:
    """A new catalog name for files in a shared folder; dropped when this process ends, the files go with their folder."""
    _TABLES.append(f"starlot_{uuid.uuid4().hex}")
    return _TABLES[-1]


@atexit.register
def release_folders() -> None:
    """Delete the shared folders this process has made; also called when it ends.

    Tables read from them are gone afterwards.  Folders of a store that pyarrow cannot
    reach stay, for the cluster's own clean-up of ``spark.checkpoint.dir``.
    """
    spark = SparkSession.getActiveSession() if _TABLES else None
    while _TABLES:
        table = _TABLES.pop()
        if spark is not None and spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    while _FOLDERS:
        release(_FOLDERS[-1])


# With it Spark deletes the shuffles of a query when that has ended, instead of some time after the driver has dropped them.
RELEASE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC_SETTING = "spark.sql.parquet.compression.codec"
_WRITING: dict[SparkSession, int] = {}
_WRITING_LOCK = Lock()


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside leave no shuffle files behind; where the setting has a value already, that holds.

    Only for writes, which nobody runs a second time: a query that is run again would have to shuffle again.
    """
    with _WRITING_LOCK:
        own = spark in _WRITING or spark.conf.get(RELEASE_SETTING, None) is None
        if own:
            _WRITING[spark] = _WRITING.get(spark, 0) + 1
            spark.conf.set(RELEASE_SETTING, "true")
    try:
        yield
    finally:
        with _WRITING_LOCK:
            if own:
                _WRITING[spark] -= 1
                if not _WRITING[spark]:
                    del _WRITING[spark]
                    spark.conf.unset(RELEASE_SETTING)


def table_codec(spark: SparkSession) -> str:
    """How files are compressed: as cluster or caller have it, else by zstd, which takes about a third less than Spark's default."""
    held = spark.conf.get(CODEC_SETTING)
    return held if held != "snappy" or spark.sparkContext.getConf().contains(CODEC_SETTING) else "zstd"


def materialise(df: DataFrame, path: str, compact: bool = False) -> DataFrame:
    """Write ``df`` and go on from the written table: computed once, lineage cut.

    ``compact`` is for tables that are large on disk: ``table_codec``, and the shuffles behind them go with the write.
    """
    spark = df.sparkSession
    if compact:
        with releasing_shuffles(spark):
            df.write.mode("overwrite").option("compression", table_codec(spark)).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(path: str) -> None:
    """Delete one shared folder of this process before it ends; nothing may be read from it any more."""
    from pyarrow import fs

    if path in _FOLDERS:
        _FOLDERS.remove(path)
    try:
        files, inner = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        if files.get_file_info(inner).type == fs.FileType.Directory:
            files.delete_dir(inner)
    except (OSError, ValueError):
        pass
