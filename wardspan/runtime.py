"""Session defaults and the shared scratch area for tables written between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

_OWN_ROOT: dict[str, str] = {}
_RUN: ContextVar[str] = ContextVar("run", default="shared")

_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PARTITIONS = "spark.sql.shuffle.partitions"
_FILE_FACTOR = "spark.sql.sources.fileCompressionFactor"

# Bytes that the rows of a side may take and still be broadcast: text as it is, 16 for each column.
BROADCAST_BYTES = 64 << 20
# What Spark should take a table for, times the size of its files, when it chooses what to broadcast. Rows
# of the tables here take 20 to 50 times their files in a hash table, which the driver builds.
FILE_FACTOR = 6
# Rows that a task should sort where all rows of a key must lie in one partition.
SORT_ROWS = 500_000
# Rows of both sides that a task of a join should sort; it holds them all, so their number is its memory.
JOIN_ROWS = 1_000_000


def session(app: str, cores: int | str = "*", **extra: str) -> SparkSession:
    """Local session for tests and the bench. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, so that every executor sees it
    and tables outlive any executor. Only a local session may fall back to a folder of its own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _OWN_ROOT:
            _OWN_ROOT[context.applicationId] = tempfile.mkdtemp(prefix="wardspan-", dir="/tmp")
        root = _OWN_ROOT[context.applicationId]
    return f"{root.rstrip('/')}/wardspan-{context.applicationId}/{_RUN.get()}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch area and read it back.

    Cuts lineage like a checkpoint, but later readers still get column pruning, pushed filters and
    real sizes for join planning.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    written(df).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> DataFrameWriter:
    """A writer of Parquet that takes less disk than the default codec."""
    return df.write.option("compression", "zstd")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder of the scratch area that no other call gets."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application staged. Frames that still read staged tables break, so
    call it when their results are written."""
    remove_folder(spark, scratch_root(spark).rpartition("/")[0])


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Give one run its own part of the scratch area and remove that part, and nothing else, after."""
    token = _RUN.set(f"run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove_folder(spark, scratch_root(spark))
        _RUN.reset(token)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of each query that ends meanwhile. Otherwise they stay until
    the driver collects its garbage, which a driver with memory to spare does late."""
    with _setting(spark, _SHUFFLES_GO, "true"):
        yield


@contextmanager
def real_sizes(spark: SparkSession) -> Iterator[None]:
    """Have Spark not go by the size of files alone when it chooses what to broadcast meanwhile: a table of
    millions of rows may have files within its limit, and the driver builds the hash table of them."""
    given = float(spark.conf.get(_FILE_FACTOR))
    with _setting(spark, _FILE_FACTOR, str(max(given, FILE_FACTOR))):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[bool]:
    """Stage a join of about ``rows`` rows of both sides in this, and no task sorts too many of them: the
    session has as many partitions meanwhile as that needs. Tells whether they are more than it had.
    Spark deals the rows itself, so that the adaptive skew join still splits hot keys, which it does
    not behind ``repartition``."""
    needed = -(-rows // JOIN_ROWS)
    if needed <= int(spark.conf.get(_PARTITIONS)):
        yield False
        return
    with _setting(spark, _PARTITIONS, str(needed)):
        yield True


def stage_measured(df: DataFrame) -> tuple[DataFrame, int]:
    """Stage a narrow side and add up the bytes of its rows. Rows are measured, not files, as these
    may be many times smaller."""
    side = stage(df, "side")
    lengths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    (size,) = side.agg(F.coalesce(F.sum(sum(lengths, F.lit(0))), F.lit(0))).first()
    return side, size


def spread(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as about ``rows`` rows need, if those of the session are
    fewer. Adaptive execution merges partitions but splits none that a window reads, so their size
    would grow with the input. For windows and groups; joins are left to the adaptive skew join."""
    needed = -(-(rows or 0) // SORT_ROWS)
    given = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(needed, *keys) if needed > given else df


def broadcast_within(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Stage a narrow side, and have it broadcast only if its rows take at most ``max_bytes``.

    Beyond that the join is a shuffled one, in which the adaptive skew join splits hot keys.
    """
    side, size = stage_measured(df)
    return F.broadcast(side) if size <= max_bytes else side.hint("merge")
