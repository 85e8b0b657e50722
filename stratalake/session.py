"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. All are plain SQL settings, so they
# can be applied to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A lookup key or a NULL key that holds a large share of the rows is split
    # at run time instead of landing in one reducer.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Of written tables: surrogate keys are hex digits, which the default leaves as they are.
COMPRESSION = "zstd"
# Bounds what the driver keeps per shuffle.
MAX_PARTITIONS = 100_000
# Paths given out by scratch_path.
_SCRATCH: list[str] = []
# The planner's estimate for rows of unknown size is the largest number there is.
UNKNOWN_BYTES = 1 << 60
# What one task should get to see.
TARGET_BYTES = 128 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = 8, app: str = "stratalake", memory: str = "12g", scratch: str | None = None
) -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scanned_bytes(df: DataFrame) -> int:
    """The planner's estimate of what ``df`` reads.

    The leaves are summed, because estimates further up a plan multiply the
    sides of a join.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def partitions_for(df: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """Shuffle partitions for a full shuffle of ``df``: the session's setting, or
    more when the files read would overfill them."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, min(MAX_PARTITIONS, -(-scanned_bytes(df) // target_bytes)))


def tasks_for(target_bytes: int, *inputs: DataFrame) -> int:
    """Tasks of which each sees about ``target_bytes`` of the files read, and at least one for every core where so many are configured.

    For an explicit ``repartition``, whose tasks adaptive execution leaves as they are: where it
    merges them, it goes by compressed bytes, and a task's memory may be fifty times of that. Rows that
    are not read from files, whose size nobody knows, get the configured number.
    """
    spark = inputs[0].sparkSession
    configured, read = int(spark.conf.get("spark.sql.shuffle.partitions")), sum(map(scanned_bytes, inputs))
    if read >= UNKNOWN_BYTES:
        return configured
    return max(min(configured, spark.sparkContext.defaultParallelism), min(MAX_PARTITIONS, -(-read // target_bytes)))


@contextlib.contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[int]:
    """Raise the session's shuffle partitions to what the largest input needs, for the jobs that run inside.

    Too many are harmless, because adaptive execution merges small ones; too
    few cannot be repaired at run time.
    """
    spark = inputs[0].sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = max(partitions_for(df) for df in inputs)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a machine-local folder, because there the one machine is the
    whole cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="stratalake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has made so far; returns their number.

    For the end of a job: results that still read them have to be written first.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    dropped = 0
    while _SCRATCH:
        folder = hadoop.Path(_SCRATCH.pop())
        dropped += bool(folder.getFileSystem(conf).delete(folder, True))
    return dropped


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor, and it freezes
    values that another evaluation of the plan could compute differently, such
    as partition numbers after range sampling. Being columnar, a later reader
    of two columns reads two columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", COMPRESSION).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`materialize` made, once all that was derived from it has been written itself."""
    spark = table.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(table._scratch)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
