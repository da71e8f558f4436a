"""Session, tables and lineage cuts shared by all operators."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TAMARIND_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known_to_workers(spark)
    return spark


def known_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, whatever their host and working directory are.

    On one machine, local clusters included, the workers get the driver's path; to others the package is shipped, once.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    paths = [x for x in context.environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
        if not context.master.startswith("local"):
            made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tamarind-package-"), "tamarind"), "zip", root, "tamarind")
            context.addPyFile(made)  # copied by Spark to every executor; the driver's copy is not read by them


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; the schema comes from its footer."""
    known_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    """The checkpoint folder: the cluster's ``spark.checkpoint.dir``; on one machine, where that is unset, one of its own."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tamarind-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from there; its files are shared, so a lost executor costs nothing."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, as a Parquet table in the same folder: smaller on disk, read by column; row order is not kept."""
    path = f"{_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tamarind_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the files of a :func:`cut_table` that nothing reads any more."""
    jvm, path = df.sparkSession._jvm, df._tamarind_path
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are done, which it does when the driver collects garbage.

    What Python no longer refers to is told to the JVM by a thread that may sleep a second between; until then the JVM keeps it, and
    its files. So whatever that thread has not done yet is done here first.
    """
    gc.collect()
    client = spark.sparkContext._gateway._gateway_client
    waiting = getattr(client, "finalizer_deque", None)
    for _ in range(len(waiting or ())):
        try:
            task = waiting.pop()
        except IndexError:
            break
        if isinstance(task, tuple):
            task[0].garbage_collect_object(task[1], False)
        else:
            waiting.append(task)
            break
    spark._jvm.System.gc()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a CPU-bound Python stage enough tasks where the scan would make fewer than there are cores.

    The scan's tasks are estimated from the size of the files and the scan's own settings, so nothing is run to find out. A
    large table has more splits than cores and is left alone, so nothing is shuffled at scale.
    """
    spark = df.sparkSession
    wanted = 2 * spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= wanted or _scan_tasks(df) >= wanted:
        return df
    return df.repartition(wanted, *keys)


def _scan_tasks(df: DataFrame) -> int:
    """How many splits the files of a scan make, at least."""
    spark = df.sparkSession
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        total += at.getFileSystem(hadoop).getFileStatus(at).getLen()
    return int(total // most)


def small_enough(df: DataFrame, most_rows: int) -> bool:
    """Whether ``df`` has at most ``most_rows`` rows; reads no further than that."""
    return df.limit(most_rows + 1).count() <= most_rows


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows it, else as it is, for a shuffled join."""
    return F.broadcast(df) if small_enough(df, most_rows) else df
