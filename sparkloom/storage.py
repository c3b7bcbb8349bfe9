"""Tables written between steps: they cut lineage, and a lost executor costs no recomputation."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: For sessions on one machine that name no folder, as in tests.
LOCAL_DIR = "/tmp/checkpoints/sparkloom"
#: Whether a query's shuffle files go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders that this process has made and not deleted yet.
FOLDERS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's.  A
    session on one machine without either gets one here; on a cluster that raises, as each
    executor would write to a disk of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        if java.isDefined():
            folder = java.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            spark.sparkContext.setCheckpointDir(LOCAL_DIR)
            folder = LOCAL_DIR
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    FOLDERS.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return FOLDERS[-1]


def clean(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the folders made so far, from the ``since``-th on: to be called when the rows of all
    queries before have been written or fetched, as results are read from these folders."""
    for path in FOLDERS[since:]:
        if path not in keep:
            delete_path(spark, path)
    FOLDERS[since:] = [x for x in FOLDERS[since:] if x in keep]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside leaves no shuffle files behind, so steps need the disk of the largest, not of all."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def give_back(spark: SparkSession) -> None:
    """Return what the driver has freed to the system, between steps that plan much: a driver that lives on keeps its heap
    at the largest size of any step otherwise.  First Python, whose dead handles hold plans in the JVM, then the JVM, whose
    collection lets Spark drop the broadcasts and shuffles of dead plans; then both C libraries, where they can."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
    with contextlib.suppress(Py4JError):  # a command of newer HotSpot JVMs, by the public interface of their beans
        jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
        args = array(jvm.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)


def path_of(df: DataFrame) -> str:
    files = df.inputFiles()
    return files[0].rsplit("/", 1)[0] if files else ""


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through Hadoop's file systems, wherever it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def dispose(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in frames:
        if path := path_of(df):
            delete_path(df.sparkSession, path)
            name = path.rsplit("/", 1)[1]
            FOLDERS[:] = [x for x in FOLDERS if x.rsplit("/", 1)[1] != name]
