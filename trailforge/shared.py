"""The folder that driver and executors share, and tables in it that cut lineage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset: a folder of this machine in local mode, an error on a cluster."""
    found = spark.conf.get(KEY, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{KEY} must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='trailforge-')}"
        spark.conf.set(KEY, found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read it back. Survives the loss of executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Removes all that this application has put into the shared folder; to be called when no result is needed any more."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(hadoop).delete(at, True)
    return len(paths)


def give_back(spark: SparkSession) -> None:
    """Hands memory that the driver has freed back to the system: garbage of either heap, and what malloc keeps.

    Plans and generated code of many small jobs pass through the driver's native memory, of which malloc keeps hundreds of
    MB in its arenas. A JVM or libc that can't trim leaves them as they are.
    """
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    try:
        name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server, gateway = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), spark.sparkContext._gateway
        given = gateway.new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = name, "systemTrimNativeHeap"
        kinds = gateway.new_array(jvm.java.lang.Class, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = jvm.java.lang.Class.forName(kind)
        # The server's own class isn't open to py4j, its interface is.
        jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, given)
    except (Py4JError, TypeError):
        pass


#: Tables of at most so many bytes (as the optimizer estimates them) are dealt to all cores.
SMALL = 256_000_000


def spread(df: DataFrame, most: int = SMALL) -> DataFrame:
    """A small table, which may lie in one row group of one file, dealt evenly to all cores; a larger one as it is."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if int(str(size)) <= most else df
