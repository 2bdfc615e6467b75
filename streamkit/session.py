"""Session construction and shared settings."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "streamkit",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for these operators.

    AQE is on (runtime coalescing, skew-join splitting, runtime broadcast
    conversion only below the threshold it measures); the UI is off; the
    session time zone is UTC so event-time arithmetic is zone-free.
    """
    cpus = os.cpu_count() or 8
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stopGracefullyOnShutdown": "true",
    }
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Streams, stage tables and sinks keep their files there, so on a cluster it
    must be set to a folder that driver and executors share.  Only a local
    master, where one machine runs everything, may leave it unset; a temporary
    folder then serves the application.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = _OWN.get(context.applicationId) or _OWN.setdefault(context.applicationId, tempfile.mkdtemp(prefix="streamkit-ckpt-"))
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Checkpoint folders of local applications, by application id.
_OWN: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    their Python workers can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="streamkit-ship-"), "streamkit.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def release_heap(spark: SparkSession) -> None:
    """Give the executors' unused heap back to the machine: what one step made
    the heap grow to stays, next to the Python workers of the steps after it,
    until a full collection; one task per core asks for it."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def streaming_checkpoint(spark: SparkSession, query_name: str) -> str:
    """Per-query streaming checkpoint location under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", query_name)


def cluster_conf(total_cores: int, large_state: bool = True) -> dict[str, str]:
    """Settings for a large cluster (pass as ``extra_conf`` to ``build_session``
    or to ``spark-submit --conf``).

    * shuffle partitions ~3x the cores; AQE coalesces small ones and splits
      skewed join partitions at run time;
    * 256 MB scan splits (the parquet reader splits by row group);
    * streaming state in RocksDB (off-heap, spills to local disk) with
      changelog checkpointing, so state larger than memory is fine and
      checkpoints upload only the changes.
    """
    conf = {
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
    }
    if large_state:
        conf.update({
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        })
    return conf
