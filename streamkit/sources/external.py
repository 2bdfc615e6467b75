"""Socket and Kafka line sources.

Both are thin option mappings onto Spark's built-in streaming sources.
The socket source is for demos only (not fault tolerant, newline records).
The Kafka source needs the ``spark-sql-kafka`` connector on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def socket_text_stream(spark: SparkSession, host: str, port: int, delimiter: str = "\n") -> DataFrame:
    """Lines from ``host:port``; column ``value``.  Only ``\\n`` delimits records."""
    if delimiter != "\n":
        raise ValueError("the socket source splits records on newline only")
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


# Consumer property names mapped to Spark Kafka source options; properties the
# source has no use for (a ZooKeeper address) are dropped.
_DROPPED = {"zookeeper.connect"}


def kafka_options(topic: str, properties: dict[str, str]) -> dict[str, str]:
    opts = {"subscribe": topic}
    for key, value in properties.items():
        if key in _DROPPED:
            continue
        opts[f"kafka.{key}"] = value
    return opts


def kafka_source(spark: SparkSession, topic: str, properties: dict[str, str], streaming: bool = True) -> DataFrame:
    """String values of ``topic`` as column ``value``, with ``timestamp`` and
    the order of arrival, ``partition`` and ``offset``."""
    reader = spark.readStream if streaming else spark.read
    df = reader.format("kafka").options(**kafka_options(topic, properties)).load()
    return df.select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")
