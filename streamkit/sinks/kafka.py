"""Kafka sink (O7): string values to a topic.  Needs the spark-sql-kafka
connector on the classpath."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kafka_sink(df: DataFrame, topic: str, bootstrap_servers: str, value: Column | None = None):
    out = df.select((value if value is not None else F.col(df.columns[0])).cast("string").alias("value"))
    writer = out.writeStream if out.isStreaming else out.write
    return writer.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
