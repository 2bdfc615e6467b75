import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

# The 24 two-token demo lines (the only data file of the
# original programs), in file order.
LINES = [
    "Java MySQL", "Linux JavaWeb", "Java8 JVM", "JUC NIO", "Spring SpringMVC", "MyBatis Struts2",
    "Hibernate SpringBoot", "SpringCloud Log4j", "Logback SLF4J", "EhCache GuavaCache", "Redis Kafka",
    "RabbitMQ Dubbo", "CXF HttpClient", "Git SVN", "Lucene Solr", "ElasticSearch CDH", "Hive HBase",
    "Hadoop Flink", "Storm Spark", "Scala Python", "Presto Oozie", "Zookeeper Flume", "Sqoop Azkaban",
    "Impala Jenkins",
]


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="streamkit-test-ckpt-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("streamkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lines_file(tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(LINES), encoding="utf-8")  # no final newline, as the original
    return str(path)


@pytest.fixture()
def lines_df(spark):
    """The demo lines with an explicit line number."""
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "seq long, value string")
