"""Kafka-shaped stream sources and the batch notice sink.

The Kafka connector is a separate package; which source is used is configuration:
``format="kafka"`` reads brokers, any other format (``parquet``/``json``) reads files
holding rows of the Kafka record shape, which is how the tests and offline runs feed
the same code path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import KAFKA_RECORD


@dataclass
class StreamConf:
    format: str = "kafka"                      # "kafka" or a file format
    path: str | None = None                    # folder for file formats
    options: dict = field(default_factory=dict)  # e.g. kafka.bootstrap.servers
    starting_offsets: str = "earliest"
    max_files_per_trigger: int | None = None


def _read(spark: SparkSession, conf: StreamConf, kafka_opts: dict, wanted: Column) -> DataFrame:
    if conf.format == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", conf.starting_offsets)
        for k, v in {**conf.options, **kafka_opts}.items():
            r = r.option(k, v)
        return r.load()
    r = spark.readStream.format(conf.format).schema(KAFKA_RECORD)
    if conf.max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", conf.max_files_per_trigger)
    for k, v in conf.options.items():
        r = r.option(k, v)
    return r.load(conf.path).filter(wanted)     # a folder may hold several topics


def read_changes(spark: SparkSession, conf: StreamConf, topic_pattern: str) -> DataFrame:
    """Change topics selected by a regular expression (of the whole name), from the earliest offset."""
    return _read(spark, conf, {"subscribePattern": topic_pattern}, F.col("topic").rlike(f"^(?:{topic_pattern})$"))


def read_topic(spark: SparkSession, conf: StreamConf, topic: str) -> DataFrame:
    return _read(spark, conf, {"subscribe": topic}, F.col("topic") == F.lit(topic))


def kafka_record(df: DataFrame) -> DataFrame:
    """Key and value as text; the offset stays 64-bit (an int cast would wrap)."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("timestampType").cast("int").alias("timestampType"),
        F.col("value").cast("string").alias("value"),
    )


def publish(df: DataFrame, topic: str, fmt: str = "kafka", options: dict | None = None,
            path: str | None = None) -> None:
    """Batch-write a ``value`` column to a topic (or, offline, to a text/JSON folder)."""
    out = df.select(F.col("value").cast("string").alias("value"))
    if fmt == "kafka":
        w = out.write.format("kafka").option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        out.withColumn("topic", F.lit(topic)).write.mode("append").format(fmt).save(path)
