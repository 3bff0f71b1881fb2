"""Messages in and out: landing folders or a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.operators.numbering import numbered
from noticehouse.spec import FeedSpec

# Fixed value: ISO text of the fetch stamp.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def landing_stream(
    spark: SparkSession, path: str, file_format: str = "text", **options: object
) -> DataFrame:
    """Messages from files in a landing folder, one ``value`` per line or row."""
    reader = spark.readStream.format(file_format).schema("value string")
    return reader.options(recursiveFileLookup="true", **options).load(path)


def topic_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest"
) -> DataFrame:
    """Messages from a topic; needs Spark's connector package on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def envelope(
    records: DataFrame, spec: FeedSpec, fetched_at: Column | None = None
) -> Column:
    """A record as message text: its fields, nulls included, and the fetch stamp."""
    moment = F.current_timestamp() if fetched_at is None else fetched_at
    stamp = F.date_format(moment, STAMP_FORMAT).alias(spec.ingest_time)
    fields = [c for c in records.columns if c != spec.ingest_time]
    return F.to_json(F.struct(*fields, stamp), {"ignoreNullFields": "false"})


def replay(silver: DataFrame, spec: FeedSpec, ordered: bool = True) -> DataFrame:
    """Stored payloads of the current rows, as messages, with their ``id``: the place
    in insertion order.

    ``ordered`` rows are sorted by it; a topic keeps order only within a partition,
    so ``ordered=False`` saves that sink a shuffle, and the id tells the order.
    """
    stored = silver.where(F.col(spec.payload).isNotNull())
    columns = [F.col(spec.payload).alias("value"), spec.inserted_at, spec.key]
    messages = numbered(stored.select(*columns), [spec.inserted_at, spec.key]).select("id", "value")
    return messages.orderBy("id") if ordered else messages


def replay_bronze(bronze: DataFrame, batch: str, ordered: bool = True) -> DataFrame:
    """Every stored message, in batch order; within a batch in the order of a
    hash, so that a large batch is sorted by many tasks."""
    if ordered:
        bronze = bronze.orderBy(batch, F.xxhash64("raw_json"))
    return bronze.select(F.col("raw_json").alias("value"))


def write_messages(
    messages: DataFrame, path: str, file_format: str = "text", **options: object
) -> None:
    if file_format == "parquet":
        # Texts are all different: no dictionary is tried.
        options = {"parquet.enable.dictionary#value": "false", **options}
    messages.select("value").write.format(file_format).options(**options).mode("append").save(path)


def send_to_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Messages to a topic; needs the same connector package as the source."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
