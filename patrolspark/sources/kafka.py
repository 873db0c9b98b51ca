"""Keyed message topics.

The Kafka connector jar is not part of the stock PySpark distribution, so
these functions are only exercised up to the DataFrame they build; every job
in ``streaming`` accepts any streaming frame with ``key`` and ``value``
string columns (plus ``partition``/``offset`` when order matters), and the
tests drive them from file streams of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import HISTORIC_KEY, IMAGE_KEY, STANDARD_KEY, VIOLATION_KEY
from ..functions.codec import encode_image, encode_standard, encode_violation
from ..schemas import VIOLATION


ENCODERS = {STANDARD_KEY: encode_standard, VIOLATION_KEY: encode_violation,
            HISTORIC_KEY: encode_violation, IMAGE_KEY: encode_image}


def keyed_payload(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Every row as the message its key stands for, in the decoders' format.

    A constant key sends a whole topic to one partition.  With ``partitions``
    (the topic's count) each row also names its own, by a hash of the message,
    so the key still routes but no longer piles up; images keep theirs
    together per image id, whose order matters.
    """
    if key not in ENCODERS:
        raise ValueError(f"no message kind has key {key!r}")
    if ENCODERS[key] is encode_violation:  # every field of it is optional
        df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                              for f in VIOLATION.fields if f.name not in df.columns])
    out = df.select(F.lit(key).alias("key"), ENCODERS[key]().alias("value"),
                    *(["image_id"] if key == IMAGE_KEY else []))
    if partitions:
        by = F.col("image_id") if key == IMAGE_KEY else F.col("value")
        out = out.withColumn("partition", F.pmod(F.xxhash64(by), F.lit(partitions)).cast("int"))
    return out.drop("image_id")


def publish(df: DataFrame, key: str, topic: str, servers: str,
            checkpoint: str | None = None, partitions: int | None = None):
    """Send rows to a topic.  Batch frames write once; streaming frames start
    a query (``checkpoint`` required) and return it."""
    out = keyed_payload(df, key, partitions)
    if df.isStreaming:
        return (out.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", servers).option("topic", topic)
                .option("checkpointLocation", checkpoint).start())
    (out.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())
    return None


def keyed_stream(spark: SparkSession, topic: str, servers: str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None,
                 group_id_prefix: str | None = None) -> DataFrame:
    """Subscribe to a topic; progress lives in the query checkpoint.

    ``min_partitions`` lets Spark split one large topic partition over
    several tasks: images all travel under one key, so their partition can
    hold a third of the traffic.  Order inside the split is still given by
    ``partition, offset``.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if group_id_prefix:  # a named consumer, as seen by the broker's tooling
        r = r.option("groupIdPrefix", group_id_prefix)
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           "partition", "offset")
