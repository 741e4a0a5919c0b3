"""Message streams and landed API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.functions.text import parsed_once, sorted_json, truthy

MESSAGE_SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
META = ("topic", "partition", "offset", "timestamp", "key")
NO_OBJECT = "value is not a JSON object"


def read_messages(spark: SparkSession, streaming: bool = False, format: str = "kafka", **options: str) -> DataFrame:
    """A1: messages with Kafka's columns; ``key`` and ``value`` as text.

    ``format="kafka"`` needs the connector package on the cluster; any file format with the same columns
    works too.
    """
    reader = (spark.readStream if streaming else spark.read).format(format).options(**options)
    if format != "kafka":
        reader = reader.schema(MESSAGE_SCHEMA)
    raw = reader.load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset", "timestamp")


def _checked(raw: DataFrame) -> DataFrame:
    """Messages that are not empty, with ``_ok``: whether the value is a JSON object."""
    opens = F.ltrim("value", F.lit(" \t\r\n\ufeff")).startswith("{")  # JSON that opens so is an object
    return raw.filter(truthy(F.trim("value"))).withColumn("_ok", opens & F.try_parse_json("value").isNotNull())


def parse_messages(raw: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Parsed messages with their metadata, and a dead-letter table of values that are no JSON object.

    The message's own time is named ``message_time``.  Empty values are no messages and appear in
    neither.
    """
    rows = _checked(raw)
    meta = [F.col(c).alias(f"msg_{c}") for c in META]
    good = rows.filter("_ok").select(*meta, parsed_once(F.from_json("value", schema)).alias("m")).select(
        *[F.col(f"msg_{c}").alias("message_time" if c == "timestamp" else c) for c in META], "m.*")
    dead = rows.filter("NOT _ok").select(*META, "value", F.lit(NO_OBJECT).alias("error"))
    return good, dead


def judged_messages(raw: DataFrame, schema: str) -> DataFrame:
    """All messages of ``parse_messages`` in one table, to be kept where both kinds are read: ``error`` is null for the parsed
    ones, and a dead letter has no fields."""
    checked = parsed_once(F.struct("_ok", F.when(F.col("_ok"), F.from_json("value", schema)).alias("m")))
    rows = _checked(raw).select(*[F.col(c).alias(f"msg_{c}") for c in META], checked.alias("c"))
    return rows.select(*[F.col(f"msg_{c}").alias("message_time" if c == "timestamp" else c) for c in META],
                       F.when(~F.col("c._ok"), F.lit(NO_OBJECT)).alias("error"), "c.m.*")


def raw_archive(raw: DataFrame) -> DataFrame:
    """A2: topic, partition, offset, key and the value as key-sorted JSON, numbers as they were written."""
    rows = raw.select(
        F.coalesce("topic", F.lit("")).alias("topic"), F.coalesce("partition", F.lit(0)).alias("partition"),
        F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"), "key", sorted_json(F.col("value")).alias("value"))
    return rows.filter(F.col("value").isNotNull())


def not_json(raw: DataFrame) -> DataFrame:
    """The messages that the archive cannot hold."""
    return raw.withColumn("_json", sorted_json(F.col("value"))).filter(F.col("value").isNotNull() & F.col("_json").isNull()).select("topic", "partition", "offset", F.lit("value is not JSON").alias("error"))


def read_payloads(spark: SparkSession, path: str, data_schema: str) -> DataFrame:
    """Landed responses ``{url, status_code, data}``; ``data_schema`` is the DDL type of ``data``."""
    rows = spark.read.schema(f"url string, status_code int, data {data_schema}").json(path)
    return rows.withColumn("_pos", F.monotonically_increasing_id())


def payload_records(rows: DataFrame, where: Column | None = None) -> DataFrame:
    """Records of a list payload with their position."""
    picked = rows if where is None else rows.filter(where)
    listed = picked.select("url", "_pos", F.posexplode("data").alias("_i", "r"))
    return listed.select("url", F.struct("_pos", "_i").alias("_pos"), "r.*")


def job_rows(rows: DataFrame) -> DataFrame:
    """Queued then running jobs, stamped with the second-last URL segment."""
    listed = lambda c, kind: rows.select(
        F.element_at(F.split("url", "/"), -2).alias("compute_resource_id"), "_pos", F.lit(kind).alias("_k"),
        F.posexplode(c).alias("_i", "r"))
    both = listed("data.queued", 0).unionByName(listed("data.running", 1))
    return both.select(F.struct("_pos", "_k", "_i").alias("_pos"), "compute_resource_id", "r.*")
