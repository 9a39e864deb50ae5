"""JSON catalogs, overrides and dictionaries with tolerant shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manual_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """key, name, aliases of {"channels": {KEY: {"name", "aliases"}}}."""
    shape = "version int, channels map<string, struct<name:string, aliases:array<string>>>"
    return spark.read.schema(shape).json(path, multiLine=True).select(F.explode("channels").alias("key", "v")).select("key", "v.name", "v.aliases")


def learned_store(spark: SparkSession, path: str) -> DataFrame:
    """key, name, tvg_ids; identifiers may be texts or objects with id, observations and trusted."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "channels map<string, struct<name:string, tvg_ids:array<string>>>")["channels"]).alias("key", "v"))
    one = lambda t: F.when(t.startswith("{"), F.from_json(t, "id string, observations bigint, trusted boolean")).otherwise(
        F.struct(t.alias("id"), F.lit(1).cast("bigint").alias("observations"), F.lit(False).alias("trusted")))
    return raw.select("key", "v.name", F.transform("v.tvg_ids", one).alias("tvg_ids"))


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """key, source, channel_id of {"by_target_id": {key: {"source", "channel_id"}}}; an empty file gives no row."""
    shape = "by_target_id map<string, struct<source:string, channel_id:string>>"
    return spark.read.schema(shape).json(path, multiLine=True).select(F.explode("by_target_id").alias("key", "v")).select("key", "v.source", "v.channel_id")


def live_streams(spark: SparkSession, path: str) -> DataFrame:
    """name, tvg_id, group_id, stream_id, icon of a list of live streams."""
    shape = "name string, epg_channel_id string, category_id string, stream_id bigint, stream_icon string"
    return spark.read.schema(shape).json(path, multiLine=True).select("name", F.col("epg_channel_id").alias("tvg_id"), F.col("category_id").alias("group_id"), "stream_id", F.col("stream_icon").alias("icon"))
