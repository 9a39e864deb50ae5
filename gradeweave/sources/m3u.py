"""Playlists: lines of text to entries and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import ENTITIES
from ..operators import series

VIDEO_FILE = r"(?i)\.(?:mp4|mkv|avi|mov|wmv|flv|webm)(?:\?.*)?$"
URL = r"(?i)^(?:https?|rtmp|rtsp)://"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """playlist, line_no, text of every line of the files; a file is read as one text, as its lines are numbered."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("playlist"), F.split("value", r"\r\n|\r|\n").alias("l"))
    return whole.select("playlist", F.posexplode("l").alias("line_no", "text"))


def attribute(text: Column, name: str) -> Column:
    return F.trim(F.regexp_extract(text, rf'(?i){name}="([^"]*)"', 1))


def display_name(text: Column) -> Column:
    """What stands after the first comma outside quotes; without one, the tvg-name."""
    after = F.trim(F.regexp_extract(text, r'^[^",]*(?:"[^"]*"[^",]*)*,(.*)$', 1))
    return F.when(after == "", attribute(text, "tvg-name")).otherwise(after)


def name_after_last_comma(text: Column) -> Column:
    return F.trim(F.regexp_extract(text, r",([^,]*)$", 1))


def parse(lines: DataFrame, keep_files: bool = False) -> DataFrame:
    """playlist, line_no, tvg_id, tvg_name, group_title, display_name, url of each entry; the address is the next line.

    Entries whose address is a video file are left out unless asked for.
    """
    numbered = series.with_previous(lines.withColumn("neg", -F.col("line_no").cast("bigint")), ["playlist"], "neg", (), "text", "following", 10_000)
    e = numbered.filter(F.trim("text").rlike(r"(?i)^#EXTINF|tvg-.*,")).select(
        "playlist", "line_no", *(attribute(F.col("text"), a).alias(b) for a, b in (("tvg-id", "tvg_id"), ("tvg-name", "tvg_name"), ("group-title", "group_title"))),
        display_name(F.col("text")).alias("display_name"), F.when(F.trim("following").rlike(URL), F.trim("following")).alias("url"))
    for a, b in ENTITIES:
        e = e.withColumns({c: F.replace(c, F.lit(a), F.lit(b)) for c in ("tvg_name", "group_title", "display_name")})
    return e if keep_files else e.filter(~F.coalesce(F.col("url").rlike(VIDEO_FILE), F.lit(False)))


def set_attribute(text: Column, name: str, value: Column) -> Column:
    """The line with the attribute set, or added after the duration if it is not there."""
    shown = F.concat(F.lit(f'{name}="'), F.coalesce(value, F.lit("")), F.lit('"'))
    return F.when(
        text.rlike(rf'{name}="[^"]*"'),
        F.concat(F.regexp_extract(text, rf'^(.*?){name}="[^"]*"', 1), shown, F.regexp_extract(text, rf'^.*?{name}="[^"]*"(.*)$', 1)),
    ).otherwise(F.concat(F.regexp_extract(text, r"^(#EXTINF:\S*)", 1), F.lit(" "), shown, F.regexp_extract(text, r"^#EXTINF:\S*(.*)$", 1)))


def render(entries: DataFrame) -> DataFrame:
    """playlist, line_no, text: the line of each entry, which ``parse`` reads back."""
    quoted = lambda c: F.coalesce(F.replace(c, F.lit('"'), F.lit("&quot;")), F.lit(""))
    return entries.select("playlist", "line_no", F.concat(
        F.lit('#EXTINF:-1 tvg-id="'), quoted("tvg_id"), F.lit('" tvg-name="'), quoted("tvg_name"), F.lit('" group-title="'), quoted("group_title"), F.lit('",'), F.coalesce("display_name", F.lit(""))).alias("text"))
