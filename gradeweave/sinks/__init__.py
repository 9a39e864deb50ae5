"""Schedules, playlists, catalogs and reports to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def xmltv_lines(channels: DataFrame, programmes: DataFrame) -> DataFrame:
    """part, k1, k2, line: the lines of one XMLTV document in order of (part, k1, k2): channels first, then programmes.

    channels: channel_id, display_names; programmes: channel_id, start, stop, title, description, categories and, where
    there are such columns, sub_title, date, icon, season, episode and rating_badge. Values that are NULL or '' write nothing.
    """
    spark = channels.sparkSession
    none = F.lit(0).cast("bigint")
    ends = spark.createDataFrame([(0, '<?xml version="1.0" encoding="UTF-8"?>\n<tv>'), (3, "</tv>")], "part int, line string").select("part", F.lit("").alias("k1"), none.alias("k2"), "line")
    names = F.array_join(F.transform(F.array_distinct(F.concat(F.array("channel_id"), "display_names")), lambda n: F.concat(F.lit("<display-name>"), escaped(n), F.lit("</display-name>"))), "")
    c = channels.select(F.lit(1).alias("part"), F.col("channel_id").alias("k1"), none.alias("k2"), F.concat(F.lit('<channel id="'), escaped(F.col("channel_id")), F.lit('">'), names, F.lit("</channel>")).alias("line"))
    tag = lambda t, v: F.coalesce(F.concat(F.lit(f"<{t}>"), escaped(F.nullif(v, F.lit(""))), F.lit(f"</{t}>")), F.lit(""))
    cats = F.array_join(F.transform(F.coalesce("categories", F.array().cast("array<string>")), lambda x: F.concat(F.lit("<category>"), escaped(x), F.lit("</category>"))), "")
    has = lambda c, kind="string": F.col(c) if c in programmes.columns else F.lit(None).cast(kind)
    some = lambda *parts: F.coalesce(F.concat(*parts), F.lit(""))
    icon = some(F.lit('<icon src="'), escaped(F.nullif(has("icon"), F.lit(""))), F.lit('"/>'))
    # counted from zero, as the notation wants it; an episode alone has no season before the point
    season, episode = has("season", "int"), has("episode", "int")
    numbers = some(F.lit('<episode-num system="xmltv_ns">'), F.coalesce((season - 1).cast("string"), F.lit("")), F.lit("."), (episode - 1).cast("string"), F.lit(".</episode-num>"))
    rating = some(F.lit("<rating><value>"), escaped(F.nullif(has("rating_badge"), F.lit(""))), F.lit("</value></rating>"))
    p = programmes.select(F.lit(2).alias("part"), F.col("channel_id").alias("k1"), F.unix_seconds("start").alias("k2"), F.concat(
        F.lit('<programme start="'), clock.format_compact(F.col("start")), F.lit('" stop="'), clock.format_compact(F.col("stop")), F.lit('" channel="'), escaped(F.col("channel_id")), F.lit('">'),
        tag("title", F.col("title")), tag("sub-title", has("sub_title")), tag("desc", F.col("description")), tag("date", has("date")), cats, icon, numbers, rating, F.lit("</programme>")).alias("line"))
    return ends.unionByName(c).unionByName(p)


def write_xmltv(channels: DataFrame, programmes: DataFrame, path: str, files: int | None = None) -> None:
    """Gzipped text files that make up the document in the order of their names; the same rows give the same bytes.

    Rows are range-partitioned, so no task holds the whole document.
    """
    lines = xmltv_lines(channels, programmes)
    ordered = lines.repartitionByRange(files, "part", "k1", "k2") if files else lines.repartitionByRange("part", "k1", "k2")
    ordered.sortWithinPartitions("part", "k1", "k2", "line").select(F.col("line").alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_playlist(lines: DataFrame, path: str) -> None:
    """Lines (playlist, line_no, text) as text files, one folder per playlist, in order."""
    lines.repartition("playlist").sortWithinPartitions("playlist", "line_no").select("playlist", F.col("text").alias("value")).write.mode("overwrite").partitionBy("playlist").text(path)


def write_id_map(mapping: DataFrame, path: str) -> None:
    """name;id lines."""
    mapping.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def markdown(rows: DataFrame, title: str, most: int = 40) -> str:
    """A table of at most ``most`` rows in the order given: a report, not the data."""
    got = rows.limit(most).collect()
    head = "| " + " | ".join(rows.columns) + " |\n|" + "---|" * len(rows.columns)
    return f"## {title}\n\n{head}\n" + "\n".join("| " + " | ".join(str(v) for v in r) + " |" for r in got) + "\n"
