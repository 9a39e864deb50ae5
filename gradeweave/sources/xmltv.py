"""XMLTV files to channels and programmes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock, titles

_TEXT = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_lang", T.StringType())])
_ICON = T.StructType([T.StructField("_src", T.StringType())])
CHANNEL = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("display-name", T.ArrayType(_TEXT)), T.StructField("icon", T.ArrayType(_ICON)),
])
PROGRAMME = T.StructType([
    T.StructField("_start", T.StringType()), T.StructField("_stop", T.StringType()), T.StructField("_channel", T.StringType()),
    T.StructField("title", T.ArrayType(_TEXT)), T.StructField("sub-title", T.ArrayType(_TEXT)), T.StructField("desc", T.ArrayType(_TEXT)),
    T.StructField("date", T.StringType()), T.StructField("category", T.ArrayType(_TEXT)), T.StructField("icon", T.ArrayType(_ICON)),
    T.StructField("episode-num", T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_system", T.StringType())]))),
    T.StructField("rating", T.ArrayType(T.StructType([T.StructField("_system", T.StringType()), T.StructField("value", T.StringType())]))),
])
#: Domains of identifiers whose channels are another country's.
FOREIGN_DOMAINS = ("us", "uk", "pt", "ar", "mx", "cl", "co", "pe", "ca")


def _read(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("mode", "PERMISSIVE").schema(schema).load(path)


def channels(spark: SparkSession, path: str, source: str, domestic: bool = True) -> DataFrame:
    """source, channel_id, display_names, icon; gzip is told by the file's ending, see ``sniffed`` for others."""
    c = _read(spark, path, "channel", CHANNEL).filter("_id IS NOT NULL")
    if domestic:
        c = c.filter(~F.lower("_id").rlike(rf"\.(?:{'|'.join(FOREIGN_DOMAINS)})$"))
    return c.select(F.lit(source).alias("source"), F.col("_id").alias("channel_id"), _texts(F.col("display-name")).alias("display_names"), F.get(F.col("icon"), F.lit(0))["_src"].alias("icon"))


def programmes(spark: SparkSession, path: str, source: str, default_offset: str = "+0000") -> DataFrame:
    return model(_read(spark, path, "programme", PROGRAMME), source, default_offset)


def sniffed(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """One text per element of the tag from files that may be gzipped whatever they are called."""

    def parts(batches):
        import gzip
        import re

        import pandas as pd

        for b in batches:
            out = []
            for data in b["content"]:
                text = (gzip.decompress(data) if bytes(data[:2]) == b"\x1f\x8b" else bytes(data)).decode("utf-8", "replace")
                out += re.findall(rf"<{tag}\b.*?</{tag}>", text, re.S)
            yield pd.DataFrame({"xml": out})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parts, "xml string")


def from_text(xml: DataFrame, source: str, default_offset: str = "+0000", column: str = "xml") -> DataFrame:
    """Programmes from one element's text per row."""
    parsed = xml.select(F.from_xml(F.col(column), PROGRAMME).alias("p")).select("p.*")
    return model(parsed, source, default_offset)


def _texts(c: Column) -> Column:
    """Values of an element that may repeat, without blank ones."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast(T.ArrayType(_TEXT))), lambda t: F.trim(t["_VALUE"])), lambda t: t.isNotNull() & (t != ""))


def model(raw: DataFrame, source: str, default_offset: str = "+0000") -> DataFrame:
    """source, channel_id, start, stop, title, norm_title, meta: first title, subtitle and icon, longest description, all
    categories, last rating that means one, season and episode by element, else by text, none for films and sport."""
    texts = lambda c: _texts(F.col(f"`{c}`"))
    first = lambda c: F.get(texts(c), F.lit(0))
    longest = F.reduce(texts("desc"), F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    badges = F.filter(F.transform(F.coalesce("rating", F.array().cast(PROGRAMME["rating"].dataType)), lambda r: titles.rating(r["value"])), lambda r: r != "")
    numbers = F.coalesce(F.col("`episode-num`"), F.array().cast(PROGRAMME["episode-num"].dataType))
    coded = F.get(F.filter(F.transform(numbers, lambda n: F.when(F.lower(F.coalesce(n["_system"], F.lit(""))) == "xmltv_ns", titles.xmltv_ns(n["_VALUE"])).otherwise(
        F.when(titles.season_episode(n["_VALUE"])["season"].isNotNull(), titles.season_episode(n["_VALUE"])))), lambda x: x.isNotNull()), F.lit(0))
    r = raw.select(
        F.lit(source).alias("source"), F.col("_channel").alias("channel_id"), clock.parse_compact(F.col("_start"), default_offset).alias("start"), clock.parse_compact(F.col("_stop"), default_offset).alias("stop"),
        titles.clean(first("title")).alias("t"), first("sub-title").alias("sub"), longest.alias("desc"), F.substring("date", 1, 4).alias("date"), F.array_distinct(texts("category")).alias("categories"),
        F.element_at(F.when(F.size(badges) > 0, badges), -1).alias("badge"), F.get(F.col("icon"), F.lit(0))["_src"].alias("icon"), coded.alias("coded"))
    found = F.coalesce("coded", titles.season_episode(F.concat_ws(" | ", "t", "sub", "desc")))
    minutes = (F.unix_seconds("stop") - F.unix_seconds("start")) / 60
    series = ~F.coalesce(titles.movie_or_sport(F.col("categories"), F.col("desc"), minutes), F.lit(False))
    return r.filter("start IS NOT NULL AND channel_id IS NOT NULL").select(
        "source", "channel_id", "start", "stop", titles.strip_season_episode(F.col("t")).alias("title"), titles.normalise(F.col("t")).alias("norm_title"),
        F.struct(
            titles.strip_season_episode(F.col("t")).alias("title"), titles.strip_season_episode(F.col("sub")).alias("sub_title"), titles.strip_season_episode(F.col("desc")).alias("desc"),
            F.when(series, found["season"]).alias("season"), F.when(series, found["episode"]).alias("episode"), "categories", "date", F.col("badge").alias("rating_badge"), "icon").alias("meta"))


def read_all(spark: SparkSession, specs: list[tuple[str, str, str]]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Programmes of all sources (key, path, default offset) that can be read, and (key, message) of those that cannot.

    Fails only if none can be read.
    """
    from pyspark.errors import PySparkException

    good, bad = [], []
    for key, path, offset in specs:
        try:
            good.append(programmes(spark, path, key, offset))
        except PySparkException as problem:
            bad.append((key, str(problem).splitlines()[0]))
    if not good:
        raise RuntimeError(f"no source can be read: {bad}")
    out = good[0]
    for g in good[1:]:
        out = out.unionByName(g, allowMissingColumns=True)
    return out, bad
