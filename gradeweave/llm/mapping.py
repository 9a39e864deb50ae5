"""Freely typed channel names to the entries of a dictionary (problem 6).

Equal names are judged once. Names and the dictionary's names and aliases are parsed into brand, genre and number or
network and town; the letters of brand, network and town go into an inverted index of 3-grams with tf-idf weights.
A join on the grams gives every candidate that shares one, its cosine is weighted with agreement of genre and number,
and the best entry counts if it passes the threshold and leads the next entry by the margin. An exact check follows:
genre and number must be the same (a number in brackets may also count streams of a channel without number), and brand, network and town may differ by single slips of the pen only.

Defined results: NULL and empty names, films, episodes and foreign channels have no entry; names of equal score for two
entries have none either (reported as 'ambiguous'); repeated entries are each mapped; extra columns are not read; an
empty dictionary maps nothing. Names of any length are parsed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import join_groups, materialise, small
from .channels import Parser, near
from .linkage import dictionary_rows

THRESHOLD = 0.42
MARGIN = 0.03
#: Parts of the squared length of a full vector.
CORE, GENRE, NUMBER = 0.7, 0.2, 0.1
PART_COLUMNS = "form string, core string, genre string, number string, network string, bracketed boolean"


def _parser(dictionary: DataFrame) -> Parser:
    rows = dictionary_rows(dictionary, ["name", "aliases"])
    return Parser((r.name for r in rows), (r.aliases for r in rows))


def _parsed(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """name, form, core, genre, number, network, usable of each row's name."""
    parser = df.sparkSession.sparkContext.broadcast(_parser(dictionary))
    others = [c for c in df.columns if c != "name"]

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = [parser.value.parse(n) for n in p["name"]]
            q = p[["name", *others]].copy()
            q["form"] = [f"{x.core}|{x.genre}|{x.number}" for x in got]
            for c in ("core", "genre", "number", "network", "bracketed"):
                q[c] = [getattr(x, c) for x in got]
            q["usable"] = [bool(x.core) and not x.foreign and not x.vod for x in got]
            yield q

    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in ("name", *others)]) + ", " + PART_COLUMNS + ", usable boolean"
    return df.mapInPandas(parse, schema)


def _grams(df: DataFrame, key: str) -> DataFrame:
    """key, gram, n of the words of the core, each between blanks; word order does not count."""
    words = F.filter(F.split("core", " "), lambda w: w != "")
    of_word = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.substring(F.concat(F.lit(" "), w, F.lit(" ")), i, F.lit(3)))
    return df.select(key, F.explode(F.flatten(F.transform(words, of_word))).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("n"))


def _weighted(grams: DataFrame, idf: DataFrame, rare: float, key: str) -> DataFrame:
    """key, gram, w: tf-idf scaled to length 1; grams that no entry has count as the rarest."""
    w = grams.join(idf, "gram", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(rare)))
    return w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))).select(key, "gram", "w")


def forms(dictionary: DataFrame) -> DataFrame:
    """entry, form and parts of every name and alias."""
    names = dictionary.filter("key IS NOT NULL").select(
        F.col("key").alias("entry"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    return _parsed(names.filter("name IS NOT NULL"), dictionary).filter("core != ''").drop("usable", "bracketed", "name").distinct()


def _same_brand(a: str, b: str, network: str) -> bool:
    if network:
        a, b = (" ".join(w for w in x.split() if w not in network.split()) for x in (a, b))
    return near(a, b, 1 if len(b) < 9 else 2) or (5 <= len(a) <= 7 and b.startswith(a))


def _same_brands(a: pd.Series, b: pd.Series, network: pd.Series) -> pd.Series:
    return pd.Series([_same_brand(x, y, n or "") if x is not None and y is not None else None for x, y, n in zip(a, b, network)], dtype="object")


def map_names(names: DataFrame, dictionary: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """name, entry, score, status ('mapped', 'ambiguous', 'different', 'unknown', 'not a channel') of each name of a column ``name``."""
    spark = names.sparkSession
    parsed = materialise(_parsed(names.select("name"), dictionary))
    entries = materialise(forms(dictionary))
    n_forms = max(entries.select("form").distinct().count(), 1)
    rare = float(spark.range(1).select(F.log(F.lit(1.0 + n_forms))).first()[0])
    by_form = entries.select("form", "core").distinct()
    grams = _grams(by_form, "form")
    idf = small(grams.groupBy("gram").agg(F.log(1 + n_forms / F.count("*")).alias("idf")))
    index = _weighted(grams, idf, rare, "form").withColumnRenamed("form", "entry_form").withColumnRenamed("w", "we")
    wanted = parsed.filter("usable").select("form", "core").distinct()
    hits = _weighted(_grams(wanted, "form"), idf, rare, "form").join(small(index), "gram").groupBy("form", "entry_form").agg(F.sum(F.col("w") * F.col("we")).alias("cosine"))
    mine = parsed.filter("usable").groupBy("form", "core", "genre", "number").agg(F.max("bracketed").alias("bracketed"))
    theirs = small(entries.select(F.col("form").alias("entry_form"), "entry", F.col("core").alias("e_core"), F.col("genre").alias("e_genre"), F.col("number").alias("e_number"), F.col("network").alias("e_network")))
    part = lambda a, b, w: F.when((F.col(a) == F.col(b)) & (F.col(a) != ""), F.lit(w)).otherwise(F.lit(0.0))
    size = lambda g, n: F.lit(CORE) + F.when(F.col(g) != "", GENRE).otherwise(0.0) + F.when(F.col(n) != "", NUMBER).otherwise(0.0)
    scored = (
        hits.join(mine, "form").join(theirs, "entry_form")
        .withColumn("score", (F.col("cosine") * CORE + part("genre", "e_genre", GENRE) + part("number", "e_number", NUMBER)) / F.sqrt(size("genre", "number") * size("e_genre", "e_number")))
        .groupBy("form", "core", "genre", "number", "bracketed", "entry").agg(F.max(F.struct("score", "e_core", "e_genre", "e_number", "e_network")).alias("s"))
        .select("form", "core", "genre", "number", "bracketed", "entry", "s.*")
    )
    order = Window.partitionBy("form").orderBy(F.desc("score"), "entry")
    top = scored.withColumn("rank", F.row_number().over(order)).filter("rank <= 2")
    best = top.groupBy("form", "core", "genre", "number", "bracketed").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("entry", "score", "e_core", "e_genre", "e_number", "e_network"))).alias("b"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("next"))
    judged = best.select(
        "form", F.col("b.entry").alias("entry"), F.col("b.score").alias("score"),
        F.when(F.col("b.score") < threshold, "unknown")
        .when(F.col("b.score") - F.coalesce("next", F.lit(0.0)) < margin, "ambiguous")
        .when((F.col("b.e_genre") != F.col("genre")) | ((F.col("b.e_number") != F.col("number")) & ~(F.col("bracketed") & (F.col("b.e_number") == ""))), "different")
        .when(~F.pandas_udf(_same_brands, "boolean")("core", "b.e_core", "b.e_network"), "different").otherwise("mapped").alias("status"))
    return parsed.join(judged, "form", "left").select(
        "name", F.when(F.col("usable") & (F.col("status") == "mapped"), F.col("entry")).alias("entry"), F.col("entry").alias("nearest"), F.round("score", 4).alias("score"),
        F.when(~F.col("usable"), "not a channel").otherwise(F.coalesce("status", F.lit("unknown"))).alias("status"))


def map_entries(entries: DataFrame, dictionary: DataFrame, entry_id: str = "entry_id", name: str = "display_name") -> DataFrame:
    """entry_id, dict_key of each entry whose name is mapped."""
    rows = entries.select(F.col(entry_id).alias("i"), F.col(name).alias("name")).filter("name IS NOT NULL")
    counted = materialise(rows.groupBy("name").agg(F.count("*").alias("n")))
    mapped = materialise(map_names(counted, dictionary).filter("entry IS NOT NULL").join(counted, "name").select("name", "entry", "n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return join_groups(rows, mapped, ["name"], "n", total).select(F.col("i").alias(entry_id), F.col("entry").alias("dict_key"))


def report(entries: DataFrame, dictionary: DataFrame, name: str = "display_name") -> DataFrame:
    """display_name, n_entries, status, nearest, score of each name without an entry."""
    counted = materialise(entries.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n_entries")))
    return map_names(counted, dictionary).filter("status != 'mapped'").join(counted, "name").select(F.col("name").alias(name), "n_entries", "status", "nearest", "score")
