"""Entries of playlists to identifiers of a guide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names

NO_GUIDE = r"(?i)\b(?:XXX|ADULT|TEST(?:E)?|SEM GUIA)\b"


def unique_index(guide: DataFrame, key: Column, label: str) -> DataFrame:
    """key -> id where one id alone has the key; guide: id, name."""
    g = guide.select("id", key.alias(label)).filter(F.col(label) != "").distinct()
    return g.groupBy(label).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).select(label, F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias(f"{label}_id"), F.col("n").alias(f"{label}_n"))


def rekeyed(entries: DataFrame, guide: DataFrame) -> DataFrame:
    """entry_id, new_id, reason: the id that a name key alone names, else a word set, else the old id if the guide has it."""
    g = guide.filter("id IS NOT NULL AND name IS NOT NULL")
    by_key = unique_index(g, names.name_key(F.col("name")), "nk")
    by_words = unique_index(g, names.token_set(names.name_key(F.col("name"))), "ws")
    known = g.select(F.col("id").alias("tvg_id")).distinct().withColumn("known", F.lit(True))
    name = F.coalesce(F.nullif(F.trim("tvg_name"), F.lit("")), F.col("display_name"))
    e = entries.withColumn("nk", names.name_key(name)).withColumn("ws", names.token_set(names.name_key(name)))
    j = e.join(by_key, "nk", "left").join(by_words, "ws", "left").join(known, "tvg_id", "left")
    new = F.coalesce("nk_id", F.when(F.col("nk_n").isNull(), F.col("ws_id")), F.when(F.col("known"), F.col("tvg_id")), F.lit(""))
    reason = (
        F.when(F.col("nk_id").isNotNull(), "name").when(F.col("nk_n").isNull() & F.col("ws_id").isNotNull(), "words").when(F.col("known"), "kept")
        .when((F.col("nk_n") > 1) | (F.col("ws_n") > 1), "ambiguous").otherwise("none")
    )
    return j.select("entry_id", new.alias("new_id"), reason.alias("reason"))


def resolved(entries: DataFrame, guide: DataFrame, poisoned: DataFrame) -> DataFrame:
    """entry_id, tvg_id, reason: nothing for adult, test and foreign names; else what the plain key names, else the name
    key, else the old identifier unless it is unsafe, poisoned or of another number or region."""
    g = guide.filter("id IS NOT NULL AND name IS NOT NULL")
    first = lambda key, label: g.select(key.alias(label), "id").filter(F.col(label) != "").groupBy(label).agg(F.min("id").alias(f"{label}_id"))
    n = F.col("display_name")
    e = entries.withColumn("pk", names.plain_key(names.strip_quality(n))).withColumn("nk", names.name_key(n)).withColumn("ik", names.id_key(F.coalesce("tvg_id", F.lit(""))))
    j = e.join(first(names.plain_key(F.col("name")), "pk"), "pk", "left").join(first(names.name_key(F.col("name")), "nk"), "nk", "left").join(
        poisoned.select(F.col("id").alias("ik")).distinct().withColumn("bad", F.lit(True)), "ik", "left")
    fits = lambda i: i.isNotNull() & names.is_safe_id(i) & ~names.number_conflict(n, i)
    none = n.isNull() | n.rlike(NO_GUIDE) | (names.country(n) != "")
    out = (
        F.when(none, F.struct(F.lit("").alias("tvg_id"), F.lit("no_guide").alias("reason")))
        .when(fits(F.col("pk_id")), F.struct(F.col("pk_id").alias("tvg_id"), F.lit("plain").alias("reason")))
        .when(fits(F.col("nk_id")), F.struct(F.col("nk_id").alias("tvg_id"), F.lit("key").alias("reason")))
        .when((F.col("ik") != "") & F.col("bad").isNull() & fits(F.col("tvg_id")), F.struct(F.col("tvg_id").alias("tvg_id"), F.lit("original").alias("reason")))
        .otherwise(F.struct(F.lit("").alias("tvg_id"), F.lit("unresolved").alias("reason")))
    )
    return j.select("entry_id", out.alias("o")).select("entry_id", "o.*")


def id_map(rekeys: DataFrame, entries: DataFrame) -> DataFrame:
    """display_name, tvg_id of names that are always given the same identifier."""
    j = entries.select("entry_id", "display_name").join(rekeys.filter("new_id != ''"), "entry_id")
    return j.groupBy("display_name").agg(F.min("new_id").alias("tvg_id"), F.max("new_id").alias("o")).filter("tvg_id = o").drop("o")
