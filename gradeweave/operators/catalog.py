"""Catalogs of channels from playlists and dictionaries: merging, votes, ambiguous and poisoned identifiers, name owners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names

#: How many values the compiled catalog keeps of each kind.
CAPS = {"aliases": 120, "tvg_ids": 40, "groups": 10}
MANUAL_VOTES = 10_000
SUFFIXES = ("FHD", "HD", "SD", "4K")


def _set(c: Column) -> Column:
    return F.array_sort(F.collect_set(F.when(F.coalesce(c, F.lit("")) != "", c)))


def merged(entries: DataFrame, name: str = "display_name") -> DataFrame:
    """One record per normalised name: first name, first group that isn't empty, sorted distinct names and identifiers."""
    e = entries.withColumn("key", names.norm_name(F.col(name))).filter("key != ''")
    order = F.struct("playlist", "line_no", "entry_id")
    return e.groupBy("key").agg(
        F.min_by(name, order).alias("name"), F.min_by("group_title", F.when(F.coalesce("group_title", F.lit("")) != "", order)).alias("group_title"),
        _set(F.col(name)).alias("aliases"), _set(F.col("tvg_id")).alias("tvg_ids"), F.count("*").alias("observations"),
        F.count_if(F.coalesce("tvg_id", F.lit("")) == "").alias("blank_ids"), F.count_distinct("playlist").alias("n_playlists"), F.min(order).alias("first"))


def name_votes(entries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """key, name, votes: how often each way to write a name was seen; the dictionary's way counts ``MANUAL_VOTES``."""
    seen = entries.select(names.norm_name(F.col("display_name")).alias("key"), names.strip_quality(F.col("display_name")).alias("name"), F.lit(1).alias("v"))
    manual = dictionary.select(names.norm_name(F.col("name")).alias("key"), F.col("name"), F.lit(MANUAL_VOTES).alias("v"))
    return seen.unionByName(manual).filter("key != '' AND name != ''").groupBy("key", "name").agg(F.sum("v").alias("votes"))


def top_names(entries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """key, name, votes, n_names: the name of most votes, of equal ones the smaller."""
    v = name_votes(entries, dictionary)
    return v.groupBy("key").agg(F.min_by(F.struct("name", "votes"), F.struct(-F.col("votes"), F.col("name"))).alias("b"), F.count("*").alias("n_names")).select("key", "b.*", "n_names")


def observations(entries: DataFrame) -> DataFrame:
    """key, tvg_id, seen of one batch of playlists."""
    return entries.select(names.norm_name(F.col("display_name")).alias("key"), F.coalesce("tvg_id", F.lit("")).alias("tvg_id")).filter("key != ''").groupBy("key", "tvg_id").agg(F.count("*").alias("seen"))


def upserted(store: DataFrame, batch: DataFrame, keys: Sequence[str] = ("key", "tvg_id"), counter: str = "seen") -> DataFrame:
    """Counters of the store and of a new batch added up; the next store."""
    return store.unionByName(batch).groupBy(*keys).agg(F.sum(counter).alias(counter))


def without_vod(store: DataFrame, unwanted: DataFrame) -> DataFrame:
    """Drops keys that turned out to be no live channels."""
    return store.join(unwanted.select("key").distinct(), "key", "left_anti")


def new_files(files: DataFrame, known: DataFrame, content: str = "content") -> DataFrame:
    """Files whose fingerprint is not known yet, one for equal files."""
    f = files.withColumn("fingerprint", F.sha2(F.col(content), 256))
    fresh = f.groupBy("fingerprint").agg(F.min("file").alias("file"), F.count("*").alias("n_copies"))
    return fresh.join(known.select("fingerprint").distinct(), "fingerprint", "left_anti")


def trusted_ids(seen: DataFrame) -> DataFrame:
    """tvg_id, owners, trusted: an identifier is trusted if one key owns it."""
    return seen.filter("tvg_id != ''").groupBy(names.id_key(F.col("tvg_id")).alias("id")).agg(
        F.count_distinct("key").alias("owners"), F.sum("seen").alias("seen")).withColumn("trusted", F.col("owners") == 1)


def poisoned_ids(pairs: DataFrame, tvg_id: str = "tvg_id", name: str = "display_name") -> DataFrame:
    """id, n_maximal of identifiers whose names make up two or more word sets none of which holds the other."""
    sets = pairs.select(names.id_key(F.col(tvg_id)).alias("id"), names.token_set(names.name_key(F.col(name))).alias("words")).filter("id != '' AND words != ''").distinct()
    sets = sets.withColumn("w", F.split("words", " ")).withColumn("n", F.size("w"))
    word = sets.select("id", F.col("words").alias("small"), "n", F.explode("w").alias("x"))
    other = sets.select("id", F.col("words").alias("big"), F.col("n").alias("m"), F.explode("w").alias("x"))
    inside = word.join(other, ["id", "x"]).filter("m > n").groupBy("id", "small", "big").agg(F.count("*").alias("hits"), F.max("n").alias("n")).filter("hits = n").select("id", F.col("small").alias("words")).distinct()
    return sets.join(inside, ["id", "words"], "left_anti").groupBy("id").agg(F.count("*").alias("n_maximal")).filter("n_maximal >= 2")


def alias_index(dictionary: DataFrame) -> DataFrame:
    """alias, key of every normalised name or alias that one entry alone has."""
    a = dictionary.select("key", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("a")).select("key", names.norm_name(F.col("a")).alias("alias")).filter("alias != ''")
    return a.groupBy("alias").agg(F.min("key").alias("key"), F.max("key").alias("other")).filter("key = other").drop("other")


def name_owners(named: DataFrame, cid: str = "id", name: str = "name") -> DataFrame:
    """name_key, owner, n_claims: of the channels that claim a name the one called so, else the one of fewest names, else the smaller id."""
    n = named.select(F.col(cid).alias("id"), names.name_key(F.col(name)).alias("name_key")).filter("name_key != ''").distinct()
    count = n.groupBy("id").agg(F.count("*").alias("n_keys"))
    ranked = n.join(count, "id").withColumn("exact", names.name_key(F.col("id")) == F.col("name_key"))
    order = F.when(F.col("exact"), F.struct(F.lit(0).alias("a"), F.lit(0).cast("bigint").alias("b"), F.col("id").alias("c"))).otherwise(F.struct(F.lit(1).alias("a"), F.col("n_keys").alias("b"), F.col("id").alias("c")))
    return ranked.groupBy("name_key").agg(F.min_by("id", order).alias("owner"), F.count("*").alias("n_claims"))


def clean_aliases(dictionary: DataFrame) -> DataFrame:
    """key, pos, alias: names, aliases and what quality marks make of them, 2 to 100 characters, the first of equal ones but for case."""
    base = F.array_distinct(F.filter(F.array("name", names.strip_quality(F.col("name"))), lambda x: x.isNotNull()))
    marks = F.array(F.lit(""), *(F.lit(" " + s) for s in SUFFIXES))
    varied = F.flatten(F.transform(base, lambda b: F.transform(marks, lambda m: F.concat(b, m))))
    every = F.concat(varied, F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("tvg_ids", F.array().cast("array<string>")))
    a = dictionary.select("key", F.posexplode(every).alias("pos", "alias")).filter(F.length("alias").between(2, 100))
    return a.groupBy("key", F.upper("alias").alias("u")).agg(F.min(F.struct("pos", "alias")).alias("f")).select("key", "f.pos", "f.alias")


def export_ids(dictionary: DataFrame) -> DataFrame:
    """key, export_id: the first safe identifier without a conflicting number, else the name made safe."""
    ok = lambda i: names.is_safe_id(i) & ~names.number_conflict(F.col("name"), i)
    first = F.get(F.filter(F.coalesce("tvg_ids", F.array().cast("array<string>")), ok), 0)
    return dictionary.select("key", F.coalesce(first, names.safe_id(names.strip_quality(F.col("name")))).alias("export_id"))


def exported_once(exports: DataFrame) -> DataFrame:
    """export_id, key, names: identifiers claimed twice stay with the first key; names of equal name keys are merged."""
    e = exports.withColumn("nk", names.name_key(F.col("name")))
    first = e.groupBy("export_id").agg(F.min(F.struct("key", "nk")).alias("f")).select("export_id", F.col("f.key").alias("owner"), F.col("f.nk").alias("owner_nk"))
    return e.join(first, "export_id").filter((F.col("key") == F.col("owner")) | (F.col("nk") == F.col("owner_nk"))).groupBy("export_id").agg(
        F.min("key").alias("key"), F.array_sort(F.collect_set("name")).alias("names"))


def learned_catalog(store: DataFrame, named: DataFrame) -> DataFrame:
    """The compiled catalog: key, name, up to CAPS identifiers by observations, whether each is trusted."""
    trust = trusted_ids(store).select("id", "trusted")
    ids = store.filter("tvg_id != ''").withColumn("id", names.id_key(F.col("tvg_id"))).join(trust, "id")
    w = Window.partitionBy("key").orderBy(F.desc("seen"), "tvg_id")
    best = ids.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= CAPS["tvg_ids"]).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("k", "tvg_id", "seen", "trusted"))).alias("ids"))
    seen = store.groupBy("key").agg(F.sum("seen").alias("observations"), F.sum(F.when(F.col("tvg_id") == "", F.col("seen")).otherwise(0)).alias("blank_ids"))
    return seen.join(named, "key", "left").join(best, "key", "left").select("key", "name", "observations", "blank_ids", "ids")


def stable_ids(named: DataFrame, key: str = "row", name: str = "name") -> DataFrame:
    """key, id: an identifier made of the normalised name; all but the first of equal ones get a hash of their own name."""
    n = named.select(F.col(key).alias("k"), F.col(name).alias("name"), names.automatic_id(F.col(name)).alias("id"))
    first = n.groupBy("id").agg(F.min(F.struct("k", "name")).alias("f")).select("id", F.col("f.name").alias("first_name"))
    return n.join(first, "id").select(F.col("k").alias(key), F.when(F.col("name") == F.col("first_name"), F.col("id")).otherwise(F.concat("id", F.lit("."), F.substring(F.sha1("name"), 1, 8))).alias("id"))
