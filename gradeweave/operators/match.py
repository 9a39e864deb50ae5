"""Channels of feeds to entries of a dictionary: by identifier, by exact name in tiers, by similarity; overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, similarity
from ..runtime import materialise, small

FUZZY_THRESHOLD, FUZZY_MARGIN, FUZZY_BOUND, FUZZY_LENGTH = 0.82, 0.03, 0.79, 4
#: Rules of expansion are tried one by one on every name, without a join.
MAX_RULES = 1_000
#: Words at a name's end that a wider tier drops, next to federal units.
LOCAL_WORDS = ("CAPITAL", "INTERIOR", "LOCAL")


def tiers(dictionary: DataFrame, expansions: DataFrame | None = None) -> DataFrame:
    """key, tier, pos, alias, number text: 1 the entry's own names, 2 without state or place words, 3 what ``expansions``
    (trigger pattern, alias) adds for names that match the trigger. The first place of an alias counts."""
    own = dictionary.select("key", "name", F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("pos", "alias"))
    one = own.select("key", "name", F.lit(1).alias("tier"), "pos", "alias")
    words = "|".join((*names.UFS, *LOCAL_WORDS))
    two = one.select("key", "name", F.lit(2).alias("tier"), "pos", F.trim(F.regexp_replace("alias", rf"(?i)[\s/(-]+(?:{words})\)?\s*$", "")).alias("alias"))
    every = one.unionByName(two)
    if expansions is not None:
        rules = expansions.select("trigger", "alias").limit(MAX_RULES + 1).collect()
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} expansions")
        added = F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(F.upper("name").rlike(r.trigger), F.lit(r.alias)) for r in rules)))
        three = dictionary.select("key", "name", F.lit(3).alias("tier"), F.lit(0).alias("pos"), F.explode(added).alias("alias"))
        every = every.unionByName(three)
    e = every.withColumn("norm", names.norm_name(F.col("alias"))).filter("norm != ''")
    return e.groupBy("key", "name", "norm").agg(F.min(F.struct("tier", "pos", "alias")).alias("f")).select("key", "name", "norm", "f.*")


def channel_names(channels: DataFrame) -> DataFrame:
    """source, channel_id, name, norm of every declared name, each once."""
    return channels.select("source", "channel_id", F.explode("display_names").alias("name")).filter("source IS NOT NULL AND channel_id IS NOT NULL").withColumn("norm", names.norm_name(F.col("name"))).filter("norm != ''").distinct()


def by_name(aliases: DataFrame, channels: DataFrame) -> DataFrame:
    n = channel_names(channels)
    j = aliases.join(n.withColumnRenamed("name", "channel_name"), "norm").filter(~names.number_conflict(F.col("name"), F.col("channel_name")) & ~names.region_conflict(F.col("name"), F.col("channel_name")))
    return j.select("key", "source", "channel_id", "tier", F.lit("exact").alias("method"), F.lit(1).alias("method_rank"), "pos", F.lit(1.0).alias("match_score"))


def by_id(dictionary: DataFrame, channels: DataFrame) -> DataFrame:
    ids = dictionary.select("key", "name", F.posexplode("tvg_ids").alias("pos", "i")).withColumn("id", names.source_id(F.col("i"))).filter("id != ''")
    c = channels.filter("source IS NOT NULL AND channel_id IS NOT NULL").select("source", "channel_id", names.source_id(F.col("channel_id")).alias("id")).distinct()
    return ids.join(c, "id").select("key", "source", "channel_id", F.lit(1).alias("tier"), F.lit("id").alias("method"), F.lit(0).alias("method_rank"), "pos", F.lit(0.98).alias("match_score"))


def tiered(candidates: DataFrame, row_counts: DataFrame) -> DataFrame:
    """One match per entry and source: identifiers before names, tiers in order, alias order, then most rows.

    An entry stops at the first tier by which it has a match of 0.90, or two matches with rows; channels without rows
    count only where no channel of the same source has any.
    """
    c = candidates.join(row_counts, ["source", "channel_id"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    order = F.struct(F.when(F.col("n_rows") > 0, 0).otherwise(1), "tier", "method_rank", "pos", -F.col("n_rows"), "channel_id")
    best = c.groupBy("key", "source").agg(F.min_by(F.struct("channel_id", "tier", "method", "match_score", "n_rows"), order).alias("m")).select("key", "source", "m.*")
    by_tier = best.groupBy("key", "tier").agg(F.max(F.when((F.col("match_score") >= 0.90) & (F.col("n_rows") > 0), 1).otherwise(0)).alias("strong"), F.count_if(F.col("n_rows") > 0).alias("with_rows"))
    run = Window.partitionBy("key").orderBy("tier")  # at most three rows per entry
    stop = by_tier.withColumn("strong", F.max("strong").over(run)).withColumn("with_rows", F.sum("with_rows").over(run)).filter("strong = 1 OR with_rows >= 2").groupBy("key").agg(F.min("tier").alias("stop"))
    return best.join(stop, "key", "left").filter(F.col("stop").isNull() | (F.col("tier") <= F.col("stop"))).drop("stop")


def near_texts(aliases: DataFrame, channels: DataFrame) -> DataFrame:
    """a, b: different pairs of an alias and a channel's name of equal digits whose ratio may reach the bound.

    Equal texts are compared once, whoever has them. The join is on digits and length: each alias is spread over the
    lengths that the bound allows; the letters both have bound the ratio before it is computed.
    """
    a = aliases.select(F.col("norm").alias("a")).filter(F.length("a") >= FUZZY_LENGTH).distinct().withColumn("digits", names.digits(F.col("a"))).withColumn("mask_a", similarity.letters_mask(F.col("a")))
    low, high = FUZZY_BOUND / (2 - FUZZY_BOUND), (2 - FUZZY_BOUND) / FUZZY_BOUND
    a = a.withColumn("n", F.explode(F.sequence(F.ceil(F.length("a") * low).cast("int"), F.floor(F.length("a") * high).cast("int"))))
    b = channels.select(F.col("norm").alias("b")).distinct().withColumn("digits", names.digits(F.col("b"))).withColumn("n", F.length("b")).withColumn("mask_b", similarity.letters_mask(F.col("b")))
    near = similarity.mask_bound(F.length("a"), F.length("b"), F.col("mask_a"), F.col("mask_b")) >= FUZZY_BOUND  # cheap, so it comes first
    return a.join(b, ["digits", "n"]).filter(near & (similarity.length_bound(F.col("a"), F.col("b")) >= FUZZY_BOUND) & (similarity.letter_bound(F.col("a"), F.col("b")) >= FUZZY_BOUND)).select("a", "b")


def _sides(aliases: DataFrame, channels: DataFrame) -> tuple[DataFrame, DataFrame]:
    return aliases.select("key", F.col("norm").alias("a")).distinct(), channels.select("source", "channel_id", F.col("norm").alias("b")).distinct()


def fuzzy_pairs(aliases: DataFrame, channels: DataFrame) -> DataFrame:
    """key, source, channel_id, a, b of every pair of an entry's alias and a channel's name in ``near_texts``."""
    named = channel_names(channels)
    a, b = _sides(aliases, named)
    return a.join(near_texts(aliases, named), "a").join(b, "b")


def fuzzy(aliases: DataFrame, channels: DataFrame, **rules) -> DataFrame:
    """key, source, channel_id, match_score of the most similar channel where it leads the next one of the source.

    Foreign names match none but foreign ones, and ``veto`` (its parameters are ``rules``) leaves pairs out before their
    ratio is computed.
    """
    own = aliases.filter(names.country(F.col("name")) == "")
    named = channel_names(channels).filter(names.country(F.col("name")) == "")
    pairs = materialise(near_texts(own, named))  # apart from the veto, which would have the bounds computed for every pair
    scored = materialise(pairs.filter(~veto(F.col("a"), F.col("b"), **rules)).withColumn("r", similarity.ratio(F.col("a"), F.col("b"))).filter(F.col("r") >= FUZZY_BOUND))
    a, b = _sides(own, named)
    per = a.join(scored, "a").join(b, "b").groupBy("key", "source", "channel_id").agg(F.max("r").alias("r"))
    # the two best by partial results: a source may declare any number of channels
    best = per.groupBy("key", "source").agg(F.max(F.struct("r", "channel_id")).alias("b"))
    rest = per.join(best, ["key", "source"]).filter(F.col("channel_id") != F.col("b.channel_id")).groupBy("key", "source").agg(F.max("r").alias("next"))
    return best.join(rest, ["key", "source"], "left").filter((F.col("b.r") >= FUZZY_THRESHOLD) & (F.col("b.r") - F.coalesce("next", F.lit(0.0)) >= FUZZY_MARGIN)).select(
        "key", "source", F.col("b.channel_id").alias("channel_id"), F.round("b.r", 6).alias("match_score"))


def overridden(matches: DataFrame, overrides: DataFrame) -> DataFrame:
    """Matches with those of an override's source replaced by it; overridden matches are selected."""
    o = overrides.select("key", "source", F.col("channel_id").alias("forced"))
    kept = matches.join(small(o.select("key", "source")), ["key", "source"], "left_anti").withColumn("selected", F.lit(False))
    forced = o.select("key", "source", F.col("forced").alias("channel_id"), F.lit(1).alias("tier"), F.lit("override").alias("method"), F.lit(1.0).alias("match_score"), F.lit(0).cast("bigint").alias("n_rows"), F.lit(True).alias("selected"))
    return kept.unionByName(forced)


def valid_id(name: Column, tvg_id: Column, least: float = 0.65) -> Column:
    """Whether an identifier may belong to a name: same country, state and digits, one within the other or similar."""
    key, n = names.id_key(tvg_id), F.lower(names.norm_name(name))
    same = F.contains(n, key) | F.contains(key, n) | (similarity.ratio(key, n) >= least)
    foreign = (names.country(name) != "") & F.lower(tvg_id).endswith(".br")
    return (key != "") & (n != "") & ~foreign & ~names.region_conflict(name, tvg_id) & (names.digits(key) == names.digits(n)) & same


def network_conflict(entry: Column, label: Column, networks: tuple[str, ...]) -> Column:
    """Whether two names hold words of different networks."""
    held = lambda c: F.array_intersect(F.split(names.name_key(c), " "), F.array(*(F.lit(n) for n in networks)))
    return (F.size(held(entry)) > 0) & (F.size(held(label)) > 0) & ~F.arrays_overlap(held(entry), held(label))


def tail_donors(matches: DataFrame, coverage: DataFrame, now: int, hours: int = 72, more: int = 6) -> DataFrame:
    """Matches of deeper tiers whose rows end over ``more`` hours after the entry's selected ones, where those end before
    the horizon. coverage: source, channel_id, last (epoch seconds)."""
    m = matches.join(coverage, ["source", "channel_id"])
    top = m.withColumn("t", F.min("tier").over(Window.partitionBy("key")))  # as many rows as there are sources
    end = top.filter("tier = t").groupBy("key").agg(F.max("last").alias("end")).filter(F.col("end") < now + hours * 3600)
    return top.filter("tier > t").join(end, "key").filter(F.col("last") > F.col("end") + more * 3600).select("key", "source", "channel_id", "tier", "last")


#: Words that must stand in both names or in neither. A parameter of ``veto``.
TELLING_WORDS = ("NEWS", "NOTICIAS", "KIDS", "INFANTIL", "SPORTS", "ESPORTES", "MUSIC", "MUSICA", "FILMES", "MOVIES", "PLUS", "2", "3")
#: Pairs of words of which one within the other is no sign of sameness.
NESTED_WORDS = (("BRASILIA", "BRASIL"),)


def _behind(c: Column, network: str) -> Column:
    """What follows a network's name at the start of a normalised name, '-' if it does not start so."""
    return F.when(c.rlike(f"^(?:TV|REDE)?{network}"), F.regexp_replace(c, f"^(?:TV|REDE)?{network}(?:TV)?", "")).otherwise("-")


def veto(a: Column, b: Column, words: tuple[str, ...] = TELLING_WORDS, networks: tuple[str, ...] = (), brands: tuple[str, ...] = ()) -> Column:
    """Whether two different normalised names must not be matched by similarity.

    A telling word in one only; names that only differ by NESTED_WORDS; different networks; the same network with other
    states, or a state against none, or places that neither begin alike nor hold each other; a local brand in b that a
    does not have, not even cut off; and, where no network tells, names that begin apart and are less similar than 0.8.
    """
    apart = lambda x, y: (F.substring(x, 1, 4) != F.substring(y, 1, 4)) & (similarity.letter_bound(x, y) < 0.8)
    is_uf = lambda x: x.isin(*names.UFS)
    out = F.lit(False)
    for w in words:
        out = out | (F.contains(a, F.lit(w)) != F.contains(b, F.lit(w)))
    for long, short in NESTED_WORDS:
        out = out | (F.replace(a, F.lit(long), F.lit(short)) == F.replace(b, F.lit(long), F.lit(short)))
    for w in brands:
        out = out | (b.startswith(w) & ~a.startswith(w) & ~a.startswith(w[:2]))
    none = F.lit(True)
    for i, n in enumerate(networks):
        x, y = _behind(a, n), _behind(b, n)
        both = (x != "-") & (y != "-")
        other = F.lit(False)
        for m in networks[:i] + networks[i + 1:]:
            other = other | ((x != "-") & (_behind(b, m) != "-"))
        places = (x != "") & (y != "") & ~F.contains(x, y) & ~F.contains(y, x) & apart(x, y)
        out = out | other | (both & ((is_uf(x) & (y == "")) | (is_uf(y) & (x == "")) | (is_uf(x) & is_uf(y) & (x != y)) | places))
        none = none & ~both
    return (a != b) & (out | (none & apart(a, b)))
