"""The same channel in the feeds of several sources (problem 2).

A deterministic cascade of exact joins on ever weaker attributes; each pass takes only the records that none before it
resolved. A record's names, identifier, image and city give keys of brand, genre and number or of network and town:

1. confirmed: a key that a name and an identifier, image or city of the record agree on;
2. name, 3. code: the key of a name, or of another field that no name speaks against, shared by two sources;
4. slip: the key after one slip of the pen, joined through all variants with one character left out;
5. cut: the key of a shortened brand or town, joined through prefixes;
6. lineup: network and channel number, where they belong to one class only.

The confidence of a rule is its precision on labelled records, with Laplace's smoothing; that of a pair is the product
for its two records. Rules on names are judged on records whose identifier is listed in the dictionary or spells a
channel out, the rule on identifiers on records with a listed name or one that says what no other name does, each also on
records that an earlier pass resolves; where the dictionary lists little, a precision is the agreement of both readings. Classes are joined with themselves at the end, large ones in parts of ``PART_ROWS`` records, and give
all their pairs; no pairs of different classes are ever formed. ``classes`` gives one row per record instead.

Defined results: records without an id or a source are left out; NULL and empty fields give no key; records without a key stay alone; repeated records are records of
their own; ties go to the key of more records, then to the smaller key; extra columns are not read; empty tables give
empty results. The dictionary is held in memory and must have at most ``MAX_ENTRIES`` entries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import join_groups, materialise
from .channels import STATES, Parser, fold

#: The dictionary is a model in memory: some 200 bytes an entry.
MAX_ENTRIES = 1_000_000
RULES = ("confirmed", "name", "code", "slip", "cut", "lineup")
#: A key without an identifier is taken as written if it has more records than slips of the better supported key that is
#: near may have: this share of its records and so many times their root, as small numbers scatter.
FIRM_SHARE, FIRM_SCATTER = 0.1, 2.0
#: Records of a class that meet all others of the class in one task.
PART_ROWS = 2_000
SHORT, FULL = 7, 8
#: Up to this length a key is found by what is left without any one letter; in longer ones a slip leaves the first or the
#: last third as it is, and these are compared.
LONGEST = 64


def dictionary_rows(dictionary: DataFrame, columns: list[str]) -> list:
    rows = dictionary.select(*columns).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the dictionary has more than {MAX_ENTRIES} entries")
    return rows


def _plain(text: str | None) -> str:
    return "".join(c for c in fold(text or "").lower() if c.isalnum())


class Reader:
    """Keys and, where the dictionary has one, the label of each record."""

    def __init__(self, entries: list):
        self.parser = Parser((e.name for e in entries), (e.aliases for e in entries))
        owners = defaultdict(set)
        for e in entries:
            for t in [e.name, *(e.aliases or []), *(e.tvg_ids or [])]:
                if _plain(t) and (key := self.parser.parse(e.name).key):
                    owners[_plain(t)].add(key)
        self.labels = {k: next(iter(v)) for k, v in owners.items() if len(v) == 1}

    def read(self, names, code, city, icon) -> tuple[dict, str | None, str | None, str | None]:
        """{(kind, key): (core, genre, number, network)}, labels by identifier and by names, network of a name without a town."""
        keys, bare = {}, None
        listed = {self.labels.get(_plain(t)) for t in names} - {None}
        for n in names:
            p = self.parser.parse(n)
            if p.foreign or p.vod:
                continue
            if p.key:
                keys.setdefault(("name", p.key), p)
            elif p.network:
                bare = p.network
        for source, kind in ((code, "code"), (icon, "code")):
            for p in self.parser.parse_code(source):
                if p.key:
                    keys.setdefault((kind, p.key), p)
        if bare and city:
            words = [w for w in fold(city).lower().replace("/", " ").replace("-", " ").split() if w.isalpha() and w not in STATES]
            if words:
                p = self.parser.parse(f"{bare} {' '.join(words)}")
                if p.key:
                    keys.setdefault(("city", p.key), p)
        spelled = next((p.key for p in self.parser.parse_code(code) if p.key), None)
        return keys, self.labels.get(_plain(code), spelled), listed.pop() if len(listed) == 1 else None, bare


def views(channels: DataFrame, dictionary: DataFrame) -> DataFrame:
    """rid, source, lcn, label, listed, bare, kind, key, core, genre, number, network: a row per key, one without key if there is none."""
    reader = channels.sparkSession.sparkContext.broadcast(Reader(dictionary_rows(dictionary, ["key", "name", "aliases", "tvg_ids"])))

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for rid, source, code, names, city, lcn, icon in zip(p["rid"], p["source"], p["code"], p["names"], p["city"], p["lcn"], p["icon"]):
                keys, label, listed, bare = reader.value.read([n for n in (names if names is not None else []) if n], code, city, icon)
                for (kind, key), x in (keys or {(None, None): None}).items():
                    out.append((rid, source, lcn, label, listed, bare, kind, key, *((x.core, x.genre, x.number, x.network) if x else (None,) * 4)))
            yield pd.DataFrame(out, columns=["rid", "source", "lcn", "label", "listed", "bare", "kind", "key", "core", "genre", "number", "network"])

    rows = channels.filter("chan_row_id IS NOT NULL AND source IS NOT NULL").select(
        F.col("chan_row_id").cast("bigint").alias("rid"), "source", F.col("channel_id").alias("code"), F.col("display_names").alias("names"),
        "city", F.col("lcn").cast("string").alias("lcn"), "icon")
    return rows.mapInPandas(read, "rid bigint, source string, lcn string, label string, listed string, bare string, kind string, key string, core string, genre string, number string, network string")


def _near(a: Column, b: Column) -> Column:
    """One character more, less or other, or two neighbours swapped."""
    letters = lambda c: F.array_join(F.array_sort(F.split(c, "")), "")
    d = F.when((a != b) & (F.abs(F.length(a) - F.length(b)) <= 1), F.levenshtein(a, b, 2))  # -1 beyond; only where lengths allow it
    return (d == 1) | ((d == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)))


def _cuts(word: Column) -> Column:
    """A word of at most SHORT letters and what is left of it without any one letter."""
    word = F.substring(word, 1, SHORT)  # so that longer ones cost nothing where they are filtered out later
    return F.array_union(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))))


def _variants(core: Column) -> Column:
    """Hashes of which two cores share one at least if they are one slip apart."""
    head = F.substring(core, F.lit(1), F.lit(LONGEST + 1))  # all of the keys that are cut
    cut = F.transform(F.sequence(F.lit(1), F.length(head)), lambda i: F.xxhash64(F.concat(F.substring(head, F.lit(1), i - 1), F.substring(head, i + 1, F.length(head)))))
    third = lambda n, of: F.xxhash64(F.lit(of), n, F.substring(core, F.lit(1), n) if of == "first" else F.substring(core, F.length(core) - n + 1, n))
    sizes = [F.expr(f"CAST((length(core) - {k}) div 3 AS INT)") for k in (0, 1)]
    thirds = F.array(*(third(n, of) for n in sizes for of in ("first", "last")))
    # keys about the bound may be met by a longer one
    return F.when(F.length(core) < LONGEST, F.array_union(F.array(F.xxhash64(core)), cut)).when(F.length(core) > LONGEST + 1, F.array_distinct(thirds)).otherwise(
        F.array_distinct(F.concat(F.array(F.xxhash64(core)), cut, thirds)))


def corrections(keys: DataFrame) -> DataFrame:
    """key, rule, target for keys that are slips or short forms of a better supported key."""
    better = (F.col("t_weight") > F.col("weight")) | ((F.col("t_weight") == F.col("weight")) & (F.col("target") < F.col("key")))
    spread = keys.select("key", "weight", "n_rows", "core", "genre", "number", "firm", F.explode(_variants(F.col("core"))).alias("v"))
    theirs = spread.select("v", "genre", "number", F.col("key").alias("target"), F.col("weight").alias("t_weight"), F.col("n_rows").alias("t_rows"), F.col("core").alias("t_core"))
    slips = (
        spread.filter("NOT firm").join(theirs, ["v", "genre", "number"]).filter(better & (F.col("n_rows") <= FIRM_SHARE * F.col("t_rows") + FIRM_SCATTER * F.sqrt("t_rows")) & _near(F.col("core"), F.col("t_core")))
        .groupBy("key").agg(F.min_by("target", F.struct(-F.col("t_weight"), F.col("target"))).alias("target")).select("key", F.lit("slip").alias("rule"), "target")
    )
    tail = F.element_at(F.split("core", " "), -1)
    parted = keys.withColumn("tail", tail).withColumn("head", F.expr("substring(core, 1, length(core) - length(tail))"))
    prefixes = F.transform(F.sequence(F.lit(5), F.lit(SHORT)), lambda i: F.substring(F.col("tail"), F.lit(1), i))
    whole = (
        parted.filter(F.length("tail") >= FULL).select("head", "genre", "number", "weight", "key", F.explode(prefixes).alias("tail"))
        .groupBy("head", "genre", "number", "tail").agg(F.max(F.struct("weight", "key")).alias("to"), F.sum("weight").alias("all"))
        .filter("all <= 2 * to.weight")  # one clear owner of the prefix
    )
    cuts = (
        parted.filter(F.length("tail").between(5, SHORT) & ~F.col("firm")).select("key", "head", "genre", "number", "tail")
        .join(whole, ["head", "genre", "number", "tail"]).select("key", F.lit("cut").alias("rule"), F.col("to.key").alias("target"))
    )
    # a slip within the short form: variants of its letters against those of as many letters of the whole word
    sizes = F.transform(F.sequence(F.lit(SHORT - 1), F.lit(SHORT)), lambda i: F.substring(F.col("tail"), F.lit(1), i))
    begun = (
        parted.filter(F.length("tail") >= FULL).select("head", "genre", "number", "weight", "key", F.explode(sizes).alias("start"))
        .select("head", "genre", "number", "weight", "key", "start", F.length("start").alias("size"), F.explode(_cuts(F.col("start"))).alias("v"))
    )
    blurred = (
        parted.filter(F.length("tail").between(SHORT - 1, SHORT) & ~F.col("firm")).join(cuts, "key", "left_anti")
        .select(F.col("key").alias("short"), "head", "genre", "number", "tail", F.length("tail").alias("size"), F.explode(_cuts(F.col("tail"))).alias("v"))
        .join(begun, ["head", "genre", "number", "size", "v"]).filter(_near(F.col("tail"), F.col("start")) & (F.col("weight") > 1))
        .groupBy("short").agg(F.min("key").alias("target"), F.max("key").alias("other")).filter("target = other")
        .select(F.col("short").alias("key"), F.lit("cut").alias("rule"), "target")
    )
    one = slips.unionByName(cuts).unionByName(blurred).groupBy("key").agg(F.max(F.struct("rule", "target")).alias("c")).select("key", "c.*")
    again = one.select(F.col("key").alias("target"), F.col("target").alias("further"))
    return one.join(again, "target", "left").select("key", "rule", F.coalesce("further", "target").alias("target"))


def resolve(channels: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rid, source, rule, class of each record that the cascade resolved; rule, n_labelled, precision of each rule."""
    v = materialise(views(channels, dictionary))
    keyed = v.filter("key IS NOT NULL")
    keys = materialise(keyed.groupBy("key", "core", "genre", "number", "network").agg(
        F.count_distinct("rid").alias("n_rows"), F.count_distinct("source").alias("n_sources"), F.max(F.col("kind") == "code").alias("firm"),
    ).withColumn("weight", F.col("n_rows") + F.when(F.col("firm"), 2).otherwise(0)))
    fixes = materialise(corrections(keys))
    shared = keys.filter("n_sources >= 2").join(fixes, "key", "left_anti").select("key", "weight")
    of_row = materialise(keyed.groupBy("rid", "source", "lcn", "bare", "key").agg(
        F.count_distinct("kind").alias("kinds"), F.max(F.col("kind") == "name").alias("named")))

    def pick(rows: DataFrame, rule: str, target: str = "key") -> DataFrame:
        """One class for each record: the key of most fields, then of most records."""
        best = rows.groupBy("rid", "source", "lcn", "bare").agg(
            F.min_by(target, F.struct(-F.col("kinds"), -F.col("weight"), F.col(target))).alias("class"))
        return best.withColumn("rule", F.lit(rule))

    known = of_row.join(shared, "key")
    done = pick(known.filter("kinds > 1 AND named"), "confirmed")
    # a record whose own fields agree on a key nobody shares stays there: no other field may take it elsewhere
    own = of_row.filter("kinds > 1 AND named").join(fixes, "key", "left_anti").join(keys.select("key", "weight"), "key")
    done = materialise(done.unionByName(pick(own.join(done, "rid", "left_anti"), "confirmed")))
    parts = keyed.select("rid", "key", "core", "genre", "number", "kind").distinct()
    written_as = parts.filter("kind = 'name'").select("rid", F.col("core").alias("n_core"), F.col("genre").alias("n_genre"), F.col("number").alias("n_number"))
    tail, n_tail = F.element_at(F.split("core", " "), -1), F.element_at(F.split("n_core", " "), -1)
    close = (F.col("genre") == F.col("n_genre")) & (F.col("number") == F.col("n_number")) & (F.levenshtein("core", "n_core", 2).between(0, 2) | F.levenshtein(F.substring("core", F.lit(1), F.length("n_core")), "n_core", 1).between(0, 1) | (tail == n_tail))
    # identifiers, images and cities may be wrong: they count where the record's names do not speak against them
    fitting = parts.filter("kind != 'name'").join(written_as, "rid", "left").groupBy("rid", "key").agg(F.max(F.col("n_core").isNull() | close).alias("fits")).filter("fits").select("rid", "key")
    for rule, part in (("name", known.filter("named")), ("code", known.join(fitting, ["rid", "key"], "left_semi"))):
        done = materialise(done.unionByName(pick(part.join(done, "rid", "left_anti"), rule)))
    weights = keys.select(F.col("key").alias("target"), "weight")
    usable = of_row.filter("named").unionByName(of_row.filter("NOT named").join(fitting, ["rid", "key"], "left_semi"))
    fixed = usable.join(fixes, "key").join(weights, "target")
    plain = usable.join(fixes, "key", "left_anti").withColumn("target", F.col("key")).join(weights, "target").withColumn("rule", F.lit("slip"))
    for rule, part in (("slip", fixed.filter("rule = 'slip'").unionByName(plain)), ("cut", fixed)):
        done = materialise(done.unionByName(pick(part.join(done, "rid", "left_anti"), rule, "target")))
    # network and channel number, where one class has both
    network = keys.filter("network != ''").select(F.col("key").alias("class"), F.col("network").alias("bare"))
    owner = (
        done.drop("bare").filter("lcn IS NOT NULL").join(network, "class").groupBy("bare", "lcn")
        .agg(F.min("class").alias("class"), F.max("class").alias("other")).filter("class = other").drop("other")
    )
    rest = v.filter("bare IS NOT NULL AND lcn IS NOT NULL").select("rid", "source", "lcn", "bare").distinct()
    last = rest.join(done, "rid", "left_anti").join(owner, ["bare", "lcn"]).withColumn("rule", F.lit("lineup"))
    resolved = done.unionByName(last).select("rid", "source", "rule", "class")

    # what each rule says by itself of records with a label of the other kind
    tried = keyed.filter("kind IN ('name', 'code')").select("rid", "key", "kind").distinct()
    exact = tried.join(shared, "key").select("rid", F.col("kind").alias("rule"), F.col("key").alias("said"), F.lit(1).alias("kinds"), "weight")
    mended = tried.filter("kind = 'name'").join(fixes, "key").join(weights, "target").select("rid", "rule", F.col("target").alias("said"), F.lit(1).alias("kinds"), "weight")
    agreed = known.filter("kinds > 1 AND named").select("rid", F.lit("confirmed").alias("rule"), F.col("key").alias("said"), "kinds", "weight")
    loose = last.select("rid", "rule", F.col("class").alias("said"), F.lit(1).alias("kinds"), F.lit(0).cast("bigint").alias("weight"))
    said = exact.unionByName(mended).unionByName(agreed).unionByName(loose).groupBy("rid", "rule").agg(
        F.min_by("said", F.struct(-F.col("kinds"), -F.col("weight"), F.col("said"))).alias("said"))
    written = known.filter("named").groupBy("rid").agg(F.min("key").alias("one"), F.max("key").alias("other")).filter("one = other").select("rid", "one")
    labels = v.groupBy("rid").agg(F.min("label").alias("label"), F.min("listed").alias("listed")).join(written, "rid", "left").select("rid", "label", F.coalesce("listed", "one").alias("listed"))
    trials = said.join(labels, "rid").withColumn("truth", F.when(F.col("rule") == "code", F.col("listed")).otherwise(F.col("label"))).filter("truth IS NOT NULL").select(
        "rule", (F.col("said") == F.col("truth")).alias("right"))
    return resolved, _precisions(trials)


def _precisions(trials: DataFrame) -> DataFrame:
    found = trials.groupBy("rule").agg(F.count("*").alias("n"), F.count_if("right").alias("right"))
    every = trials.sparkSession.createDataFrame([(r,) for r in RULES], "rule string")
    n, right = F.coalesce("n", F.lit(0)), F.coalesce("right", F.lit(0))
    return every.join(found, "rule", "left").select("rule", n.alias("n_labelled"), ((right + 1) / (n + 2)).alias("precision"))


def classes(channels: DataFrame, dictionary: DataFrame) -> DataFrame:
    """chan_row_id, class, rule, confidence, n_links: one row per resolved record; n_links counts the records of other
    sources in its class."""
    resolved, precision = resolve(channels, dictionary)
    scored = materialise(resolved.join(F.broadcast(precision), "rule"))  # one row per rule
    per = scored.groupBy("class", "source").agg(F.count("*").alias("own"))
    every = per.groupBy("class").agg(F.sum("own").alias("n"))
    sizes = per.join(every, "class").select("class", "source", "own", (F.col("n") - F.col("own")).alias("n_links"))
    return join_groups(scored, sizes, ["class", "source"], "own", scored.count()).select(
        F.col("rid").alias("chan_row_id"), "class", "rule", F.round("precision", 6).alias("confidence"), "n_links")


def pairs(channels: DataFrame, dictionary: DataFrame) -> DataFrame:
    """row_a, row_b, rule, match_score: two records of different sources in one class; the rule is the weaker of the two."""
    resolved, precision = resolve(channels, dictionary)
    scored = materialise(resolved.join(F.broadcast(precision), "rule"))  # one row per rule
    rank = F.array_position(F.array(*(F.lit(r) for r in RULES)), F.col("rule"))
    sizes = scored.groupBy("class").agg(F.count("*").alias("n")).filter("n > 1").withColumn("parts", F.ceil(F.col("n") / F.lit(PART_ROWS)).cast("int"))
    side = join_groups(scored, sizes, ["class"], "n", scored.count()).select("class", "rid", "source", rank.alias("rank"), "precision", "parts")
    named = lambda df, x: df.select("class", "part", *(F.col(c).alias(f"{c}_{x}") for c in ("rid", "source", "rank", "precision")))
    # each record is in one part on one side and in all parts on the other: every pair meets once, no class in one task
    a = named(side.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")), "a")
    b = named(side.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "b")
    joined = a.join(b, ["class", "part"]).filter("rid_a < rid_b AND source_a != source_b")
    rule = F.element_at(F.array(*(F.lit(r) for r in RULES)), F.greatest("rank_a", "rank_b").cast("int"))
    return joined.select(
        F.col("rid_a").alias("row_a"), F.col("rid_b").alias("row_b"), rule.alias("rule"),
        F.round(F.col("precision_a") * F.col("precision_b"), 6).alias("match_score"))
