"""Catalogs, identifiers, matching and playlists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import catalog, match, playlist, schedule
from ..runtime import load
from ..sources import m3u
from .schedule_queries import NOW, REPAIRED, fixed
from .sqlgen import lit, rewrite

QUERIES, ORACLE = {}, {}
#: SQL of names that are defined further down.
LATER: list = []


def query(sql=None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            LATER.append((f.__name__, sql)) if callable(sql) else ORACLE.__setitem__(f.__name__, sql)
        return f

    return register


def _e(spark, sf_dir):
    return load(spark, sf_dir, "playlist_entries").filter("display_name IS NOT NULL")


def _d(spark, sf_dir):
    return load(spark, sf_dir, "channel_dictionary")


def _c(spark, sf_dir):
    return load(spark, sf_dir, "source_channels")


def _pc(spark, sf_dir):
    """Playlists as sources: each entry declares a channel of one name."""
    e = _e(spark, sf_dir)
    return e.select(F.col("playlist").alias("source"), F.coalesce(F.nullif("tvg_id", F.lit("")), F.concat(F.lit("e"), F.col("entry_id").cast("string"))).alias("channel_id"), F.array("display_name").alias("display_names"))


_PC = "pc AS (SELECT playlist AS source, coalesce(nullif(tvg_id, ''), 'e' || entry_id::VARCHAR) AS channel_id, [display_name] AS display_names FROM playlist_entries WHERE display_name IS NOT NULL)"


def nn(x):
    return rewrite(x, names.NORM_NAME)


def nk(x):
    return rewrite(x, names.NAME_KEY)


def ik(x):
    return rewrite(x, names.ID_KEY)


def words(x):
    stop = ", ".join(lit(w) for w in (*names.STOP_WORDS, ""))
    return f"array_to_string(list_sort(list_filter(list_distinct(string_split({nk(x)}, ' ')), lambda w: w NOT IN ({stop}))), ' ')"


E_SQL = f"WITH e AS (SELECT *, {nn('display_name')} AS key FROM playlist_entries WHERE display_name IS NOT NULL)"


@query(f"""{E_SQL} SELECT key, arg_min(display_name, (playlist, line_no, entry_id)) AS name, coalesce(arg_min(group_title, (playlist, line_no, entry_id)) FILTER (coalesce(group_title, '') != ''), '') AS group_title,
 array_to_string(list_sort(list(DISTINCT display_name)), '|') AS aliases, coalesce(array_to_string(list_sort(list(DISTINCT tvg_id) FILTER (coalesce(tvg_id, '') != '')), '|'), '') AS tvg_ids, count(*) AS observations,
 count(*) FILTER (coalesce(tvg_id, '') = '') AS blank_ids, count(DISTINCT playlist) AS n_playlists FROM e WHERE key != '' GROUP BY key""")
def catalog_merge(spark, sf_dir):
    m = catalog.merged(_e(spark, sf_dir))
    return m.select("key", "name", F.coalesce("group_title", F.lit("")).alias("group_title"), F.array_join("aliases", "|").alias("aliases"), F.array_join("tvg_ids", "|").alias("tvg_ids"), "observations", "blank_ids", "n_playlists")


@query(f"""WITH v AS (SELECT {nn('display_name')} AS key, {rewrite('display_name', names.QUALITY_STRIP)} AS name, 1 AS v FROM playlist_entries WHERE display_name IS NOT NULL UNION ALL SELECT {nn('name')}, name, {catalog.MANUAL_VOTES} FROM channel_dictionary),
g AS (SELECT key, name, sum(v)::BIGINT AS votes FROM v WHERE key != '' AND name != '' GROUP BY ALL) SELECT key, arg_min(name, (-votes, name)) AS name, max(votes) AS votes, count(*) AS n_names FROM g GROUP BY key""")
def catalog_top_names(spark, sf_dir):
    return catalog.top_names(_e(spark, sf_dir), _d(spark, sf_dir))


@query(f"{E_SQL} SELECT key, coalesce(tvg_id, '') AS tvg_id, count(*) AS seen FROM e WHERE key != '' GROUP BY ALL")
def learned_upsert(spark, sf_dir):
    e = _e(spark, sf_dir)
    old, new = F.crc32("playlist") % 2 == 0, F.crc32("playlist") % 2 == 1
    return catalog.upserted(catalog.observations(e.filter(old)), catalog.observations(e.filter(new)))


@query(f"""{E_SQL}, s AS (SELECT key, {ik('tvg_id')} AS id FROM e WHERE key != '' AND coalesce(tvg_id, '') != '') SELECT id, count(DISTINCT key) AS owners, count(*) AS seen, count(DISTINCT key) = 1 AS trusted FROM s GROUP BY id""")
def ambiguous_ids(spark, sf_dir):
    return catalog.trusted_ids(catalog.observations(_e(spark, sf_dir))).select("id", "owners", "seen", "trusted")


@query(f"""WITH s AS (SELECT DISTINCT {ik('tvg_id')} AS id, string_split({words('display_name')}, ' ') AS w FROM playlist_entries WHERE display_name IS NOT NULL AND coalesce(tvg_id, '') != ''),
u AS (SELECT * FROM s WHERE id != '' AND w != ['']), m AS (SELECT * FROM u a WHERE NOT EXISTS (SELECT 1 FROM u b WHERE a.id = b.id AND len(b.w) > len(a.w) AND list_has_all(b.w, a.w))) SELECT id, count(*) AS n_maximal FROM m GROUP BY id HAVING count(*) >= 2""")
def poisoned_ids(spark, sf_dir):
    return catalog.poisoned_ids(_e(spark, sf_dir).filter("coalesce(tvg_id, '') != ''"))


@query(f"WITH a AS (SELECT DISTINCT key, {nn('a')} AS alias FROM (SELECT key, unnest(list_prepend(name, aliases)) AS a FROM channel_dictionary)) SELECT alias, min(key) AS key FROM a WHERE alias != '' GROUP BY alias HAVING count(*) = 1")
def alias_unique_index(spark, sf_dir):
    return catalog.alias_index(_d(spark, sf_dir))


@query(f"""WITH n AS (SELECT DISTINCT channel_id AS id, {nk('n')} AS name_key FROM (SELECT channel_id, unnest(display_names) AS n FROM source_channels WHERE channel_id IS NOT NULL)), f AS (SELECT * FROM n WHERE name_key != ''),
c AS (SELECT *, count(*) OVER (PARTITION BY id) AS n_keys, {nk('id')} = name_key AS exact FROM f) SELECT name_key, arg_min(id, (CASE WHEN exact THEN 0 ELSE 1 END, CASE WHEN exact THEN 0 ELSE n_keys END, id)) AS owner, count(*) AS n_claims FROM c GROUP BY name_key""")
def name_owner_dedupe(spark, sf_dir):
    return catalog.name_owners(_c(spark, sf_dir).filter("channel_id IS NOT NULL").select(F.col("channel_id").alias("id"), F.explode("display_names").alias("name")))


_QS = rewrite("name", names.QUALITY_STRIP)


@query(f"""WITH b AS (SELECT key, aliases, tvg_ids, CASE WHEN name = {_QS} THEN [name] ELSE [name, {_QS}] END AS b FROM channel_dictionary),
v AS (SELECT key, list_concat(flatten(list_transform(b, lambda x: list_transform(['', {", ".join(lit(" " + s) for s in catalog.SUFFIXES)}], lambda m: x || m))), list_concat(coalesce(aliases, []), coalesce(tvg_ids, []))) AS v FROM b),
u AS (SELECT key, unnest(v) AS alias, generate_subscripts(v, 1) - 1 AS pos FROM v) SELECT key, min(pos)::INT AS pos, arg_min(alias, pos) AS alias FROM u WHERE length(alias) BETWEEN 2 AND 100 GROUP BY key, upper(alias)""")
def alias_generation(spark, sf_dir):
    return catalog.clean_aliases(_d(spark, sf_dir))


_IS_SAFE = "(NOT regexp_matches(trim({0}), '[\\s&!+\"''<>;]') AND trim({0}) != '' AND strip_accents({0}) = {0})"
_SHOWN = rewrite("name", names.QUALITY_STRIP)
_SAFELY = rewrite("shown", names.SAFE_ID)


@query(lambda: f"""WITH d AS (SELECT *, {_SHOWN} AS shown, array_to_string({_NUMS('name')}, ',') AS nums FROM channel_dictionary)
SELECT key, coalesce(list_filter(coalesce(tvg_ids, []), lambda i: {_IS_SAFE.format('i')} AND array_to_string({_NUMS('i')}, ',') = nums)[1],
 CASE WHEN {_IS_SAFE.format('shown')} THEN trim(shown) WHEN suffix({_SAFELY}, '.br') THEN {_SAFELY} ELSE lower({_SAFELY}) END) AS export_id FROM d""")
def export_ids(spark, sf_dir):
    return catalog.export_ids(_d(spark, sf_dir))


@query(f"""WITH e AS (SELECT {ik('channel_id')} AS export_id, source || '/' || channel_id AS key, display_names[1] AS name FROM source_channels WHERE channel_id IS NOT NULL AND len(display_names) > 0), k AS (SELECT *, {nk('name')} AS nk FROM e),
f AS (SELECT export_id, min(key) AS owner, arg_min(nk, (key, nk)) AS onk FROM k GROUP BY 1) SELECT export_id, min(key) AS key, array_to_string(list_sort(list(DISTINCT name)), '|') AS names FROM k JOIN f USING (export_id) WHERE key = owner OR nk = onk GROUP BY 1""")
def export_conflicts(spark, sf_dir):
    c = _c(spark, sf_dir).filter("channel_id IS NOT NULL AND size(display_names) > 0").select(names.id_key(F.col("channel_id")).alias("export_id"), F.concat("source", F.lit("/"), "channel_id").alias("key"), F.col("display_names")[0].alias("name"))
    return catalog.exported_once(c).select("export_id", "key", F.array_join("names", "|").alias("names"))


@query(f"{E_SQL}, t AS (SELECT {ik('tvg_id')} AS id, count(DISTINCT key) = 1 AS trusted FROM e WHERE key != '' AND coalesce(tvg_id, '') != '' GROUP BY 1), o AS (SELECT key, tvg_id, count(*) AS seen FROM e WHERE key != '' AND coalesce(tvg_id, '') != '' GROUP BY ALL), "
       f"k AS (SELECT o.*, trusted, row_number() OVER (PARTITION BY key ORDER BY seen DESC, tvg_id) AS k FROM o JOIN t ON t.id = {ik('tvg_id')}) SELECT e.key, count(*) AS observations, count(*) FILTER (coalesce(tvg_id, '') = '') AS blank_ids, coalesce((SELECT string_agg(k.tvg_id || ':' || k.trusted::VARCHAR, '|' ORDER BY k.k) FROM k WHERE k.key = e.key AND k.k <= {catalog.CAPS['tvg_ids']}), '') AS ids FROM e WHERE key != '' GROUP BY e.key")
def learned_catalog(spark, sf_dir):
    e = _e(spark, sf_dir)
    c = catalog.learned_catalog(catalog.observations(e), catalog.top_names(e, _d(spark, sf_dir)).select("key", "name"))
    ids = F.array_join(F.transform(F.coalesce("ids", F.array().cast("array<struct<k:int,tvg_id:string,seen:bigint,trusted:boolean>>")), lambda x: F.concat(x["tvg_id"], F.lit(":"), x["trusted"].cast("string"))), "|")
    return c.select("key", "observations", "blank_ids", ids.alias("ids"))


@query("""WITH f AS (SELECT doc_id AS file, sha256(text) AS fp FROM documents WHERE text IS NOT NULL), k AS (SELECT DISTINCT sha256(text) AS fp FROM documents WHERE source = 'guia_impresso' AND text IS NOT NULL)
SELECT fp AS fingerprint, min(file) AS file, count(*) AS n_copies FROM f WHERE fp NOT IN (SELECT fp FROM k) GROUP BY fp""")
def fingerprint_skip(spark, sf_dir):
    d = load(spark, sf_dir, "documents").filter("text IS NOT NULL").select(F.col("doc_id").alias("file"), F.col("text").alias("content"), "source")
    known = d.filter("source = 'guia_impresso'").select(F.sha2("content", 256).alias("fingerprint"))
    return catalog.new_files(d.drop("source"), known)


def _tiers_sql() -> str:
    w = "|".join((*names.UFS, *match.LOCAL_WORDS))
    return f"""WITH o AS (SELECT key, name, unnest(list_prepend(name, aliases)) AS alias, generate_subscripts(list_prepend(name, aliases), 1) - 1 AS pos FROM channel_dictionary),
ev AS (SELECT key, name, 1 AS tier, pos, alias FROM o UNION ALL SELECT key, name, 2, pos, trim(regexp_replace(alias, '(?i)[\\s/(-]+(?:{w})\\)?\\s*$', '', 'g')) FROM o), en AS (SELECT *, {nn('alias')} AS norm FROM ev),
ti AS (SELECT key, name, norm, min((tier, pos, alias))[1] AS tier, min((tier, pos, alias))[2] AS pos FROM en WHERE norm != '' GROUP BY ALL)"""


_STATES = lambda x: f"list_intersect(list_distinct(string_split({nk(x)}, ' ')), [{', '.join(lit(u) for u in names.UFS)}])"
_NUMS = lambda x: "list_transform(regexp_extract_all(" + rewrite(x, ("unescape", "upper", (r"\b(?:H\.?264|H\.?265|1080[PI]?|720P?|60FPS|4K|8K|24HS?|24/7|BR\d+|SRV\d+|SERVER\s*\d+|OP\d+|1X)\b", " "), (r"[¹²³⁴⁵⁶⁷⁸⁹⁰]+", " "))) + ", '\\d+'), lambda d: regexp_replace(d, '^0+(\\d)', '\\1'))"
_COUNTRY = lambda x: f"regexp_extract({rewrite(x, ('unescape', 'upper', (r'^[^A-Z0-9]+', '')))}, '^({'|'.join(sorted(names.COUNTRIES, key=len, reverse=True))})\\b', 1)"
_MATCHES = f"""{_tiers_sql()}, {_PC}, cn AS (SELECT DISTINCT source, channel_id, cname, {nn('cname')} AS norm FROM (SELECT source, channel_id, unnest(display_names) AS cname FROM pc)),
bn AS (SELECT key, source, channel_id, tier, 'exact' AS method, 1 AS mr, pos, 1.0::DOUBLE AS match_score FROM ti JOIN cn USING (norm) WHERE norm != '' AND {_NUMS('name')} = {_NUMS('cname')} AND {_COUNTRY('name')} = {_COUNTRY('cname')}
 AND NOT (len({_STATES('name')}) > 0 AND len({_STATES('cname')}) > 0 AND NOT list_has_any({_STATES('name')}, {_STATES('cname')}))),
ids AS (SELECT key, unnest(tvg_ids) AS i, generate_subscripts(tvg_ids, 1) - 1 AS pos FROM channel_dictionary), idn AS (SELECT key, pos, {rewrite('i', names.SOURCE_ID)} AS id FROM ids),
ch AS (SELECT DISTINCT source, channel_id, {rewrite('channel_id', names.SOURCE_ID)} AS id FROM pc),
al AS (SELECT * FROM bn UNION ALL SELECT key, source, channel_id, 1, 'id', 0, pos, 0.98 FROM idn JOIN ch USING (id) WHERE id != ''),
rc AS (SELECT source, channel_id, count(*) AS n_rows FROM pc GROUP BY ALL), c AS (SELECT al.*, coalesce(n_rows, 0) AS n_rows FROM al LEFT JOIN rc USING (source, channel_id)),
be AS (SELECT *, row_number() OVER (PARTITION BY key, source ORDER BY (n_rows = 0)::INT, tier, mr, pos, n_rows DESC, channel_id) AS k FROM c), b1 AS (SELECT * FROM be WHERE k = 1),
bt AS (SELECT key, tier, max((match_score >= 0.9 AND n_rows > 0)::INT) AS strong, count(*) FILTER (n_rows > 0) AS wr FROM b1 GROUP BY ALL), rt AS (SELECT key, tier, max(strong) OVER w AS strong, sum(wr) OVER w AS wr FROM bt WINDOW w AS (PARTITION BY key ORDER BY tier)),
so AS (SELECT key, min(tier) AS stop FROM rt WHERE strong = 1 OR wr >= 2 GROUP BY key)"""


def _matches(spark, sf_dir):
    d, c = _d(spark, sf_dir), _pc(spark, sf_dir)
    counts = c.groupBy("source", "channel_id").agg(F.count("*").alias("n_rows"))
    return match.tiered(match.by_name(match.tiers(d), c).unionByName(match.by_id(d, c)), counts)


@query(f"{_MATCHES} SELECT key, source, channel_id, tier::INT AS tier, method, n_rows FROM b1 LEFT JOIN so USING (key) WHERE stop IS NULL OR tier <= stop")
def exact_tiered_match(spark, sf_dir):
    return _matches(spark, sf_dir).select("key", "source", "channel_id", "tier", "method", "n_rows")


_COUNT = lambda c, x: f"(length({c}) - length(replace({c}, '{x}', '')))"
_COMMON = " + ".join(f"least({_COUNT('a', x)}, {_COUNT('b', x)})" for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_REST = "least(length(regexp_replace(a, '[A-Z0-9]', '', 'g')), length(regexp_replace(b, '[A-Z0-9]', '', 'g')))"


@query(f"""{_tiers_sql()}, {_PC}, aa AS (SELECT DISTINCT key, norm AS a, array_to_string(regexp_extract_all(norm, '\\d+'), ',') AS dg FROM ti WHERE length(norm) >= {match.FUZZY_LENGTH}),
bb AS (SELECT DISTINCT source, channel_id, b, array_to_string(regexp_extract_all(b, '\\d+'), ',') AS dg FROM (SELECT source, channel_id, {nn('display_names[1]')} AS b FROM pc) WHERE b != '')
SELECT key, count(*) AS n_pairs FROM aa JOIN bb USING (dg) WHERE 2.0::DOUBLE * least(length(a), length(b)) / (length(a) + length(b)) >= {match.FUZZY_BOUND} AND 2.0::DOUBLE * ({_COMMON} + {_REST}) / (length(a) + length(b)) >= {match.FUZZY_BOUND} GROUP BY key""")
def fuzzy_bound_block(spark, sf_dir):
    return match.fuzzy_pairs(match.tiers(_d(spark, sf_dir)), _pc(spark, sf_dir)).groupBy("key").agg(F.count("*").alias("n_pairs"))


@query()
def fuzzy_match(spark, sf_dir):
    return match.fuzzy(match.tiers(_d(spark, sf_dir)), _pc(spark, sf_dir))


@query(f"{_MATCHES}, mm AS (SELECT key, source, channel_id, method FROM b1 LEFT JOIN so USING (key) WHERE (stop IS NULL OR tier <= stop) AND NOT (key = 'VALENOTICIAS24' AND source = 'lista_00_0000.m3u')) SELECT key, source, channel_id, method, false AS selected FROM mm UNION ALL SELECT 'VALENOTICIAS24', 'lista_00_0000.m3u', 'ValeNoticias24.br', 'override', true")
def manual_override(spark, sf_dir):
    o = spark.createDataFrame([("VALENOTICIAS24", "lista_00_0000.m3u", "ValeNoticias24.br")], "key string, source string, channel_id string")
    return match.overridden(_matches(spark, sf_dir), o).select("key", "source", "channel_id", "method", "selected")


@query()
def id_validity(spark, sf_dir):
    e = _e(spark, sf_dir).filter("coalesce(tvg_id, '') != ''")
    return e.select("entry_id", match.valid_id(F.col("display_name"), F.col("tvg_id")).alias("valid"))


_NETS = ("AURORA", "BRISA", "CASCATA", "HORIZONTE", "JACARANDA", "ORVALHO", "PLANALTO", "SERTAO", "TUCUMA", "VENTANIA", "ZENITE")
_HELD = lambda x: f"list_intersect(string_split({nk(x)}, ' '), [{', '.join(lit(n) for n in _NETS)}])"


@query(f"""WITH e AS (SELECT entry_id, display_name, d.name AS entry FROM playlist_entries JOIN channel_dictionary d ON list_contains(d.tvg_ids, tvg_id) WHERE display_name IS NOT NULL)
SELECT entry_id, entry, len({_HELD('entry')}) > 0 AND len({_HELD('display_name')}) > 0 AND NOT list_has_any({_HELD('entry')}, {_HELD('display_name')}) AS conflict FROM e""")
def network_conflict(spark, sf_dir):
    ids = _d(spark, sf_dir).select(F.col("name").alias("entry"), F.explode("tvg_ids").alias("tvg_id"))
    j = _e(spark, sf_dir).join(ids, "tvg_id")
    return j.select("entry_id", "entry", match.network_conflict(F.col("entry"), F.col("display_name"), _NETS).alias("conflict"))


@query(f"""{REPAIRED}, co AS (SELECT source, channel_id, max(e) AS last FROM f GROUP BY ALL), sc AS (SELECT DISTINCT source, channel_id, {nn('n')} AS key FROM (SELECT source, channel_id, unnest(display_names) AS n FROM source_channels)),
mt AS (SELECT key, source, channel_id, last, row_number() OVER (PARTITION BY key ORDER BY source, channel_id) AS tier FROM sc JOIN co USING (source, channel_id) WHERE key != ''), en AS (SELECT key, max(last) AS fin FROM mt WHERE tier = 1 GROUP BY key HAVING max(last) < {NOW} + 259200)
SELECT key, source, channel_id, last FROM mt JOIN en USING (key) WHERE tier > 1 AND last > fin + 21600""")
def tail_donors(spark, sf_dir):
    from pyspark.sql import Window

    cover = fixed(spark, sf_dir).groupBy("source", "channel_id").agg(F.max("e").alias("last"))
    n = match.channel_names(_c(spark, sf_dir)).select("source", "channel_id", F.col("norm").alias("key")).distinct()
    # tiers by source for the query's sake: every match behind the first is a deeper one
    m = n.join(cover.select("source", "channel_id"), ["source", "channel_id"], "left_semi").withColumn("tier", F.row_number().over(Window.partitionBy("key").orderBy("source", "channel_id")))
    return match.tail_donors(m, cover, NOW).select("key", "source", "channel_id", "last")


@query("SELECT playlist, line_no, coalesce(trim(tvg_id), '') AS tvg_id, coalesce(trim(tvg_name), '') AS tvg_name, coalesce(trim(group_title), '') AS group_title, CASE WHEN trim(display_name) = '' THEN coalesce(trim(tvg_name), '') ELSE trim(display_name) END AS display_name FROM playlist_entries WHERE display_name IS NOT NULL AND NOT regexp_matches(coalesce(tvg_name, '') || display_name || coalesce(group_title, ''), '&[a-z#0-9]+;|\"')")
def playlist_parse(spark, sf_dir):
    e = _e(spark, sf_dir).filter(~F.concat(F.coalesce("tvg_name", F.lit("")), F.col("display_name"), F.coalesce("group_title", F.lit(""))).rlike('&[a-z#0-9]+;|"'))
    lines = m3u.render(e)
    urls = lines.select("playlist", (F.col("line_no") + 1).alias("line_no"), F.format_string("http://example.org/%d", F.col("line_no")).alias("text"))
    strip = lambda c: F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "").alias(c)
    return m3u.parse(lines.unionByName(urls)).select("playlist", "line_no", *(strip(c) for c in ("tvg_id", "tvg_name", "group_title", "display_name")))


_GUIDE = "g AS (SELECT DISTINCT coalesce(tvg_ids[1], key) AS id, unnest(list_prepend(name, aliases)) AS name FROM channel_dictionary)"


def _guide(spark, sf_dir):
    return _d(spark, sf_dir).select(F.coalesce(F.get("tvg_ids", F.lit(0)), F.col("key")).alias("id"), F.explode(F.concat(F.array("name"), "aliases")).alias("name")).distinct()


_REKEY = f"""WITH {_GUIDE}, k1 AS (SELECT nk, min(id) AS lo, max(id) AS hi, count(*) AS n FROM (SELECT DISTINCT id, {nk('name')} AS nk FROM g) WHERE nk != '' GROUP BY nk),
k2 AS (SELECT ws, min(id) AS lo, max(id) AS hi, count(*) AS n FROM (SELECT DISTINCT id, {words('name')} AS ws FROM g) WHERE ws != '' GROUP BY ws),
e AS (SELECT *, {nk("coalesce(nullif(trim(tvg_name), ''), display_name)")} AS nk, {words("coalesce(nullif(trim(tvg_name), ''), display_name)")} AS ws FROM playlist_entries WHERE display_name IS NOT NULL),
j AS (SELECT entry_id, tvg_id, k1.n AS n1, k2.n AS n2, CASE WHEN k1.lo = k1.hi THEN k1.lo END AS i1, CASE WHEN k2.lo = k2.hi THEN k2.lo END AS i2, tvg_id IN (SELECT id FROM g) AS known FROM e LEFT JOIN k1 USING (nk) LEFT JOIN k2 USING (ws)),
rk AS (SELECT entry_id, coalesce(i1, CASE WHEN n1 IS NULL THEN i2 END, CASE WHEN known THEN tvg_id END, '') AS new_id, CASE WHEN i1 IS NOT NULL THEN 'name' WHEN n1 IS NULL AND i2 IS NOT NULL THEN 'words' WHEN known THEN 'kept' WHEN n1 > 1 OR n2 > 1 THEN 'ambiguous' ELSE 'none' END AS reason FROM j)"""


@query(f"{_REKEY} SELECT * FROM rk")
def playlist_rekey(spark, sf_dir):
    return playlist.rekeyed(_e(spark, sf_dir), _guide(spark, sf_dir))


@query(f"{_REKEY} SELECT reason, count(*) AS n_entries FROM rk GROUP BY reason")
def rekey_reasons(spark, sf_dir):
    return playlist.rekeyed(_e(spark, sf_dir), _guide(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n_entries"))


@query(f"{_REKEY} SELECT display_name, min(new_id) AS tvg_id FROM rk JOIN playlist_entries USING (entry_id) WHERE new_id != '' GROUP BY 1 HAVING min(new_id) = max(new_id)")
def playlist_id_map(spark, sf_dir):
    e = _e(spark, sf_dir)
    return playlist.id_map(playlist.rekeyed(e, _guide(spark, sf_dir)), e)


def _resolve_sql() -> str:
    plain = rewrite(rewrite("display_name", names.QUALITY_STRIP), names.PLAIN_KEY)
    fits = lambda i: f"({i} IS NOT NULL AND {_IS_SAFE.format(i)} AND array_to_string({_NUMS(i)}, ',') = nums)"
    foreign = f"({_COUNTRY('display_name')} != '' AND NOT regexp_matches({rewrite('display_name', ('unescape', 'upper', (r'^[^A-Z0-9]+', '')))}, '^USA (?:NETWORK|HD|FHD|SD|UHD|4K)\\b'))"
    return f"""WITH {_GUIDE}, bad AS ({ORACLE['poisoned_ids']}), p1 AS (SELECT {rewrite('name', names.PLAIN_KEY)} AS k, min(id) AS pid FROM g WHERE name IS NOT NULL GROUP BY 1 HAVING k != ''), n1 AS (SELECT {nk('name')} AS k, min(id) AS nid FROM g WHERE name IS NOT NULL GROUP BY 1 HAVING k != ''),
e AS (SELECT *, {plain} AS pk, {nk('display_name')} AS nk, {ik("coalesce(tvg_id, '')")} AS ik, array_to_string({_NUMS('display_name')}, ',') AS nums, regexp_matches(display_name, {lit(playlist.NO_GUIDE)}) OR {foreign} AS nothing FROM playlist_entries WHERE display_name IS NOT NULL),
j AS (SELECT entry_id, CASE WHEN nothing THEN 'no_guide' WHEN {fits('pid')} THEN 'plain' WHEN {fits('nid')} THEN 'key' WHEN ik != '' AND ik NOT IN (SELECT id FROM bad) AND {fits('tvg_id')} THEN 'original' ELSE 'unresolved' END AS reason, pid, nid, tvg_id AS own
 FROM e LEFT JOIN p1 ON p1.k = pk LEFT JOIN n1 ON n1.k = nk)
SELECT entry_id, CASE reason WHEN 'plain' THEN pid WHEN 'key' THEN nid WHEN 'original' THEN own ELSE '' END AS tvg_id, reason FROM j"""


@query(_resolve_sql)
def playlist_resolve(spark, sf_dir):
    e = _e(spark, sf_dir)
    return playlist.resolved(e, _guide(spark, sf_dir), catalog.poisoned_ids(e.filter("coalesce(tvg_id, '') != ''")))


@query(f"""{_REKEY} SELECT playlist, line_no, '#EXTINF:-1 tvg-id="' || new_id || '" tvg-name="' || coalesce(replace(tvg_name, '"', '&quot;'), '') || '" group-title="' || coalesce(replace(group_title, '"', '&quot;'), '') || '",' || display_name AS text FROM rk JOIN playlist_entries USING (entry_id)""")
def playlist_rewrite(spark, sf_dir):
    e = _e(spark, sf_dir)
    lines = m3u.render(e).join(e.select("playlist", "line_no", "entry_id"), ["playlist", "line_no"]).join(playlist.rekeyed(e, _guide(spark, sf_dir)), "entry_id")
    return lines.select("playlist", "line_no", m3u.set_attribute(F.col("text"), "tvg-id", F.col("new_id")).alias("text"))


_AUTO = lambda x: f"'auto.' || lower(CASE WHEN {nn(x)} = '' THEN 'canal' ELSE {nn(x)} END)"


@query(f"""WITH n AS (SELECT entry_id, display_name AS name, {_AUTO('display_name')} AS id FROM playlist_entries WHERE display_name IS NOT NULL), f AS (SELECT id, arg_min(name, (entry_id, name)) AS fn FROM n GROUP BY 1)
SELECT entry_id, CASE WHEN name = fn THEN id ELSE id || '.' || substr(sha1(name), 1, 8) END AS id FROM n JOIN f USING (id)""")
def stable_ids(spark, sf_dir):
    return catalog.stable_ids(_e(spark, sf_dir), "entry_id", "display_name")


@query(f"""SELECT entry_id, CASE WHEN {_COUNTRY('display_name')} != '' AND NOT regexp_matches({rewrite('display_name', ('unescape', 'upper'))}, '^USA (?:NETWORK|HD)') THEN {rewrite('display_name', (*names.QUALITY_STRIP, 'unaccent', 'upper'))}
 ELSE {rewrite('display_name', (*names.QUALITY_STRIP, 'unaccent', 'upper', *names.REWRITES, 'squeeze'))} END AS name FROM playlist_entries WHERE display_name IS NOT NULL""")
def name_rewrites(spark, sf_dir):
    return _e(spark, sf_dir).select("entry_id", names.rewritten(F.col("display_name")).alias("name"))


_NUP, _GUP = rewrite("display_name", ("unaccent", "upper")), rewrite("coalesce(group_title, '')", ("unaccent", "upper"))
_GROUP_NETS = ("ABERTOS", "INFANTIL", "NOTICIAS")


@query(f"SELECT entry_id, CASE WHEN {' OR '.join(f'contains({_NUP}, {lit(x)})' for x in _GROUP_NETS)} THEN {_NUP} {' '.join(f'WHEN contains({_GUP}, {lit(x)}) THEN {lit(x + chr(32))} || {_NUP}' for x in _GROUP_NETS)} ELSE {_NUP} END AS name FROM playlist_entries WHERE display_name IS NOT NULL")
def network_by_group(spark, sf_dir):
    return _e(spark, sf_dir).select("entry_id", names.with_network(F.col("display_name"), F.col("group_title"), _GROUP_NETS).alias("name"))


_RIGHT = f"regexp_replace(regexp_replace(split_part(channel_id, '..', 2) || CASE WHEN len(string_split(channel_id, '..')) > 2 THEN '..' || array_to_string(string_split(channel_id, '..')[3:], '..') ELSE '' END, '(?i)\\.(?:{names.DOMAINS})$', ''), '[.\\-–—_]+', ' ', 'g')"


@query(f"""WITH p AS (SELECT chan_row_id, {_RIGHT} AS r, split_part(channel_id, '..', 1) AS l FROM source_channels WHERE contains(channel_id, '..')),
m AS (SELECT chan_row_id, [trim(r), concat_ws(' ', split_part(r, ' ', 1), trim(regexp_replace(l, '[./]', ' ', 'g'))), concat_ws(' ', split_part(r, ' ', 1), trim(replace(split_part(l, '/', 1), '.', ' ')))] AS c FROM p),
n AS (SELECT chan_row_id, CASE WHEN c[2] IN (c[1]) THEN [c[1]] ELSE c[1:2] END AS two, c FROM m)
SELECT chan_row_id, array_to_string(list_filter(CASE WHEN list_contains(two, c[3]) THEN two ELSE list_append(two, c[3]) END, lambda x: trim(x) != ''), '|') AS candidates FROM n""")
def compound_ids(spark, sf_dir):
    return _c(spark, sf_dir).select("chan_row_id", F.array_join(names.compound_candidates(F.col("channel_id")), "|").alias("candidates")).filter("candidates != ''")


_EXP = (("^AURORA ", "AURORA NACIONAL"), ("^BRISA ", "BRISA NACIONAL"), ("^CASCATA ", "CASCATA NACIONAL"))


@query(_tiers_sql() + f", ex AS (SELECT d.key, a AS alias FROM channel_dictionary d JOIN (VALUES {', '.join(f'({lit(t)}, {lit(a)})' for t, a in _EXP)}) v(t, a) ON regexp_matches(upper(d.name), t)) "
       "SELECT key, tier::INT AS tier, count(*) AS n_aliases FROM ti GROUP BY ALL UNION ALL SELECT key, 3, count(DISTINCT alias) FROM ex GROUP BY key")
def tier_expansion(spark, sf_dir):
    x = spark.createDataFrame(list(_EXP), "trigger string, alias string")
    return match.tiers(_d(spark, sf_dir), x).groupBy("key", "tier").agg(F.count("*").alias("n_aliases"))


_VETO = " OR ".join(f"contains(a, {lit(w)}) != contains(b, {lit(w)})" for w in match.TELLING_WORDS)


@query(f"""{_tiers_sql()}, {_PC}, aa AS (SELECT DISTINCT key, norm AS a, array_to_string(regexp_extract_all(norm, '\\d+'), ',') AS dg FROM ti WHERE length(norm) >= {match.FUZZY_LENGTH}),
bb AS (SELECT DISTINCT source, channel_id, b, array_to_string(regexp_extract_all(b, '\\d+'), ',') AS dg FROM (SELECT source, channel_id, {nn('display_names[1]')} AS b FROM pc) WHERE b != ''),
pr AS (SELECT *, 2.0::DOUBLE * ({_COMMON} + {_REST}) / (length(a) + length(b)) AS lb FROM aa JOIN bb USING (dg) WHERE 2.0::DOUBLE * least(length(a), length(b)) / (length(a) + length(b)) >= {match.FUZZY_BOUND})
SELECT key, count(*) AS n_pairs, count(*) FILTER (a != b AND (({_VETO}) OR replace(a, 'BRASILIA', 'BRASIL') = replace(b, 'BRASILIA', 'BRASIL') OR (substr(a, 1, 4) != substr(b, 1, 4) AND lb < 0.8))) AS n_vetoed FROM pr WHERE lb >= {match.FUZZY_BOUND} GROUP BY key""")
def fuzzy_veto(spark, sf_dir):
    p = match.fuzzy_pairs(match.tiers(_d(spark, sf_dir)), _pc(spark, sf_dir))
    return p.groupBy("key").agg(F.count("*").alias("n_pairs"), F.count_if(match.veto(F.col("a"), F.col("b"))).alias("n_vetoed"))


ORACLE |= {name: sql() for name, sql in LATER}
