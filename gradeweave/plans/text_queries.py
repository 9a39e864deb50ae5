"""Names, identifiers, titles and times: queries over channels, playlists and programmes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, names, titles
from ..runtime import load
from .sqlgen import lit, rewrite

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def _names(spark, sf_dir):
    return load(spark, sf_dir, "source_channels").select("chan_row_id", F.posexplode("display_names").alias("pos", "name"))


_NAMES = "WITH n AS (SELECT chan_row_id, unnest(display_names) AS name, generate_subscripts(display_names, 1) - 1 AS pos FROM source_channels)"


@query(f"{_NAMES} SELECT chan_row_id, pos::INT AS pos, {rewrite('name', names.NAME_KEY)} AS name_key, {rewrite('name', names.NAME_KEY_SIMPLE)} AS simple_key FROM n")
def name_key(spark, sf_dir):
    return _names(spark, sf_dir).select("chan_row_id", "pos", names.name_key(F.col("name")).alias("name_key"), names.name_key_simple(F.col("name")).alias("simple_key"))


@query(f"{_NAMES} SELECT chan_row_id, pos::INT AS pos, {rewrite('name', names.QUALITY_STRIP)} AS clean_name, {rewrite('name', names.NORM_NAME)} AS norm_name, "
       f"array_to_string(regexp_extract_all({rewrite('name', names.NORM_NAME)}, '\\d+'), ',') AS digits FROM n")
def quality_strip(spark, sf_dir):
    n = F.col("name")
    return _names(spark, sf_dir).select("chan_row_id", "pos", names.strip_quality(n).alias("clean_name"), names.norm_name(n).alias("norm_name"), names.digits(names.norm_name(n)).alias("digits"))


@query(f"SELECT chan_row_id, {rewrite('channel_id', names.SOURCE_ID)} AS source_key, {rewrite('channel_id', names.ID_KEY)} AS id_key FROM source_channels")
def source_id_norm(spark, sf_dir):
    c = F.col("channel_id")
    return load(spark, sf_dir, "source_channels").select("chan_row_id", names.source_id(c).alias("source_key"), names.id_key(c).alias("id_key"))


_SAFE = "NOT regexp_matches(trim({0}), '[\\s&!+\"''<>;]') AND trim({0}) != '' AND strip_accents({0}) = {0}"
_MADE = rewrite("name", names.SAFE_ID)


@query(f"{_NAMES} SELECT chan_row_id, pos::INT AS pos, ({_SAFE.format('name')}) AS is_safe, CASE WHEN {_SAFE.format('name')} THEN trim(name) WHEN suffix({_MADE}, '.br') THEN {_MADE} ELSE lower({_MADE}) END AS safe_id FROM n")
def id_sanitize(spark, sf_dir):
    n = F.col("name")
    return _names(spark, sf_dir).select("chan_row_id", "pos", names.is_safe_id(n).alias("is_safe"), names.safe_id(n).alias("safe_id"))


_COUNTRY_TEXT = rewrite("display_name", ("unescape", "upper", (r"^[^A-Z0-9]+", "")))
_CODE = f"regexp_extract({_COUNTRY_TEXT}, '^({'|'.join(sorted(names.COUNTRIES, key=len, reverse=True))})\\b', 1)"
_STATES = f"list_sort(list_intersect(list_distinct(string_split({rewrite('display_name', names.NAME_KEY)}, ' ')), [{', '.join(lit(u) for u in names.UFS)}]))"


@query(f"SELECT entry_id, CASE WHEN regexp_matches({_COUNTRY_TEXT}, '^USA (?:NETWORK|HD|FHD|SD|UHD|4K)\\b') THEN '' WHEN {_CODE} = 'USA' THEN 'US' WHEN {_CODE} = 'AR' THEN 'ARG' ELSE {_CODE} END AS country, "
       f"array_to_string({_STATES}, ',') AS states FROM playlist_entries WHERE display_name IS NOT NULL")
def country_region_class(spark, sf_dir):
    n = F.col("display_name")
    return load(spark, sf_dir, "playlist_entries").filter(n.isNotNull()).select("entry_id", names.country(n).alias("country"), F.array_join(names.states(n), ",").alias("states"))


_NUM = rewrite("display_name", ("unescape", "upper", (r"\b(?:H\.?264|H\.?265|1080[PI]?|720P?|60FPS|4K|8K|24HS?|24/7|BR\d+|SRV\d+|SERVER\s*\d+|OP\d+|1X)\b", " "), (r"[¹²³⁴⁵⁶⁷⁸⁹⁰]+", " ")))


@query(f"SELECT entry_id, array_to_string(list_transform(regexp_extract_all({_NUM}, '\\d+'), lambda d: regexp_replace(d, '^0+(\\d)', '\\1')), ',') AS numbers FROM playlist_entries WHERE display_name IS NOT NULL")
def channel_numbers(spark, sf_dir):
    return load(spark, sf_dir, "playlist_entries").filter("display_name IS NOT NULL").select("entry_id", names.significant_numbers(F.col("display_name")).alias("numbers"))


_WORDS = f"list_filter(list_distinct(string_split({rewrite('display_name', names.NAME_KEY)}, ' ')), lambda w: w NOT IN ({', '.join(lit(w) for w in (*names.STOP_WORDS, ''))}))"
_CAMEL = rewrite("display_name", ("unescape", "unaccent"))


@query(f"SELECT entry_id, array_to_string(list_sort({_WORDS}), ' ') AS tokens, "
       f"array_to_string(list_transform(regexp_extract_all({_CAMEL}, '[A-Za-z0-9]+'), lambda w: upper(w[1]) || lower(w[2:])), '') || '.br' AS camel_id, "
       f"'auto.' || lower(CASE WHEN {rewrite('display_name', names.NORM_NAME)} = '' THEN 'canal' ELSE {rewrite('display_name', names.NORM_NAME)} END) AS auto_id FROM playlist_entries WHERE display_name IS NOT NULL")
def generated_ids(spark, sf_dir):
    n = F.col("display_name")
    return load(spark, sf_dir, "playlist_entries").filter(n.isNotNull()).select("entry_id", names.token_set(names.name_key(n)).alias("tokens"), names.camel_id(n).alias("camel_id"), names.automatic_id(n).alias("auto_id"))


_T = "coalesce(title, '')"


@query(f"SELECT row_id, {rewrite(_T, titles.TITLE_NORM)} AS norm_title FROM programmes")
def title_norm(spark, sf_dir):
    return load(spark, sf_dir, "programmes", ["row_id", "title"]).select("row_id", titles.normalise(F.col("title")).alias("norm_title"))


_ONE = """CASE WHEN l = '' OR r = '' THEN trim(title) WHEN contains(upper(l), upper(r)) THEN l WHEN contains(upper(r), upper(l)) THEN r ELSE trim(title) END"""
_FAKE = r"'(?i)(?:\s*[\-|:]\s*|\s+)[\[(]?EP?\.?\s*0*1[\])]?\s*$'"


@query(f"WITH t AS (SELECT row_id, title, trim(regexp_extract(trim(title), '^(.*?) : (.*)$', 1)) AS l, trim(regexp_extract(trim(title), '^(.*?) : (.*)$', 2)) AS r FROM programmes WHERE title IS NOT NULL) "
       f"SELECT row_id, trim(regexp_replace({_ONE}, {_FAKE}, '', 'g')) AS clean_title, {rewrite('title', titles.STRIP_SE)} AS bare_title FROM t")
def title_clean(spark, sf_dir):
    return load(spark, sf_dir, "programmes", ["row_id", "title"]).filter("title IS NOT NULL").select(
        "row_id", titles.clean(F.col("title")).alias("clean_title"), titles.strip_season_episode(F.col("title")).alias("bare_title"))


def _se_sql() -> str:
    """Words and numbers told apart by position, not by the pattern of the column function."""
    w = "string_split(trim(regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(regexp_replace(title, '[ªº]', ' ORD '))), '([A-Z])([0-9])', '\\1 \\2', 'g'), '([0-9])([A-Z])', '\\1 \\2', 'g'), '[^A-Z0-9]+', ' ', 'g')), ' ')"
    s, e = "('S', 'T', 'TEMP', 'TEMPORADA')", "('E', 'EP', 'EPIS', 'EPISODIO')"
    n = lambda i: f"(length(w[{i}]) > 0 AND w[{i}] = regexp_extract(w[{i}], '[0-9]+'))"
    return f"""SELECT row_id, CASE WHEN ok THEN se END AS season, CASE WHEN ok THEN ep WHEN one BETWEEN 1 AND 1500 THEN one END AS episode FROM (
 SELECT row_id, se, ep, one, coalesce(se BETWEEN 1 AND 60 AND ep BETWEEN 1 AND 999, false) AS ok FROM (SELECT row_id, w,
  list_filter(range(1, len(w) + 1), lambda i: w[i] IN {s} AND {n('i + 1')} AND length(w[i + 1]) <= 2 AND w[i + 2] IN {e} AND {n('i + 3')} AND length(w[i + 3]) <= 4)[1] AS a,
  list_filter(range(1, len(w) + 1), lambda i: {n('i')} AND length(w[i]) <= 2 AND w[i + 1] = 'ORD' AND w[i + 2] IN {s} AND w[i + 3] IN {e} AND {n('i + 4')} AND length(w[i + 4]) <= 4)[1] AS b,
  list_filter(range(1, len(w) + 1), lambda i: w[i] IN ('EP', 'EPIS', 'EPISODIO') AND {n('i + 1')} AND length(w[i + 1]) <= 4)[1] AS c,
  CASE WHEN a IS NOT NULL THEN w[a + 1]::INT WHEN b IS NOT NULL THEN w[b]::INT END AS se, CASE WHEN a IS NOT NULL THEN w[a + 3]::INT WHEN b IS NOT NULL THEN w[b + 4]::INT END AS ep, w[c + 1]::INT AS one
  FROM (SELECT row_id, {w} AS w FROM programmes WHERE title IS NOT NULL)))"""


@query(f"SELECT row_id, coalesce(season, 0) AS season, episode FROM ({_se_sql()}) WHERE episode IS NOT NULL")
def season_episode(spark, sf_dir):
    r = load(spark, sf_dir, "programmes", ["row_id", "title"]).filter("title IS NOT NULL").select("row_id", titles.season_episode(F.col("title")).alias("se"))
    return r.select("row_id", F.coalesce("se.season", F.lit(0)).alias("season"), F.col("se.episode").alias("episode")).filter("episode IS NOT NULL")


_R = "upper(trim(coalesce(rating_badge, '')))"
_AGE = f"regexp_extract({_R}, '(?:^|[^0-9A-Z_])(10|12|14|16|18)\\b', 1)"


@query(f"SELECT row_id, CASE WHEN contains({_R}, 'LIVRE') THEN 'L' WHEN {_AGE} != '' THEN {_AGE} {' '.join(f'WHEN {_R} = {lit(k)} THEN {lit(v)}' for k, v in titles.RATINGS.items())} ELSE '' END AS rating FROM candidate_rows")
def rating_badge(spark, sf_dir):
    return load(spark, sf_dir, "candidate_rows").select("row_id", titles.rating(F.col("rating_badge")).alias("rating"))


_N = rewrite(_T, titles.TITLE_NORM)


@query(f"WITH t AS (SELECT row_id, {_N} AS n FROM programmes) SELECT row_id FROM t WHERE length(n) >= 2 AND n NOT IN ({', '.join(map(lit, titles.PLACEHOLDERS))}) AND NOT ({' OR '.join(f'contains(n, {lit(p)})' for p in titles.PLACEHOLDER_PARTS)})")
def placeholder_filter(spark, sf_dir):
    return load(spark, sf_dir, "programmes", ["row_id", "title"]).filter(titles.is_programme(titles.normalise(F.col("title")))).select("row_id")


_RICH = """least(1.0, (CASE WHEN length(coalesce(meta.desc, '')) >= 30 THEN 0.45 ELSE 0.0 END)::DOUBLE + (CASE WHEN coalesce(meta.sub_title, '') != '' THEN 0.20 ELSE 0.0 END)::DOUBLE
 + (CASE WHEN meta.season IS NOT NULL OR meta.episode IS NOT NULL THEN 0.15 ELSE 0.0 END)::DOUBLE + (CASE WHEN coalesce(meta.rating_badge, '') != '' OR len(coalesce(meta.categories, [])) > 0 THEN 0.20 ELSE 0.0 END)::DOUBLE)"""


def rich_column():
    m = lambda f: F.col(f"meta.{f}")
    return titles.richness(m("desc"), m("sub_title"), m("season"), m("episode"), m("rating_badge"), m("categories"))


@query(f"SELECT source, channel_id, count(*) AS n_rows, round(avg({_RICH}), 4) AS mean_richness FROM programmes GROUP BY ALL")
def richness_score(spark, sf_dir):
    return load(spark, sf_dir, "programmes").groupBy("source", "channel_id").agg(F.count("*").alias("n_rows"), F.round(F.avg(rich_column()), 4).alias("mean_richness"))


_MIN = "epoch(stop)::BIGINT - epoch(start)::BIGINT"
_CATS = "upper(array_to_string(coalesce(meta.categories, []), ' | '))"
_DESC = "upper(coalesce(meta.desc, ''))"
_any = lambda t, words: "(" + " OR ".join(f"contains({t}, {lit(w)})" for w in words) + ")"


@query(f"SELECT row_id, CASE WHEN {_any(_CATS, titles.SERIES_WORDS)} THEN false WHEN {_any(_CATS, titles.MOVIE_OR_SPORT_WORDS)} THEN true ELSE ({_MIN}) >= 5100 AND NOT {_any(_DESC, ('TEMPORADA', 'EPISÓDIO', 'EPISODIO', 'SÉRIE', 'SERIE', 'CAPÍTULO', 'CAPITULO'))} END AS movie_or_sport "
       "FROM programmes WHERE stop IS NOT NULL AND start IS NOT NULL")
def movie_or_sport(spark, sf_dir):
    minutes = (F.unix_seconds("stop") - F.unix_seconds("start")) / 60
    return load(spark, sf_dir, "programmes").filter("stop IS NOT NULL AND start IS NOT NULL").select(
        "row_id", titles.movie_or_sport(F.col("meta.categories"), F.col("meta.desc"), minutes).alias("movie_or_sport"))


@query(f"""SELECT row_id, concat_ws(' | ', nullif(meta.rating_badge, ''), nullif(meta.date, ''), CAST(({_MIN}) // 60 AS VARCHAR) || ' min', nullif(array_to_string(coalesce(meta.categories, [])[1:4], ' / '), ''),
 CASE WHEN meta.season IS NOT NULL AND meta.episode IS NOT NULL THEN 'T' || lpad(CAST(meta.season AS VARCHAR), 2, '0') || 'E' || lpad(CAST(meta.episode AS VARCHAR), 2, '0') END, nullif(meta.desc, '')) AS description
 FROM programmes WHERE stop > start""")
def rich_description(spark, sf_dir):
    m = lambda f: F.col(f"meta.{f}")
    minutes = F.expr("(unix_seconds(stop) - unix_seconds(start)) div 60")
    return load(spark, sf_dir, "programmes").filter("stop > start").select(
        "row_id", titles.description(m("rating_badge"), m("date"), minutes, m("categories"), m("season"), m("episode"), m("desc")).alias("description"))


_U = "upper(trim(coalesce(display_name, '')))"


@query(f"""SELECT entry_id FROM playlist_entries WHERE {_U} = '' OR regexp_matches({_U}, '⭐{{2,}}|^[\\s⭐\\-—=_.*]+$') OR regexp_matches({_U}, '^(?:24\\s*H|\\d{{4}}[A-Z])')
 OR regexp_matches({_U}, '\\bS\\d{{1,3}}\\s*E\\d{{1,3}}\\b|\\bT\\d{{1,3}}\\s*EP?\\d{{1,3}}\\b|24HS?\\b') OR regexp_matches({_U}, '^(?:PROGRAMA\\s+|LIVE\\s+|FILMES\\s+)')
 OR (regexp_matches({_U}, '^CINE\\s+') AND NOT regexp_matches({_U}, '^CINE\\s+(?:CANAL|BRASIL)'))""")
def junk_filter(spark, sf_dir):
    return load(spark, sf_dir, "playlist_entries").filter(titles.is_junk_channel(F.col("display_name"))).select("entry_id")


_G = "upper(trim(coalesce(group_title, '')))"
_EXC = "(" + " OR ".join(f"contains({_G}, {lit(x)})" for x in titles.LIVE_EXCEPTIONS) + ")"


@query(f"""WITH e AS (SELECT *, count(*) OVER (PARTITION BY playlist, group_title) AS n, {rewrite('display_name', names.NORM_NAME)} IN (SELECT {rewrite('name', names.NORM_NAME)} FROM channel_dictionary) AS known FROM playlist_entries WHERE display_name IS NOT NULL)
SELECT entry_id FROM e WHERE CASE WHEN known THEN true WHEN regexp_matches(display_name, '(?i)\\(\\s*(?:19|20)\\d{{2}}\\s*\\)\\s*(?:LEG)?\\s*$') THEN false
 WHEN regexp_matches({_G}, {lit(titles.VOD_WORDS)}) AND NOT {_EXC} AND NOT regexp_matches({_G}, 'CANAIS|PPV') THEN false WHEN n > 400 AND NOT regexp_matches({_G}, 'CANAIS|ABERTOS|PPV|ESPORTES') THEN false
 WHEN regexp_matches({_G}, {lit(titles.LIVE_WORDS)}) OR {_EXC} THEN true ELSE coalesce(tvg_id, '') != '' END""")
def vod_candidate_filter(spark, sf_dir):
    e = load(spark, sf_dir, "playlist_entries").filter("display_name IS NOT NULL")
    sizes = e.groupBy("playlist", "group_title").agg(F.count("*").alias("n")).select(F.col("playlist").alias("p"), F.col("group_title").alias("g"), "n")
    known = load(spark, sf_dir, "channel_dictionary").select(names.norm_name(F.col("name")).alias("k")).distinct().withColumn("known", F.lit(True))
    j = e.join(sizes, F.col("playlist").eqNullSafe(F.col("p")) & F.col("group_title").eqNullSafe(F.col("g"))).withColumn("k", names.norm_name(F.col("display_name"))).join(known, "k", "left")
    return j.filter(titles.is_live_entry(F.col("display_name"), F.col("group_title"), F.col("tvg_id"), F.col("n"), F.coalesce("known", F.lit(False)))).select("entry_id")


_KEY = rewrite("display_name", names.NAME_KEY)


@query(f"SELECT CASE {' '.join(f'WHEN regexp_matches({_KEY}, {lit(w)}) THEN {lit(g)}' for g, w in titles.GROUP_RULES)} ELSE 'VARIEDADES' END AS inferred_group, count(*) AS n_entries FROM playlist_entries WHERE display_name IS NOT NULL GROUP BY 1")
def group_inference(spark, sf_dir):
    e = load(spark, sf_dir, "playlist_entries").filter("display_name IS NOT NULL")
    return e.groupBy(titles.group_of(names.name_key(F.col("display_name")), F.lit(None).cast("string")).alias("inferred_group")).agg(F.count("*").alias("n_entries"))


@query("""WITH p AS (SELECT raw_id, regexp_extract(_start, '^\\s*(\\d{12})(\\d{2})?(?:\\s*([+-]\\d{4}))?(?:\\s+.*)?$', ['d', 's', 'o']) AS m FROM xmltv_programme),
t AS (SELECT raw_id, m.o AS o, try_strptime(m.d || CASE WHEN m.s = '' THEN '00' ELSE m.s END, '%Y%m%d%H%M%S') AS t FROM p WHERE m.d != ''),
i AS (SELECT raw_id, t - CASE WHEN o = '' THEN INTERVAL 0 MINUTE ELSE to_minutes((CASE WHEN o[1] = '-' THEN -1 ELSE 1 END) * (CAST(o[2:3] AS INT) * 60 + CAST(o[4:5] AS INT))) END AS utc FROM t WHERE t IS NOT NULL)
SELECT raw_id, epoch(utc)::BIGINT AS utc_s, strftime(utc - INTERVAL 3 HOUR, '%Y%m%d%H%M%S') || ' -0300' AS written FROM i""")
def xmltv_time_roundtrip(spark, sf_dir):
    r = load(spark, sf_dir, "xmltv_programme").withColumn("t", clock.parse_compact(F.col("_start"))).filter("t IS NOT NULL")
    return r.select("raw_id", F.unix_seconds("t").alias("utc_s"), clock.format_compact(F.col("t")).alias("written"))
