"""Audits, reading and writing of feeds, streams: queries over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sinks, streaming
from ..functions import clock, names
from ..operators import audit, schedule
from ..runtime import ensure_checkpoint_dir, load, materialise
from ..sources import feeds, xmltv
from .catalog_queries import nn
from .schedule_queries import GOOD, NOW, ROWS, _LEAD, _OK, base
from .sqlgen import lit, rewrite

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_AUDIT = f"""{ROWS}, n AS (SELECT *, {_LEAD} - e AS d FROM r), au AS (SELECT source, channel_id, count(*) AS n_rows, max((s <= {NOW} AND e > {NOW})::INT) AS has_now, max((s > {NOW})::INT) AS has_next,
 round(coalesce(max(e) FILTER (e > {NOW}) - {NOW}, 0) / 3600.0::DOUBLE, 1) AS future_hours, count(*) FILTER (NOT ({_OK})) AS placeholders, count(*) FILTER (d > 120) AS gap_count, coalesce(max(d // 60) FILTER (d > 120), 0) AS longest_gap_min,
 count(*) FILTER (d < -120) AS overlap_count FROM n GROUP BY ALL)"""


@query(f"{_AUDIT} SELECT *, future_hours < 12 AS short FROM au")
def audit_channels(spark, sf_dir):
    return audit.summary(base(spark, sf_dir, False))


@query(f"{_AUDIT} SELECT count(*) AS channels, count(*) FILTER (has_now = 0) AS nothing_on, count(*) FILTER (gap_count > 0) AS with_gaps, count(*) FILTER (overlap_count > 0) AS with_overlaps, count(*) FILTER (future_hours < 12) AS short, sum(placeholders)::BIGINT AS placeholders FROM au")
def audit_summary(spark, sf_dir):
    return audit.totals(audit.summary(base(spark, sf_dir, False)))


def _reason(n: str) -> str:
    rules = " ".join(("WHEN false THEN 'source_failed' " if r == "regional" else "") + f"WHEN regexp_matches({n}, {lit(p)}) THEN {lit(r)}" for r, p in audit.MISSING_RULES)
    return f"CASE WHEN coalesce({n}, '') = '' THEN 'unnamed' {rules} ELSE 'no_content' END"


@query(f"SELECT {_reason('display_name')} AS reason, count(*) AS n_entries FROM playlist_entries GROUP BY 1")
def missing_reasons(spark, sf_dir):
    return load(spark, sf_dir, "playlist_entries").groupBy(audit.missing_reason(F.col("display_name"), F.lit(0)).alias("reason")).agg(F.count("*").alias("n_entries"))


@query(f"""WITH v AS (SELECT key AS target, unnest(list_prepend(name, aliases)) AS name FROM channel_dictionary), x AS (SELECT lower(name) AS x, min(target) AS t1 FROM v GROUP BY 1),
y AS (SELECT {rewrite('name', names.PLAIN_KEY)} AS y, min(target) AS t2 FROM v GROUP BY 1), p AS (SELECT playlist, line_no::VARCHAR AS channel_id, display_name AS n FROM playlist_entries WHERE display_name IS NOT NULL)
SELECT playlist AS source, channel_id, coalesce(min(t1), min(t2)) AS target FROM p LEFT JOIN x ON x.x = lower(n) LEFT JOIN y ON y.y = {rewrite('n', names.PLAIN_KEY)} AND y.y != '' GROUP BY ALL HAVING coalesce(min(t1), min(t2)) IS NOT NULL""")
def validation_lookup(spark, sf_dir):
    d = load(spark, sf_dir, "channel_dictionary").select(F.col("key").alias("target"), F.explode(F.concat(F.array("name"), "aliases")).alias("name"))
    c = load(spark, sf_dir, "playlist_entries").filter("display_name IS NOT NULL").select(F.col("playlist").alias("source"), F.col("line_no").cast("string").alias("channel_id"), F.array("display_name").alias("display_names"))
    return audit.validation_lookup(c, d)


@query("SELECT row_id, coalesce(meta.season, 0) AS season, coalesce(meta.rating_badge, '') AS badge, len(coalesce(meta.categories, [])) AS n_categories, coalesce(meta.categories[1], '') AS first_category FROM programmes")
def json_props(spark, sf_dir):
    """Metadata written as JSON and navigated with defaults."""
    j = load(spark, sf_dir, "programmes", ["row_id", "meta"]).select("row_id", F.to_json("meta").alias("j"))
    get = lambda p, d: F.coalesce(F.get_json_object("j", p), F.lit(d))
    return j.select("row_id", get("$.season", "0").cast("int").alias("season"), get("$.rating_badge", "").alias("badge"),
                    F.coalesce(F.json_array_length(F.get_json_object("j", "$.categories")), F.lit(0)).cast("bigint").alias("n_categories"), get("$.categories[0]", "").alias("first_category"))


@query("SELECT source, channel_id, epoch(start)::BIGINT AS s, epoch(stop)::BIGINT AS e, count(*) AS n FROM programmes WHERE source IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL AND title IS NOT NULL AND channel_id IS NOT NULL GROUP BY ALL")
def json_records(spark, sf_dir):
    """Rows of all feeds written as JSON records and read back."""
    p = load(spark, sf_dir, "programmes").filter("source IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL AND title IS NOT NULL AND channel_id IS NOT NULL")
    docs = p.select("source", F.to_json(F.struct(F.col("channel_id").alias("id_canal"), "title", F.unix_millis("start").alias("startTime"), F.unix_seconds("stop").cast("string").alias("endTime"))).alias("json"))
    r = feeds.schedule_records(docs, F.col("source"))
    return r.groupBy("source", "channel_id", F.unix_seconds("start").alias("s"), F.unix_seconds("stop").alias("e")).agg(F.count("*").alias("n"))


_HTML = "title IS NOT NULL AND trim(regexp_replace(title, '[\\s\\p{Z}]+', ' ', 'g')) != '' AND start IS NOT NULL AND channel_id IS NOT NULL AND source IS NOT NULL"


@query(f"""WITH o AS (SELECT source, channel_id, epoch(start)::BIGINT AS s, min(trim(title)) AS title FROM programmes WHERE {_HTML} GROUP BY ALL), n AS (SELECT *, lead(s) OVER (PARTITION BY source, channel_id ORDER BY s) AS nxt FROM o)
SELECT source, channel_id, s, least(s + 2700, coalesce(nxt, s + 2700)) AS e, title FROM n""")
def html_extract(spark, sf_dir):
    """Rows of all feeds written as a guide's pages and read back, with stops from a duration of 45 minutes cut at the next start."""
    p = load(spark, sf_dir, "programmes").filter(F.expr("title IS NOT NULL AND start IS NOT NULL AND channel_id IS NOT NULL AND source IS NOT NULL") & (F.regexp_replace("title", r"[\s\p{Z}]", "") != ""))
    iso = F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.col("title")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    pages = p.select("source", "channel_id", F.concat(F.lit('<ul><li><time datetime="'), iso, F.lit('">x</time><h3><b>'), text, F.lit('</b></h3><span class="duration">45 min</span></li></ul>')).alias("html"))
    r = feeds.timed_items(pages, F.col("source"))
    return r.select("source", "channel_id", F.unix_seconds("start").alias("s"), F.unix_seconds("stop").alias("e"), "title")


_X = """WITH p AS (SELECT channel_id, epoch(start)::BIGINT AS s, epoch(stop)::BIGINT AS e, coalesce(len(meta.categories), 0) AS c FROM programmes WHERE stop > start AND title IS NOT NULL AND trim(title) != '' AND channel_id IS NOT NULL)"""


@query(f"{_X} SELECT channel_id, s, e, count(*) AS n FROM p GROUP BY ALL")
def xmltv_roundtrip(spark, sf_dir):
    """Programmes written as XMLTV elements and parsed again."""
    p = load(spark, sf_dir, "programmes").filter(F.expr("stop > start AND title IS NOT NULL AND channel_id IS NOT NULL") & (F.regexp_replace("title", r"[\s\p{Z}]", "") != ""))
    none = p.limit(0).select("channel_id", F.array(F.lit("")).alias("display_names"))
    lines = sinks.xmltv_lines(none, p.select("channel_id", "start", "stop", "title", F.col("meta.desc").alias("description"), F.col("meta.categories").alias("categories")))
    r = xmltv.from_text(lines.filter("part = 2").select(F.col("line").alias("xml")), "roundtrip")
    return r.groupBy("channel_id", F.unix_seconds("start").alias("s"), F.unix_seconds("stop").alias("e")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_lines, count(*) FILTER (part = 1) AS n_channels FROM (SELECT 1 AS part FROM source_channels WHERE channel_id IS NOT NULL GROUP BY channel_id UNION ALL SELECT 2 FROM programmes WHERE stop > start AND channel_id IS NOT NULL UNION ALL SELECT 0 UNION ALL SELECT 3)")
def xmltv_document(spark, sf_dir):
    c = load(spark, sf_dir, "source_channels").filter("channel_id IS NOT NULL").groupBy("channel_id").agg(F.min("display_names").alias("display_names"))
    p = load(spark, sf_dir, "programmes").filter("stop > start AND channel_id IS NOT NULL").select("channel_id", "start", "stop", "title", F.col("meta.desc").alias("description"), F.col("meta.categories").alias("categories"))
    return sinks.xmltv_lines(c, p).agg(F.count("line").alias("n_lines"), F.count_if(F.col("part") == 1).alias("n_channels"))


@query("""WITH m AS (SELECT source, channel_id FROM programmes WHERE source = 'guiaserra' GROUP BY ALL HAVING count(*) >= 5) SELECT row_id FROM programmes WHERE source = 'guiaserra' UNION ALL
SELECT row_id FROM programmes WHERE source != 'guiaserra' AND channel_id NOT IN (SELECT channel_id FROM m)""")
def fallback_anti_join(spark, sf_dir):
    p = load(spark, sf_dir, "programmes", ["row_id", "source", "channel_id"]).filter("channel_id IS NOT NULL")
    return feeds.only_missing(p.filter("source = 'guiaserra'"), p.filter("source != 'guiaserra'"), "channel_id").select("row_id")


@query(f"SELECT d.key FROM channel_dictionary d SEMI JOIN (SELECT {nn('display_name')} AS n FROM playlist_entries) p ON p.n = {nn('d.name')}")
def semi_selected(spark, sf_dir):
    e = load(spark, sf_dir, "playlist_entries").select(names.norm_name(F.col("display_name")).alias("n"))
    return load(spark, sf_dir, "channel_dictionary").withColumn("n", names.norm_name(F.col("name"))).join(e, "n", "left_semi").select("key")


@query("""WITH w AS (SELECT source, epoch(loaded_at)::BIGINT // 21600 * 21600 AS window_s, count(*) AS n_rows FROM programmes WHERE loaded_at IS NOT NULL GROUP BY ALL),
m AS (SELECT epoch(max(loaded_at))::BIGINT - 172800 AS mark FROM programmes) SELECT source, window_s, n_rows FROM w, m WHERE window_s + 21600 <= mark""")
def stream_window_counts(spark, sf_dir):
    """Counts per window of loading, from a stream of the table's files; only windows that the watermark has closed."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    batch = load(spark, sf_dir, "programmes", ["source", "channel_id", "loaded_at"])
    # the files of one table are one trigger: order of files then plays no part
    stream = spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/programmes.parquet" if _is_folder(spark, f"{sf_dir}/programmes.parquet") else f"{sf_dir}/programmes*.parquet")
    streaming.run_to_parquet(streaming.window_counts(stream).drop("n_channels"), f"{folder}/out", f"{folder}/state")
    return spark.read.schema("source string, window_s bigint, n_rows bigint").parquet(f"{folder}/out")


def _is_folder(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("SELECT raw_id, CASE WHEN regexp_matches(_start, 'Z$') THEN epoch(CAST(regexp_replace(_start, 'Z$', '-03:00') AS TIMESTAMPTZ))::BIGINT END AS relabelled_s FROM xmltv_programme WHERE regexp_matches(_start, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(?:\\.\\d+)?Z$')")
def wrong_zone_label(spark, sf_dir):
    r = load(spark, sf_dir, "xmltv_programme").filter(F.col("_start").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"))
    return r.select("raw_id", F.unix_seconds(clock.epoch_or_iso(clock.relabelled(F.col("_start")))).alias("relabelled_s"))


@query("SELECT row_id, (epoch(stop)::BIGINT - epoch(start)::BIGINT) // 60 * 60 AS seconds FROM programmes WHERE stop > start AND epoch(stop) - epoch(start) < 36000")
def duration_text(spark, sf_dir):
    p = load(spark, sf_dir, "programmes", ["row_id", "start", "stop"]).withColumn("d", F.unix_seconds("stop") - F.unix_seconds("start")).filter("d > 0 AND d < 36000")
    text = F.when(F.col("d") < 3600, F.format_string("%d min", F.expr("d div 60"))).otherwise(F.format_string("%dh %02dmin", F.expr("d div 3600"), F.expr("(d % 3600) div 60")))
    return p.select("row_id", clock.duration_seconds(text).cast("bigint").alias("seconds"))
