"""JSON records and HTML pages of operators and guides to the programme model: source, channel_id, start, stop, title, ...

All parsers take a DataFrame of raw documents, so fetching stays outside; each declares the shape it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock, rules, titles
from ..operators import series

#: Names of months in Portuguese.
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")
#: Genres in English and what they become.
GENRES = {"movie": "Filme", "series": "Série", "news": "Notícias", "sports": "Esporte", "kids": "Infantil", "documentary": "Documentário", "music": "Música", "comedy": "Comédia", "drama": "Drama", "other": "Outros"}


def field(json: Column, *paths: str) -> Column:
    """The first of several paths that is there; feeds name their fields differently."""
    return F.coalesce(*(F.get_json_object(json, p) for p in paths))


def _named(source: str | Column) -> Column:
    """The source's name: the same for all rows, or a column of theirs."""
    return (source if isinstance(source, Column) else F.lit(source)).alias("source")


def schedule_records(docs: DataFrame, source: str | Column, lineup: DataFrame | None = None, wrong_zone: str | None = None) -> DataFrame:
    """Flat JSON records (column ``json``): id_canal, titulo, dh_inicio, dh_fim and their English names.

    ``lineup`` (id, name) gives channels their names; ``wrong_zone`` is what a 'Z' in times really stands for.
    """
    j = F.col("json")
    time = lambda *p: clock.epoch_or_iso(clock.relabelled(field(j, *p), wrong_zone) if wrong_zone else field(j, *p))
    r = docs.select(
        _named(source), field(j, "$.id_canal", "$.channelId", "$.channel.id").alias("channel_id"), time("$.dh_inicio", "$.start", "$.startTime", "$.StartTime").alias("start"),
        time("$.dh_fim", "$.stop", "$.endTime", "$.EndTime").alias("stop"), field(j, "$.titulo", "$.title", "$.Title").alias("title"),
        field(j, "$.descricao", "$.description", "$.Description").alias("desc"), field(j, "$.genero", "$.genre").alias("genre"), titles.rating(field(j, "$.classificacao", "$.rating", "$.AgeRating")).alias("rating_badge"),
    ).filter("start IS NOT NULL AND title IS NOT NULL")
    if lineup is not None:
        r = r.join(lineup.select(F.col("id").alias("channel_id"), F.col("name").alias("channel_name")), "channel_id", "left")
    return r


def nested_broadcasts(docs: DataFrame, source: str) -> DataFrame:
    """{"data": {"broadcasts": [{"channel": {"id"}, "epgByDate": {"entries": [{"startTime", "endTime", "title", ...}]}}]}} in column ``json``."""
    entry = "struct<title:string,description:string,startTime:bigint,endTime:bigint,contentRating:string>"
    shape = f"data struct<broadcasts:array<struct<channel:struct<id:string,name:string>,epgByDate:struct<entries:array<{entry}>>>>>"
    b = docs.select(F.explode(F.from_json("json", shape)["data"]["broadcasts"]).alias("b"))
    e = b.select(F.col("b.channel.id").alias("channel_id"), F.explode("b.epgByDate.entries").alias("e"))
    return e.select(F.lit(source).alias("source"), "channel_id", F.timestamp_seconds("e.startTime").alias("start"), F.timestamp_seconds("e.endTime").alias("stop"),
                    F.col("e.title").alias("title"), F.col("e.description").alias("desc"), titles.rating(F.col("e.contentRating")).alias("rating_badge"))


def embedded_json(pages: DataFrame, source: str) -> DataFrame:
    """JSON objects that begin with {"contentType": in a page (columns channel_id, html); of equal starts the one with a description counts."""
    found = pages.select("channel_id", F.explode(F.regexp_extract_all("html", F.lit(r'(\{"contentType":[^{}]*\})'), 1)).alias("json"))
    r = found.select(F.lit(source).alias("source"), "channel_id", clock.epoch_or_iso(field(F.col("json"), "$.startTime", "$.start")).alias("start"),
                     clock.epoch_or_iso(field(F.col("json"), "$.endTime", "$.end")).alias("stop"), field(F.col("json"), "$.title", "$.name").alias("title"), field(F.col("json"), "$.description").alias("desc")).filter("start IS NOT NULL")
    rest = F.struct("stop", "title", "desc")
    return r.groupBy("source", "channel_id", "start").agg(F.max_by(rest, F.struct(F.when(F.coalesce("desc", F.lit("")) != "", 1).otherwise(0), F.length("title"), "title")).alias("r")).select("source", "channel_id", "start", "r.*")


def timed_items(pages: DataFrame, source: str | Column) -> DataFrame:
    """<time datetime="ISO"> items with a heading and a duration text: stop by duration, cut at the next start."""
    item = F.explode(F.regexp_extract_all("html", F.lit(r"(?s)<li\b.*?</li>"), 0)).alias("item")
    i = pages.select(_named(source), "channel_id", item)
    text = lambda p: rules.strip(rules.apply(F.regexp_replace(F.regexp_extract("item", p, 1), r"<[^>]*>", ""), (rules.UNESCAPE,)))
    r = i.select(
        "source", "channel_id", F.regexp_extract("item", r'<time[^>]*datetime="([^"]+)"', 1).try_cast("timestamp").alias("start"),
        text(r"(?s)<h[23][^>]*>(.*?)</h[23]>").alias("title"), clock.duration_seconds(text(r'(?s)class="duration"[^>]*>(.*?)<')).alias("seconds")).filter("start IS NOT NULL AND title != ''")
    one = r.groupBy("source", "channel_id", "start").agg(F.min(F.struct("title", "seconds")).alias("r")).select("source", "channel_id", F.unix_seconds("start").alias("s"), "r.*")
    n = series.with_next(one, ["source", "channel_id"], "s", (), "nxt")
    stop = F.least(F.coalesce(F.col("s") + F.col("seconds"), "nxt", F.col("s") + 3600), F.coalesce("nxt", F.col("s") + F.coalesce("seconds", F.lit(3600))))
    return n.select("source", "channel_id", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(stop).alias("stop"), "title")


def epoch_items(pages: DataFrame, source: str) -> DataFrame:
    """Elements with data-start and data-end in epoch milliseconds and a title attribute; 'YYYY. text' gives year and description."""
    i = pages.select("channel_id", F.explode(F.regexp_extract_all("html", F.lit(r"<div\b[^>]*data-start[^>]*>"), 0)).alias("item"))
    a = lambda n: F.regexp_extract("item", rf'{n}="([^"]*)"', 1)
    text = a("data-desc")
    return i.select(F.lit(source).alias("source"), "channel_id", F.timestamp_millis(a("data-start").try_cast("bigint")).alias("start"), F.timestamp_millis(a("data-end").try_cast("bigint")).alias("stop"), a("title").alias("title"),
                    F.regexp_extract(text, r"^(\d{4})\. ", 1).alias("date"), F.regexp_replace(text, r"^\d{4}\. ", "").alias("desc")).filter("start IS NOT NULL")


def text_guide(lines: DataFrame, source: str, year: int) -> DataFrame:
    """Lines of a page (channel_id, line_no, text): a day header 'DD/MM', then 'HH:MM', title and genre lines."""
    w = Window.partitionBy("channel_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)  # the lines of one page
    nxt = Window.partitionBy("channel_id").orderBy("line_no")
    t = F.trim("text")
    day = F.when(t.rlike(r"\b\d{1,2}/\d{1,2}\b") & ~t.rlike(r"^\d{1,2}:\d{2}$"), F.regexp_extract(t, r"\b(\d{1,2}/\d{1,2})\b", 1))
    x = lines.withColumn("day", F.last(day, ignorenulls=True).over(w)).withColumn("title", F.lead(t).over(nxt)).withColumn("genre", F.lead(t, 2).over(nxt))
    x = x.filter(t.rlike(r"^\d{1,2}:\d{2}$") & F.col("day").isNotNull() & F.col("title").isNotNull())
    part = lambda c, p, i: F.regexp_extract(c, p, i).cast("int")
    start = F.make_timestamp(F.lit(year), part(F.col("day"), r"/(\d+)", 1), part(F.col("day"), r"(\d+)/", 1), part(t, r"(\d+):", 1), part(t, r":(\d+)", 1), F.lit(0).cast("decimal(8,6)"))
    return x.select(F.lit(source).alias("source"), "channel_id", start.alias("start"), "title", F.when(F.col("genre").rlike(r"^\d{1,2}:\d{2}$"), None).otherwise(F.col("genre")).alias("genre"))


def spoken_dates(text: Column, seen_at: Column) -> Column:
    """Date of 'DD de <month>' in Portuguese without a year."""
    d, m = F.regexp_extract(text, r"(?i)(\d{1,2})\s+de\s+(\p{L}+)", 1).try_cast("int"), F.lower(F.regexp_extract(text, r"(?i)(\d{1,2})\s+de\s+(\p{L}+)", 2))
    month = F.array_position(F.array(*(F.lit(x) for x in MONTHS)), m).cast("int")
    return F.when(month > 0, F.make_date(clock.inferred_year(month, seen_at), month, d))


def translated_genre(genre: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in GENRES.items() for x in kv))
    return F.coalesce(table[F.lower(F.trim(genre))], genre)


def links(pages: DataFrame, pattern: str = r'(?i)<a\b[^>]*href="([^"]*)"[^>]*>([^<]*)</a>') -> DataFrame:
    """name, url of the links of category pages; of equal names the first page and link count."""
    anchors = F.posexplode(F.regexp_extract_all("html", F.lit(r'(?i)<a\b[^>]*href="[^"]*"[^>]*>[^<]*</a>'), 0)).alias("pos", "a")
    l = pages.select("page", anchors).select("page", "pos", F.regexp_extract("a", pattern, 1).alias("url"), F.trim(F.regexp_extract("a", pattern, 2)).alias("name")).filter("name != ''")
    return l.groupBy("name").agg(F.min_by("url", F.struct("page", "pos")).alias("url"))


def grid(docs: DataFrame, source: str) -> DataFrame:
    """{"channels": [{"id", "programs": [{"title", "start", "end"}]}]} with ISO times in column ``json``; one row per start."""
    shape = "channels array<struct<id:string,programs:array<struct<title:string,start:string,end:string>>>>"
    c = docs.select(F.explode(F.from_json("json", shape)["channels"]).alias("c")).select(F.col("c.id").alias("channel_id"), F.explode("c.programs").alias("p"))
    r = c.select("channel_id", clock.epoch_or_iso(F.col("p.start")).alias("start"), clock.epoch_or_iso(F.col("p.end")).alias("stop"), F.col("p.title").alias("title")).filter("start IS NOT NULL")
    return r.groupBy("channel_id", "start").agg(F.min(F.struct("stop", "title")).alias("r")).select(F.lit(source).alias("source"), "channel_id", "start", "r.*")


def clock_ranges(lines: DataFrame, source: str) -> DataFrame:
    """Lines (channel_id, day DATE, text) 'HHhMM - HHhMM | genre | title': a stop before its start is on the next day."""
    p = r"^\s*(\d{1,2})h(\d{2})\s*-\s*(\d{1,2})h(\d{2})\s*\|\s*([^|]*?)\s*\|\s*(.*?)\s*$"
    part = lambda i: F.regexp_extract("text", p, i)
    at = lambda h, m: F.timestamp_seconds(F.unix_date("day").cast("bigint") * 86_400 + part(h).cast("int") * 3600 + part(m).cast("int") * 60)
    r = lines.filter(F.col("text").rlike(p))
    return r.select(F.lit(source).alias("source"), "channel_id", at(1, 2).alias("start"), clock.wrapped_stop(at(1, 2), at(3, 4)).alias("stop"), part(5).alias("genre"), part(6).alias("title"))


def clock_blocks(blocks: DataFrame, source: str, back_min: int = 180) -> DataFrame:
    """Blocks (channel_id, seq, day DATE, clock 'HH:MM', title) of one page in order: the day goes on where the clock turns
    back by over ``back_min`` minutes; one row per start, stops from the next one."""
    minute = F.split("clock", ":")[0].cast("int") * 60 + F.split("clock", ":")[1].cast("int")
    b = blocks.withColumn("seq", F.col("seq").cast("bigint")).withColumn("minute", minute.cast("bigint"))
    b = series.with_previous(b, ["channel_id"], "seq", (), "minute", "before", 1000)
    b = series.with_running_sum(b.withColumn("turn", F.when(F.col("before") - F.col("minute") > back_min, 1).otherwise(0)), ["channel_id"], "seq", (), "turn", "days", 1000)
    s = (F.unix_date("day").cast("bigint") + F.col("days")) * 86_400 + F.col("minute") * 60
    one = b.withColumn("s", s).groupBy("channel_id", "s").agg(F.min_by("title", "seq").alias("title"))
    n = series.with_next(one, ["channel_id"], "s", (), "nxt")
    stop = F.when(F.col("nxt").isNull(), F.col("s") + 3600).when(F.col("nxt") - F.col("s") > 6 * 3600, F.col("s") + 7200).otherwise(F.col("nxt"))
    return n.select(F.lit(source).alias("source"), "channel_id", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(stop).alias("stop"), "title")


def only_missing(main: DataFrame, spare: DataFrame, key: str, least: int = 5) -> DataFrame:
    """Rows of main, and those of spare for keys of which main has fewer than ``least`` rows."""
    covered = main.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(key)
    return main.unionByName(spare.join(covered, key, "left_anti"), allowMissingColumns=True)
