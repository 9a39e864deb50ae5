"""Files and documents to tables and back."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from gradeweave import sinks, streaming
from gradeweave.sources import catalogs, feeds, xmltv

XML = """<?xml version="1.0"?><tv>
<channel id="um.br"><display-name>Canal Um</display-name><display-name lang="pt"> UM </display-name><icon src="i.png"/></channel><channel id="x.us"><display-name>X</display-name></channel>
<programme start="20261110120000 +0000" stop="20261110130000 +0000" channel="um.br"><title>Serie &amp; Cia S02E03</title><sub-title>Sub</sub-title><desc>curta</desc><desc>uma descrição mais longa</desc><category>Série</category><category>Série</category><episode-num system="xmltv_ns">1.4.</episode-num><rating system="x"><value>PG-12</value></rating><date>20250101</date></programme>
<programme start="20261110100000" channel="um.br"><title>Filme Bom</title><category>Filme</category><episode-num system="xmltv_ns">1.4.</episode-num></programme>
<programme start="garbage" channel="um.br"><title>Fora</title></programme></tv>"""


@pytest.fixture()
def xml_file(tmp_path):
    p = tmp_path / "a.xml.gz"
    p.write_bytes(gzip.compress(XML.encode()))
    return str(p)


def test_xmltv(spark, xml_file):
    c = xmltv.channels(spark, xml_file, "s").collect()
    assert [(r.channel_id, r.display_names, r.icon) for r in c] == [("um.br", ["Canal Um", "UM"], "i.png")]
    p = {r.title: r for r in xmltv.programmes(spark, xml_file, "s", "-0300").collect()}
    a, b = p["Serie & Cia"], p["Filme Bom"]
    assert (a.meta.season, a.meta.episode, a.meta.rating_badge, a.meta.desc, a.meta.categories, a.meta.date, a.meta.sub_title) == (2, 5, "12", "uma descrição mais longa", ["Série"], "2025", "Sub")
    assert b.start.hour == 13 and b.stop is None and b.meta.season is None  # no offset: the default; films have no season


def test_gzip_by_content(spark, tmp_path):
    p = tmp_path / "feed"
    p.write_bytes(gzip.compress(XML.encode()))
    assert xmltv.from_text(xmltv.sniffed(spark, str(p), "programme"), "s").count() == 2


def test_one_bad_source(spark, xml_file):
    good, bad = xmltv.read_all(spark, [("a", xml_file, "+0000"), ("b", "/no/such/file.xml", "+0000")])
    assert good.count() == 2 and [k for k, _ in bad] == ["b"]
    with pytest.raises(RuntimeError):
        xmltv.read_all(spark, [("b", "/no/such/file.xml", "+0000")])


def test_json_feeds(spark):
    one = lambda *docs: spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    r = feeds.schedule_records(one({"id_canal": "7", "titulo": "T", "dh_inicio": "2026-11-10T12:00:00Z", "dh_fim": "2026-11-10T13:00:00Z", "classificacao": "14"}), "c", wrong_zone="-03:00").first()
    assert (r.channel_id, r.title, r.rating_badge, r.start.hour) == ("7", "T", "14", 15)
    r = feeds.schedule_records(one({"channelId": "7", "Title": "T", "StartTime": 1794312000}), "v", lineup=spark.createDataFrame([("7", "Sete")], "id string, name string")).first()
    assert (r.channel_name, r.start.hour) == ("Sete", 12)
    r = feeds.nested_broadcasts(one({"data": {"broadcasts": [{"channel": {"id": "g"}, "epgByDate": {"entries": [{"title": "T", "startTime": 1794312000, "endTime": 1794315600, "contentRating": "L"}]}}]}}), "g").collect()
    assert [(x.channel_id, x.rating_badge) for x in r] == [("g", "L")]
    r = feeds.grid(one({"channels": [{"id": "m", "programs": [{"title": "T", "start": "2026-11-10T12:00:00Z", "end": "2026-11-10T13:00:00Z"}, {"title": "U", "start": "2026-11-10T12:00:00Z", "end": "2026-11-10T12:30:00Z"}]}]}), "m").collect()
    assert [x.title for x in r] == ["U"]


def test_pages(spark):
    page = lambda h: spark.createDataFrame([("c", h)], "channel_id string, html string")
    r = feeds.timed_items(page('<li><time datetime="2026-11-10T12:00:00Z">12h</time><h3>A</h3><i class="duration">1h 30</i></li><li><time datetime="2026-11-10T13:00:00Z"></time><h3>B</h3></li>'), "g").orderBy("start").collect()
    assert [(x.title, (x.stop - x.start).seconds) for x in r] == [("A", 3600), ("B", 3600)]
    r = feeds.epoch_items(page('<div data-start="1794312000000" data-end="1794315600000" title="A" data-desc="1999. Texto"></div>'), "w").first()
    assert (r.title, r.date, r.desc, r.start.hour) == ("A", "1999", "Texto", 12)
    r = feeds.embedded_json(page('x {"contentType":"P","startTime":1794312000,"title":"A"} {"contentType":"P","startTime":1794312000,"title":"A2","description":"d"}'), "g").collect()
    assert [(x.title, x.desc) for x in r] == [("A2", "d")]
    lines = spark.createDataFrame([("c", i, t) for i, t in enumerate(["Terça, 10/11", "23:30", "A", "Filme", "Quarta, 11/11", "00:30", "B", "01:00", "C"])], "channel_id string, line_no int, text string")
    r = feeds.text_guide(lines, "m", 2026).orderBy("start").collect()
    assert [(x.title, x.genre, x.start.day) for x in r] == [("A", "Filme", 10), ("B", None, 11), ("C", None, 11)]
    l = feeds.links(spark.createDataFrame([(1, '<a href="/u">Um</a><a href="/v">Um</a>')], "page int, html string")).collect()
    assert [(x.name, x.url) for x in l] == [("Um", "/u")]
    d = spark.createDataFrame([("3 de janeiro", "2026-12-30 00:00:00")], "t string, s string").select(feeds.spoken_dates(F.col("t"), F.col("s").cast("timestamp")).alias("d")).first().d
    assert (d.year, d.month, d.day) == (2027, 1, 3)


def test_clock_texts(spark):
    l = spark.createDataFrame([("c", "2026-11-10", "23h30 - 00h15 | Filme | A Casa"), ("c", "2026-11-10", "nada")], "channel_id string, d string, text string").withColumn("day", F.to_date("d"))
    r = feeds.clock_ranges(l, "t").collect()
    assert [(x.title, x.genre, (x.stop - x.start).seconds) for x in r] == [("A Casa", "Filme", 2700)]
    b = spark.createDataFrame([("c", i, t, n) for i, (t, n) in enumerate([("22:00", "A"), ("23:30", "B"), ("23:30", "B2"), ("00:30", "C"), ("09:00", "D")])], "channel_id string, seq int, clock string, title string").withColumn("day", F.lit("2026-11-10").cast("date"))
    r = feeds.clock_blocks(b, "a").orderBy("start").collect()
    assert [(x.title, x.start.day, (x.stop - x.start).seconds // 60) for x in r] == [("A", 10, 90), ("B", 10, 60), ("C", 11, 120), ("D", 11, 60)]
    assert spark.createDataFrame([("Comedy",), ("X",)], "g string").select(feeds.translated_genre(F.col("g")).alias("g")).collect()[0].g == "Comédia"


def test_only_missing(spark):
    main = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "channel_id string, n int")
    spare = spark.createDataFrame([("a", 9), ("b", 9), ("c", 9)], "channel_id string, n int")
    assert sorted(r.channel_id for r in feeds.only_missing(main, spare, "channel_id").filter("n = 9").collect()) == ["b", "c"]


def test_catalogs(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"version": 1, "channels": {"K": {"name": "N", "aliases": ["A", "B"]}}}))
    (tmp_path / "o.json").write_text(json.dumps({"by_target_id": {"K": {"source": "s", "channel_id": "c"}}}))
    (tmp_path / "l.json").write_text(json.dumps({"channels": {"K": {"name": "N", "tvg_ids": ["x", {"id": "y", "observations": 3, "trusted": True}]}}}))
    assert [tuple(r) for r in catalogs.manual_dictionary(spark, str(tmp_path / "d.json")).collect()] == [("K", "N", ["A", "B"])]
    assert [tuple(r) for r in catalogs.overrides(spark, str(tmp_path / "o.json")).collect()] == [("K", "s", "c")]
    ids = catalogs.learned_store(spark, str(tmp_path / "l.json")).first().tvg_ids
    assert [(i.id, i.observations, i.trusted) for i in ids] == [("x", 1, False), ("y", 3, True)]


def test_xmltv_sink_is_deterministic(spark, tmp_path):
    c = spark.createDataFrame([("b", ["B & C"]), ("a", ["A"])], "channel_id string, display_names array<string>")
    p = spark.sql("SELECT 'a' AS channel_id, timestamp_seconds(1794312000 + id * 60) AS start, timestamp_seconds(1794312060 + id * 60) AS stop, concat('T<', id) AS title, CAST(NULL AS STRING) AS description, array('X') AS categories FROM range(50)")
    texts = []
    for n in (1, 3):
        sinks.write_xmltv(c, p.repartition(n), str(tmp_path / f"o{n}"), files=3)
        texts.append("".join(gzip.open(f, "rt").read() for f in sorted((tmp_path / f"o{n}").glob("part-*"))))
    assert texts[0] == texts[1] and texts[0].startswith("<?xml") and texts[0].rstrip().endswith("</tv>") and texts[0].index("<channel id=\"b\"") < texts[0].index("<programme")
    (tmp_path / "all.xml").write_text(texts[0])
    assert xmltv.programmes(spark, str(tmp_path / "all.xml"), "r").count() == 50


def test_other_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a")], "playlist string, line_no int, text string")
    sinks.write_playlist(lines, str(tmp_path / "pl"))
    assert [f.read_text() for f in (tmp_path / "pl" / "playlist=p").glob("part-*")] == ["a\nb\n"]
    sinks.write_id_map(spark.createDataFrame([("N", "i")], "name string, id string"), str(tmp_path / "m"))
    assert "N;i" in "".join(f.read_text() for f in (tmp_path / "m").glob("part-*"))
    assert sinks.markdown(lines, "T").count("\n| ") == 3


def test_stream_first_seen(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS source, 'c' AS channel_id, timestamp_seconds(id % 3) AS start, timestamp_seconds(1000 + id) AS loaded_at FROM range(9)")
    df.write.parquet(str(tmp_path / "in"))
    s = streaming.first_seen(streaming.read_programmes(spark, str(tmp_path / "in"), df.schema))
    streaming.run_to_parquet(s, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    streaming.run_to_parquet(s, str(tmp_path / "out"), str(tmp_path / "state"))  # nothing new: nothing is added
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_xmltv_elements_roundtrip(spark):
    """All elements that the sink writes are read back; NULL and empty ones write nothing."""
    rows = [("c1", 1794312000, 1794315600, "Vila & Rio", "A <volta>", "Um texto longo sobre a vila.", ["Novela", "Drama"], "2026", "http://x/i.png?a=1&b=2", 2, 5, "14"),
            ("c2", 1794312000, 1794315600, "Só", None, "", None, None, "", None, None, "")]
    p = spark.createDataFrame(rows, "channel_id string, s bigint, e bigint, title string, sub_title string, description string, categories array<string>, date string, icon string, season int, episode int, rating_badge string")
    p = p.withColumn("start", F.timestamp_seconds("s")).withColumn("stop", F.timestamp_seconds("e"))
    lines = sinks.xmltv_lines(p.limit(0).select("channel_id", F.array(F.lit("")).alias("display_names")), p).filter("part = 2").select(F.col("line").alias("xml"))
    text = {r.xml for r in lines.collect()}
    assert not any(x in t for t in text if 'channel="c2"' in t for x in ("<sub-title", "<date", "<icon", "<episode-num", "<rating", "<desc"))
    got = {r.channel_id: r.meta for r in xmltv.from_text(lines, "s").collect()}
    m = got["c1"]
    assert (m.title, m.sub_title, m.desc, m.categories, m.date, m.icon, m.season, m.episode, m.rating_badge) == ("Vila & Rio", "A <volta>", "Um texto longo sobre a vila.", ["Novela", "Drama"], "2026", "http://x/i.png?a=1&b=2", 2, 5, "14")
    assert got["c2"].title == "Só" and got["c2"].season is None
