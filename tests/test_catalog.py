"""Name owners, poisoned identifiers, tiers and playlists on small tables."""

from pyspark.sql import functions as F

from gradeweave.operators import catalog, match, playlist
from gradeweave.sources import m3u


def test_name_owner(spark):
    rows = [("Globo EPTV Campinas", "Globo EPTV Campinas HD"), ("Globo Campinas", "Globo EPTV Campinas HD"), ("Cartoonito", "Cartoonito"), ("Boomerang", "Cartoonito HD"), ("b", "Outro"), ("a", "Outro"), ("a", "Mais")]
    got = {r.name_key: r.owner for r in catalog.name_owners(spark.createDataFrame(rows, "id string, name string")).collect()}
    assert got["GLOBO EPTV CAMPINAS"] == "Globo EPTV Campinas" and got["CARTOONITO"] == "Cartoonito" and got["OUTRO"] == "b"


def test_poisoned(spark):
    rows = [("AandE.br", n) for n in ("A&E", "Canal Um", "Lifetime", "History")] + [("ok.br", n) for n in ("Canal Dois", "Canal Dois HD", "CANAL DOIS 4K")] + [("sub.br", "Canal Tres"), ("sub.br", "Canal Tres Norte"), (None, "X"), ("x", None)]
    assert [r.id for r in catalog.poisoned_ids(spark.createDataFrame(rows, "tvg_id string, display_name string")).collect()] == ["aande"]


def test_tiers_and_stop(spark):
    d = spark.createDataFrame([("K", "Canal Norte SP", ["Norte"], ["norte.br"])], "key string, name string, aliases array<string>, tvg_ids array<string>")
    t = {(r.norm, r.tier) for r in match.tiers(d).collect()}
    assert ("CANALNORTESP", 1) in t and ("CANALNORTE", 2) in t
    c = spark.createDataFrame([("s1", "c1", ["Canal Norte SP"]), ("s2", "c2", ["Canal Norte"]), ("s3", "norte.br", ["?"])], "source string, channel_id string, display_names array<string>")
    counts = spark.createDataFrame([("s1", "c1", 5), ("s2", "c2", 5), ("s3", "norte.br", 5)], "source string, channel_id string, n_rows bigint")
    got = {(r.source, r.method, r.tier) for r in match.tiered(match.by_name(match.tiers(d), c).unionByName(match.by_id(d, c)), counts).collect()}
    assert got == {("s1", "exact", 1), ("s3", "id", 1)}  # the second tier is not needed any more


def test_fuzzy_margin(spark):
    d = spark.createDataFrame([("K", "CANAL PERNAMBUCO", [])], "key string, name string, aliases array<string>")
    c = spark.createDataFrame([("s", "c1", ["CANAL PERNAMBUCA"]), ("s", "c2", ["CANAL PERNAMBUCE"]), ("t", "c3", ["CANAL PERNAMBUCA"]), ("u", "c4", ["CANAL PERNAMBUCO 2"])], "source string, channel_id string, display_names array<string>")
    assert [(r.source, r.channel_id) for r in match.fuzzy(match.tiers(d), c).collect()] == [("t", "c3")]


def test_playlist(spark, tmp_path):
    f = tmp_path / "list.m3u"
    f.write_text('#EXTM3U\n#EXTINF:-1 tvg-id="a.br" tvg-name="Canal, Um" group-title="X",Canal, Um HD\nhttp://h/1\n#EXTINF:-1 tvg-id="",Filme\r\nhttp://h/f.mp4?x\n#EXTINF:-1 tvg-name="So Nome",\nrtmp://h/2\nlixo\n')
    got = m3u.parse(m3u.read_lines(spark, str(f))).orderBy("line_no").collect()
    assert [(r.tvg_id, r.tvg_name, r.display_name, r.url) for r in got] == [("a.br", "Canal, Um", "Canal, Um HD", "http://h/1"), ("", "So Nome", "So Nome", "rtmp://h/2")]
    assert m3u.parse(m3u.read_lines(spark, str(f)), keep_files=True).count() == 3


def test_rekey(spark):
    g = spark.createDataFrame([("1", "Canal Um"), ("2", "Rede Norte Sul"), ("3", "Dupla"), ("4", "Dupla")], "id string, name string")
    e = spark.createDataFrame([(1, "", "", "CANAL UM HD"), (2, "", "", "Sul Norte Rede"), (3, "", "", "Dupla"), (4, "3", "", "Sem"), (5, None, None, "Nada")], "entry_id int, tvg_id string, tvg_name string, display_name string")
    assert {r.entry_id: (r.new_id, r.reason) for r in playlist.rekeyed(e, g).collect()} == {1: ("1", "name"), 2: ("2", "words"), 3: ("", "ambiguous"), 4: ("3", "kept"), 5: ("", "none")}


def test_veto_of_networks_and_places(spark):
    """Fixture cases of names that look alike (R5-R8)."""
    cases = [("GLOBOPE", "GLOBOSP", True), ("GLOBOPA", "GLOBOSP", True), ("SBTRECIFE", "GLOBORECIFE", True), ("GLOBOPE", "GLOBOPERNAMBUCO", False), ("TVBRASILIA", "TVBRASIL", True), ("RECORDTVBRASILIA", "RECORDTVBRASIL", True),
             ("TVCAMPINAS", "EPTVCAMPINAS", True), ("EPCAMPINAS", "EPTVCAMPINAS", False), ("SBTCAMPINAS", "SBTMINAS", True), ("RECORDTVMANAUS", "RECORDTVMINAS", True), ("GLOBOTVVANGSJCAMPOS", "GLOBOTVVANGUARDASJDOSCAMPOS", False)]
    rules = {"networks": ("GLOBO", "SBT", "RECORD", "BAND"), "brands": ("EPTV",)}
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    assert [(r.a, r.b) for r in df.select("a", "b", "want", match.veto(F.col("a"), F.col("b"), **rules).alias("got")).collect() if r.got != r.want] == []


def test_similar_names_of_other_kinds_are_left_out(spark):
    d = spark.createDataFrame([("k", "Canal Bodegavo Norte", [], []), ("p", "PT Canal Mecanorivo", [], [])], "key string, name string, aliases array<string>, tvg_ids array<string>")
    c = spark.createDataFrame([("s", "c1", ["Canal Bodegavo Norte Kids"]), ("t", "c2", ["Canal Bodegavo Nort"]), ("t", "c3", ["Canal Mecanorivos"])], "source string, channel_id string, display_names array<string>")
    assert [(r.key, r.channel_id) for r in match.fuzzy(match.tiers(d), c).collect()] == [("k", "c2")]
