from pyspark.sql import functions as F

from gradeweave.llm import linkage
from gradeweave.llm.channels import Parser, near

DICT = [("K", n, [], []) for n in ("Aurora Sulina", "Aurora Norte", "Maré Alta Sulina", "Zenite Sulina", "Zenite Norte")]
DSHAPE = "key string, name string, aliases array<string>, tvg_ids array<string>"
SHAPE = "chan_row_id bigint, source string, channel_id string, display_names array<string>, city string, group_title string, lcn int, icon string, country string"


def pairs(spark, rows, dictionary=DICT):
    df = spark.createDataFrame([(*r, *[None] * (9 - len(r))) for r in rows], SHAPE).withColumns({c: F.lit("x") for c in ("rid", "key", "kind", "weight")})
    got = linkage.pairs(df, spark.createDataFrame(dictionary, DSHAPE)).collect()
    assert all(0 < r.match_score < 1 and r.row_a < r.row_b for r in got)
    return {(r.row_a, r.row_b) for r in got}


def test_cascade(spark):
    rows = [
        (1, "a", "123", ["Bodegavo Séries 2 HD"]), (2, "b", "tvseries.bodegavo2", ["BR | Bodegavo Ser. [2]"]), (3, "c", "9", ["SÉRIES 2 BODEGAVO"]),  # written differently
        (4, "d", "8", ["Bodegvao Series 2"]), (5, "e", "7", ["Bodegavo Séries 3"]), (6, "f", "6", ["Bodegavo Filmes 2"]),  # a slip; other number; other genre
        (7, "a", "5", ["Rede Aurora - Sulina"]), (8, "b", "4", ["SULINA - AURORA (PE)"]), (9, "c", "3", ["Rede Aurora"], "Sulina - PE"), (10, "d", "2", ["TV Aurora Norte"]), (11, "e", "1", ["Zenite Sulina"]),
        (12, "a", "77", ["Bodegavo Séries 2"]),  # the same source as 1
        (13, "g", None, None), (14, None, "x", ["Bodegavo Séries 2"]), (15, "h", "", [None, ""]),
    ]
    assert pairs(spark, rows) == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (2, 12), (3, 12), (4, 12), (7, 8), (7, 9), (8, 9)}


def test_cut_names_and_repeats(spark):
    rows = [(1, "a", "1", ["Mecanorivo Kids"]), (2, "b", "2", ["Mecanorivo Infantil"]), (3, "c", "3", ["MECANOR Kids"]), (3, "c", "3", ["MECANOR Kids"]), (4, "d", "4", ["x" * 200_000 + " Kids"]), (5, "e", "5", ["x" * 200_000 + " Kids"])]
    assert pairs(spark, rows) == {(1, 2), (1, 3), (2, 3), (4, 5)}


def test_wrong_identifier(spark):
    rows = [(1, "a", "tvkids.mecanorivo", ["Mecanorivo Kids"]), (2, "b", "2", ["Mecanorivo Kids"]), (3, "c", "tvkids.mecanorivo", ["Bodegavo Séries"]), (4, "d", "4", ["Bodegavo Series"])]
    assert pairs(spark, rows) == {(1, 2), (3, 4)}


def test_slips_of_a_hot_channel(spark):
    rows = [(i, "ab"[i % 2], str(i), ["Bodegavo Séries 2"]) for i in range(200)] + [(1000 + i, "cd"[i % 2], str(i), ["Bodegvao Séries 2"]) for i in range(9)]
    rows += [(2000 + i, "ef"[i % 2], str(i), ["Mecanorivo Kids"]) for i in range(20)] + [(3000 + i, "gh"[i % 2], str(i), ["Mecanorivos Kids"]) for i in range(12)]  # two channels: neither is rare beside the other
    df = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SHAPE)
    found = {r.rid: r["class"] for r in linkage.resolve(df, spark.createDataFrame(DICT, DSHAPE))[0].collect()}
    assert len({found[r[0]] for r in rows[:209]}) == 1
    assert len({found[r[0]] for r in rows[209:]}) == 2


def test_long_names_and_classes(spark):
    """Slips beyond the length up to which letters are left out, and one row per record with its links."""
    base = "alfaquia bromelia cravoteca dunamares esmeralda falcoeira girassoia horizonta jabuticava"
    names = [base, base, base, base.replace("alfaquia", "alfauqia"), base.replace("jabuticava", "jabuticva"), base.replace("esmeralda", "esmerilda").replace("bromelia", "bromelha")]
    rows = [(i, "abcdef"[i], str(i), [n + " Kids"]) for i, n in enumerate(names)]
    df = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SHAPE)
    got = {r.chan_row_id: (r["class"], r.n_links) for r in linkage.classes(df, spark.createDataFrame(DICT, DSHAPE)).collect()}
    assert len({got[i][0] for i in range(5)}) == 1 and all(got[i][1] == 4 for i in range(5)) and got.get(5, (None, 0))[1] == 0


def test_large_classes_in_parts(spark, monkeypatch):
    monkeypatch.setattr(linkage, "PART_ROWS", 7)
    rows = [(i, "abc"[i % 3], str(i), ["Bodegavo Kids"]) for i in range(40)]
    assert pairs(spark, rows) == {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 3 != b % 3}


def test_genres_and_forms_are_learned():
    names = [f"{b} Astrologia" for b in "bodegavo mecanor fafijoda relagito tirapema zocuvani lamipodo nevadira".split()]
    p = Parser(names, [[f"{n.split()[0]} Astro."] for n in names])
    assert p.parse("Zupalico Astrologia 2").key == p.parse("zupalico astro 2").key == "zupalico|astrologia|2"
    assert Parser(names[:3]).parse("Zupalico Astrologia").genre == ""


def test_empty(spark):
    assert pairs(spark, []) == set()
    assert pairs(spark, [(1, "a", "1", ["Bodegavo Kids"]), (2, "b", "1", ["Bodegavo Kids"])], []) == {(1, 2)}


def test_parser():
    p = Parser(["Aurora Sulina", "Maré Alta Sulina"])
    for name, key in (("BR: Bodegavo Not. [2] FHD", "bodegavo|news|2"), ("BODEGAVONATUREZA H265", "bodegavo|nature|"), ("AuroraSulina", "aurora sulina||"), ("Sulina - Mare Alta (SC) HD²", "mare alta sulina||"), ("Aurora SP", None), ("F0teribego Musica 3 opção 2", "foteribego|music|3")):
        assert p.parse(name).key == key, name
    assert p.parse("AR - Bodegavo TV").foreign and p.parse("Cine X (1999)").vod and p.parse(None).key is None
    assert p.parse_code("agr/pr..bodegavo1-hd")[0].key == "bodegavo|agro|1" and p.parse_code("C123") == [] and p.parse_code(None) == []
    assert near("abcd", "abdc") and near("abcd", "abd") and not near("abcd", "badc") and near("abcd", "badc", 2)
