from pyspark.sql import functions as F

from gradeweave.llm import mapping

DICT = [
    ("BK2", "Bodegavo Infantil 2", ["Bodegavo Kids 2", None]), ("BK1", "Bodegavo Infantil 1", []), ("BS", "Bodegavo Séries", None), ("AS", "Aurora Sulina", ["Rede Aurora Sulina/PE"]), ("AN", "Aurora Nortenha", []), ("VN", "Vale Notícias 24", ["VN24", "Vale News"]), ("MT", "Mecanorivo Filmes", ["Mecanorivo TV"]),
]
DSHAPE = "key string, name string, aliases array<string>"


def mapped(spark, names, dictionary=DICT):
    e = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "entry_id bigint, display_name string").withColumns({c: F.lit("x") for c in ("name", "n", "form", "core", "entry", "score")})
    got = mapping.map_entries(e, spark.createDataFrame(dictionary, DSHAPE)).collect()
    assert len({r.entry_id for r in got}) == len(got)
    return {names[r.entry_id]: r.dict_key for r in got}


def test_names(spark):
    want = {
        "BR: Bodegavo Kids 2 [FHD]": "BK2", "infantil 2 bodegavo": "BK2", "Bodegvao Inf. 2": "BK2", "BODEGAVO SÉRIES HD²": "BS", "B0degavo Series": "BS", "Sulina - Aurora": "AS", "Rede Aurora Sulina/PE": "AS", "TV Aurora Sulnia": "AS",
        "VN24": "VN", "Noticias Vale": "VN", "Mecanorivo TV": "MT", "Aurora Sulina [2]": "AS",
    }
    none = ["Bodegavo Infantil 3", "Bodegavo Música", "Aurora Outra", "Zenite Sulina", "AR - Mecanorivo TV", "Bodegavo Séries S01E02", "Mecanorivo Filmes (1999)", "Outro Canal", "", "   ", None, "x" * 100_000]
    assert mapped(spark, [*want, *none]) == want


def test_repeated_empty_and_ties(spark):
    e = spark.createDataFrame([(i, "VN24") for i in range(50)], "entry_id bigint, display_name string")
    assert mapping.map_entries(e, spark.createDataFrame(DICT, DSHAPE)).count() == 50
    assert mapped(spark, []) == {} and mapped(spark, ["VN24"], []) == {}
    assert mapped(spark, ["Bodegavo Séries"], [("A", "Bodegavo Séries", []), ("B", "Bodegavo Series", [])]) == {}


def test_report(spark):
    e = spark.createDataFrame([(1, "Outro Canal"), (2, "Outro Canal"), (3, "VN24")], "entry_id bigint, display_name string")
    assert [(r.display_name, r.n_entries, r.status) for r in mapping.report(e, spark.createDataFrame(DICT, DSHAPE)).collect()] == [("Outro Canal", 2, "unknown")]
