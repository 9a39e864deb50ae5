import random

from pyspark.sql import functions as F

from gradeweave.llm import residue, residue_seeds as seeds

BAD = ["{{ title }}", "Jornal X ${evento.nome}", "__program.name__", "404 Not Found", "<b>Lorem ipsum dolor sit amet", "Ative o JavaScript no seu nav…", "ative o javascirpt no seu navegador", "null", "Programação não informada (ref. 12)", "Título_a_confirmar", "&lt;titulo&gt; EP %ep%", "[object Object]", "Sem título"]
GOOD = ["Jornal da Noite", "Erro 404, o Filme (R)", "#Domingo", "Habilite-se! - Ao Vivo", "Sem Título de Nobreza HD", "[Pausa] Cozinha T2 EP 3", "O Navegador", "100% Natureza", "A Ilha Null", "Cine Bodegavo", "{Re}começos", "Os Fovivifoli &amp; Cia"]
NATURAL = [f"{a} {b}" for a in ("Jornal", "Cine", "Bom Dia", "A Casa", "Na Ponte", "Mesa", "Arquivo") for b in ("da Noite", "Norte", "do Vale", "Azul", "de Pedra", "dos Sonhos", "em Chamas", "Perdida", "das Marés")]


def frame(spark, titles):
    return spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "row_id bigint, title string")


def test_kinds(spark):
    df = frame(spark, [*BAD, *GOOD, *NATURAL, None, "", "   ", " "]).withColumns({c: F.lit(1) for c in ("t", "i", "h", "kind")})
    got = {r.row_id for r in residue.residue(df).collect()}
    assert got == set(range(len(BAD))), [([*BAD, *GOOD, *NATURAL])[i] for i in got ^ set(range(len(BAD)))]


def test_empty_repeated_and_long(spark):
    assert residue.residue(frame(spark, [])).count() == 0
    assert residue.residue(frame(spark, [None, ""])).count() == 0
    long = "Jornal da Noite " * 20_000
    got = {r.row_id: r.kind for r in residue.residue(frame(spark, ["null", "null", long, long + "{{ title }}", "!?" * 100_000])).collect()}
    assert got[0] == got[1] == "filler" and 2 not in got and got[3] == "template"


def test_held_out_phrases():
    """A model that never saw a fifth of the phrases of each kind finds them, and never takes a natural title for one."""
    every = seeds.all_phrases()
    order = {k: random.Random(5).sample(t, len(t)) for k, t in every.items()}
    model = residue.fitted(NATURAL, {k: t[len(t) // 5:] for k, t in order.items()})
    for k, t in order.items():
        held = t[: len(t) // 5]
        found = [x is not None for x in model.judge(held)[0]]
        assert sum(found) >= 0.9 * len(found), k
    kinds, share = model.judge(NATURAL)
    assert not any(kinds) and ((share >= 0) & (share <= 1)).all()


def test_held_out_patterns():
    """Whole patterns are left out: what is found of them is found by the words they share with others."""
    lines = {"error": seeds.ERRORS, "script": seeds.SCRIPTS}
    for k, block in lines.items():
        rows = block.strip().splitlines()
        held = [x for r in rows[::5] for x in seeds.spelled(r)]
        rest = set(seeds.all_phrases()[k]) - set(held)
        model = residue.fitted(NATURAL, seeds.all_phrases() | {k: sorted(rest)})
        assert sum(x is not None for x in model.judge(held)[0]) >= 0.4 * len(held), k


def test_counts_cover_all_titles(spark):
    """The distributed counts of different titles are those of one list, however often titles repeat."""
    titles = [f"Jornal {i} da Serra" for i in range(700)]
    df = frame(spark, titles * 3).repartition(7).select(F.col("title").alias("t")).distinct()
    got, want = residue.natural_counts(df, residue.Seeded()), residue.Counts.usual().add(titles)
    assert all((got.sums[k] == want.sums[k]).all() for k in want.sums)


def test_seeds_are_no_titles(spark):
    """Seeds of more than three words are made by rule; a table's phrases must not creep in."""
    from conftest import SF

    seen = {residue.plain(residue.fold(r.title)) for r in spark.read.parquet(f"{SF}/programmes.parquet").select("title").distinct().filter("title IS NOT NULL").collect()}
    made = {t for v in seeds.all_phrases().values() for t in v}
    assert len({t for t in made & seen if len(t.split()) > 3}) < 0.002 * len(made)
