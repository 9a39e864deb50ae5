import random

from pyspark.sql import functions as F

from gradeweave.llm import language

#: (language, sentence) for training and test; the test sentences are other ones.
TRAIN = {
    "pt": ["O jornal da noite não tem hora para terminar, mas o público gosta muito.", "A emissora ainda não confirmou se a série será mantida durante as férias.", "Quem perdeu o capítulo anterior pode ver a reapresentação completa no sábado.", "Os moradores da cidade reclamam que o sinal cai sempre depois do almoço."],
    "es": ["El diario de la noche no tiene hora para terminar, pero al público le gusta mucho.", "La cadena todavía no ha confirmado si la serie seguirá durante las vacaciones.", "Quien se perdió el capítulo anterior puede ver la repetición completa el sábado.", "Los vecinos de la ciudad se quejan de que la señal se corta siempre después de comer."],
    "en": ["The evening news has no fixed time to end, but the viewers like it very much.", "The network has not confirmed whether the series will be kept during the holidays.", "Viewers who missed the previous chapter can watch the full repeat on Saturday.", "The people of the town complain that the signal is always lost after lunch."],
    "fr": ["Le journal du soir n'a pas d'heure pour finir, mais le public l'aime beaucoup.", "La chaîne n'a pas encore confirmé si la série sera maintenue pendant les vacances.", "Ceux qui ont manqué le chapitre précédent peuvent voir la rediffusion complète samedi.", "Les habitants de la ville se plaignent que le signal est toujours perdu après le déjeuner."],
    "it": ["Il telegiornale della sera non ha un orario per finire, ma al pubblico piace molto.", "La rete non ha ancora confermato se la serie sarà mantenuta durante le vacanze.", "Chi ha perso il capitolo precedente può vedere la replica completa sabato.", "Gli abitanti della città si lamentano che il segnale cade sempre dopo il pranzo."],
}
TEST = {
    "pt": "A novela não será exibida porque o jogo da seleção vai ser transmitido.", "es": "La telenovela no se emitirá porque el partido de la selección se va a transmitir.", "en": "The soap will not be shown because the match of the team is on air.",
    "fr": "Le feuilleton ne sera pas diffusé parce que le match de la sélection est retransmis.", "it": "La telenovela non sarà trasmessa perché la partita della nazionale va in onda.",
}
CODES = {"pt": "pt-BR", "es": "spa", "en": "EN", "fr": "fra", "it": "it_IT"}


def corpus():
    return [(1000 + i * 10 + j, " ".join(random.Random(i * 10 + j).sample(v, 3)), CODES[k]) for i, (k, v) in enumerate(TRAIN.items()) for j in range(8)]


def found(spark, rows):
    df = spark.createDataFrame(corpus() + rows, "doc_id bigint, text string, lang string").withColumns({c: F.lit("x") for c in ("d", "t", "named", "confidence")})
    segs = language.segments(df)
    assert all(0 <= r.confidence <= 1 and r.char_start < r.char_stop for r in segs.collect())
    return {(r.doc_id, r.lang) for r in language.unnamed_languages(segs).collect() if r.doc_id is None or r.doc_id < 1000}


def test_languages_and_labels(spark):
    rows = [(i, t, None) for i, t in enumerate(TEST.values(), 1)] + [(i + 10, t, CODES[k]) for i, (k, t) in enumerate(TEST.items(), 1)]
    rows += [(21, TEST["pt"] + " " + TEST["en"], "pt"), (22, TEST["pt"] + "\n\n" + TEST["fr"], "xx"), (23, TEST["it"].upper(), "pt"), (24, TEST["es"].lower(), ""), (25, "SÉRIE — Noite Azul\n" + TEST["en"], "eng")]
    assert found(spark, rows) == {(i, k) for i, k in enumerate(TEST, 1)} | {(21, "en"), (22, "pt"), (22, "fr"), (23, "it"), (24, "es")}


def test_no_sentences(spark):
    rows = [(1, None, "pt"), (2, "", None), (3, "   ", "en"), (4, "13:30 | Bom Dia | Canal", None), (5, "#tag #outra", "xx"), (6, "do carteiro em Vila, enquanto a mestra guardava", None), (None, TEST["en"], None)]
    assert found(spark, rows) == set()


def test_repeated_and_long(spark):
    long = (TEST["pt"] + " ") * 4000 + TEST["en"] + " " + "palavra " * 50_000
    assert found(spark, [(1, long, "pt"), (1, long, "pt"), (2, "x" * 500_000, None)]) == {(1, "en")}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert language.segments(df).count() == 0


def test_filter_corrects_false_positives():
    m = language.LanguageFilters.of([t for _, t, _ in corpus()])
    assert m.fitted.all() and (m.false < 0.01).all()
    assert m.score([language.fold("zzzz qqqq wwww")]).max() < 0.1


def test_sentences():
    got = [t for a, b, w in language.sentences("Um dois. três quatro! «a sombra em Vila. A».\nFim sem ponto") if w for t in ["Um dois. três quatro! «a sombra em Vila. A».\nFim sem ponto"[a:b]]]
    assert got == ["Um dois.", "três quatro!", "A»."]
    assert [w for _, _, w in language.sentences("O navio foi\nao porto. Depois")] == [True, False]


def test_sample_without_copies(spark):
    rows = [(i, f"texto {i}" if i % 3 else "o mesmo texto") for i in range(3000)]
    got = [r.t for r in language.doc_sample(spark.createDataFrame(rows, "doc_id bigint, text string"), "text", None, 100).collect()]
    assert len(got) == len(set(got)) == 100
    few = [(i, f"texto {i % 40}") for i in range(3000)]  # the range follows the texts, not the rows
    assert language.doc_sample(spark.createDataFrame(few, "doc_id bigint, text string"), "text", None, 10).count() == 10


def test_sample_takes_labelled_rows_and_whole_texts(spark):
    end = " ".join(TRAIN["it"])
    rows = [(i, f"palavra{i} " * 3000 + "\n" + end, "it" if i % 2 else None) for i in range(8)]
    sample = language.doc_sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "text", "lang")
    assert sample.count() == 4
    filters = language.fit(sample)
    want = language.LanguageFilters.of([r.t for r in sample.collect()])
    assert (filters.bits == want.bits).all()


def test_every_line_is_labelled():
    m = language.LanguageFilters.of([t for _, t, _ in corpus()])
    text = "Bom Dia Vila\n" + TEST["pt"] + " enfim.\nUma só.\n" + TEST["en"] + "\nNight News"
    segs = m.segments([text, "Bom Dia", "13:30 --", "Noite"])
    assert [(s[2], s[4]) for s in segs[0]] == [("pt", 1), ("en", 1)] and segs[0][0][0] == 0 and segs[0][-1][1] == len(text)
    assert [len(s) for s in segs[1:]] == [1, 0, 1] and segs[1][0][4] == 0


def test_more_than_eight_languages(monkeypatch):
    more = {f"l{i}": f"zu{i}q wo{i}k ra{i}m".replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d").replace("4", "e") for i in range(5)}
    monkeypatch.setattr(language.seeds, "LANGUAGES", (*language.seeds.LANGUAGES, *more))
    monkeypatch.setattr(language, "_KNOWN", language._KNOWN | {k: set(v.split()) for k, v in more.items()})
    m = language.LanguageFilters.of([t for _, t, _ in corpus()])
    assert m.bits.dtype.itemsize == 2 and m.score([language.fold(more["l4"])]).argmax() == 9
